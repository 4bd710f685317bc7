"""Filters: each rule's metric and verdict, then the umbrellas."""

from pyspark.sql import functions as F

from textmill.functions.fixed_values import STOP_WORDS
from textmill.functions.text import with_parts
from textmill.operators import filters as flt
from textmill.operators.repetition import DUP_N_GRAMS, TOP_N_GRAMS, ngram_rules, with_ngram_fractions
from textmill.registry.base import DOCS, PARTS, busy_docs, query, ratio_sql, words_sql


def metric_query(key, metric, failed, sql_metric, sql_failed, source=PARTS, plant=None):
    """Register a rule: id, its metric and whether the row fails."""

    @query(key, f"SELECT id, metric, ({sql_failed}) AS failed FROM (SELECT id, {sql_metric} AS metric FROM {source})")
    def run(spark, sf):
        df = busy_docs(spark, sf)
        if plant is not None:
            df = df.withColumn("text", plant(F.col("text")))
        df, p = with_parts(df)
        return df.select("id", metric(p).alias("metric")).withColumn("failed", failed(F.col("metric")))


def list_mean(x: str) -> str:
    return ratio_sql(f"list_sum({x})", f"len({x})")


def list_median(x: str) -> str:
    s = f"list_sort({x})"
    return f"CASE WHEN len({x}) > 0 THEN ({s}[(len({x}) + 1) // 2] + {s}[len({x}) // 2 + 1]) / 2.0::DOUBLE ELSE 0.0::DOUBLE END"


def planted_parts(text_sql: str) -> str:
    return PARTS.replace(DOCS, f"(SELECT doc_id AS id, {text_sql} AS text, lang, source, n_chars FROM documents)")


CHARS = "list_transform(lines, lambda x: length(x))"
LINE_WORDS = rf"list_transform(lines, lambda x: len({words_sql('x')}))"
WORD_CHARS = "list_transform(words, lambda w: length(w))"

metric_query(
    "nordic_digit_fraction", lambda p: flt.digit_fraction(p.text), lambda m: m > 0.2,
    ratio_sql("length(regexp_replace(text, '[^0-9]', '', 'g'))", "length(text)"), "metric > 0.2",
)
metric_query("nordic_min_chars", lambda p: p.n_char, lambda m: m < 50, "n_char::INTEGER", "metric < 50")

for key, mean_, median_, limit, items in (
    ("nordic_line_chars", flt.line_char_mean, flt.line_char_median, 9, CHARS),
    ("nordic_line_words", flt.line_word_mean, flt.line_word_median, 2.1, LINE_WORDS),
):

    def line_query(key=key, mean_=mean_, median_=median_, limit=limit, items=items):
        @query(
            key,
            f"""SELECT id, mean, median, mean < {limit}::DOUBLE OR median < {limit}::DOUBLE AS failed FROM (SELECT id,
            {list_mean(items)} AS mean, {list_median(items)} AS median FROM {PARTS})""",
        )
        def run(spark, sf):
            df, p = with_parts(busy_docs(spark, sf))
            return df.select("id", mean_(p).alias("mean"), median_(p).alias("median")).withColumn(
                "failed", (F.col("mean") < limit) | (F.col("median") < limit)
            )

    line_query()

metric_query(
    "gopher_word_count", flt.word_count, lambda m: (m < 50) | (m > 5000),
    "len(words)::INTEGER", "metric < 50 OR metric > 5000",
)
metric_query(
    "gopher_word_length", flt.mean_word_length, lambda m: (m < 3) | (m > 10), list_mean(WORD_CHARS),
    "metric < 3 OR metric > 10",
)


@query(
    "gopher_symbol_ratio",
    f"""SELECT id, hashes, ellipses, hashes > 0.1 OR ellipses > 0.1 AS failed FROM (SELECT id,
    {ratio_sql("len(regexp_extract_all(text, '#'))", "len(words)")} AS hashes,
    {ratio_sql("len(regexp_extract_all(text, '[.][.][.]|…'))", "len(words)")} AS ellipses
    FROM {planted_parts("replace(text, '.' || chr(10), '...' || chr(10))")})""",
)
def gopher_symbol_ratio(spark, sf):
    df = busy_docs(spark, sf).withColumn("text", F.replace("text", F.lit(".\n"), F.lit("...\n")))
    df, p = with_parts(df)
    return df.select("id", flt.hash_ratio(p).alias("hashes"), flt.ellipsis_ratio(p).alias("ellipses")).withColumn(
        "failed", (F.col("hashes") > 0.1) | (F.col("ellipses") > 0.1)
    )


metric_query(
    "gopher_bullets", flt.bullet_line_ratio, lambda m: m > 0.9,
    ratio_sql(r"len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[•*-]')))", "len(lines)"), "metric > 0.9",
    source=planted_parts("CASE WHEN lang = 'fr' THEN replace(text, chr(10), chr(10) || ' - ') ELSE text END"),
    plant=lambda t: F.when(F.col("lang") == "fr", F.replace(t, F.lit("\n"), F.lit("\n - "))).otherwise(t),
)
metric_query(
    "gopher_ellipsis", flt.ellipsis_line_ratio, lambda m: m > 0.3,
    ratio_sql(r"len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…)[ \t\r]*$')))", "len(lines)"), "metric > 0.3",
    source=planted_parts("replace(text, '.' || chr(10), '...' || chr(10))"),
    plant=lambda t: F.replace(t, F.lit(".\n"), F.lit("...\n")),
)
metric_query(
    "gopher_alpha_words", flt.alpha_word_ratio, lambda m: m < 0.8,
    ratio_sql(r"len(list_filter(words, lambda w: regexp_matches(w, '\p{L}')))", "len(words)"), "metric < 0.8",
)

STOP_SQL = "CASE lang " + " ".join(
    f"WHEN '{lang}' THEN len(list_filter(words, lambda w: list_contains(["
    + ", ".join("'" + w.replace("'", "''") + "'" for w in items)
    + "], lower(w))))"
    for lang, items in STOP_WORDS.items()
) + " END"

metric_query(
    "gopher_stop_words", lambda p: flt.stop_word_count(p, F.col("lang")), lambda m: m < 2,
    f"({STOP_SQL})::INTEGER", "metric < 2",
)

QUALITY_SQL = f"""CASE WHEN {ratio_sql("len(regexp_extract_all(text, '#'))", "len(words)")} > 0.1 THEN 'too_many_hashes'
 WHEN {ratio_sql("len(regexp_extract_all(text, '[.][.][.]|…'))", "len(words)")} > 0.1 THEN 'too_many_ellipses'
 WHEN {ratio_sql(r"len(list_filter(lines, lambda x: regexp_matches(x, '^[ ]*[•*-]')))", "len(lines)")} > 0.9 THEN 'bullet_lines'
 WHEN {ratio_sql(r"len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…)[ ]*$')))", "len(lines)")} > 0.3 THEN 'ellipsis_lines'
 WHEN {ratio_sql(r"len(list_filter(words, lambda w: regexp_matches(w, '\p{L}')))", "len(words)")} < 0.8 THEN 'alpha_words'
 WHEN {STOP_SQL} < 2 THEN 'stop_words' END"""


@query(
    "gopher_quality",
    f"SELECT id, CASE WHEN r IS NOT NULL THEN 'GopherQualityFilter' END AS filter_module, r AS filter_reason FROM (SELECT id, {QUALITY_SQL} AS r FROM {PARTS})",
)
def gopher_quality(spark, sf):
    df, p = with_parts(busy_docs(spark, sf))
    return flt.annotate(df, "GopherQualityFilter", flt.quality_rules(p, F.col("lang"))).select(
        "id", "filter_module", "filter_reason"
    )


def dup_sql(items: str) -> str:
    return ratio_sql(f"len({items}) - len(list_distinct({items}))", f"len({items})")


def dup_char_sql(items: str) -> str:
    chars = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    return ratio_sql(f"{chars.format(items)} - {chars.format(f'list_distinct({items})')}", "length(text)")


# Plain texts have no blank lines; sentence ends become paragraph breaks on both sides.
PARA_SOURCE = planted_parts("replace(text, '. ', '.' || chr(10) || chr(10))")


def make_paragraphs(text):
    return F.replace(text, F.lit(". "), F.lit(".\n\n"))


metric_query("dup_line_frac", lambda p: flt.dup_fraction(p.lines), lambda m: m > 0.35, dup_sql("lines"), "metric > 0.35")
metric_query(
    "dup_para_frac", lambda p: flt.dup_fraction(p.paragraphs), lambda m: m > 0.35, dup_sql("paras"), "metric > 0.35",
    source=PARA_SOURCE, plant=make_paragraphs,
)
metric_query(
    "dup_line_char_frac", lambda p: flt.dup_char_fraction(p.lines, p.text), lambda m: m > 0.2,
    dup_char_sql("lines"), "metric > 0.2",
)
metric_query(
    "dup_para_char_frac", lambda p: flt.dup_char_fraction(p.paragraphs, p.text), lambda m: m > 0.2,
    dup_char_sql("paras"), "metric > 0.2", source=PARA_SOURCE, plant=make_paragraphs,
)

NS_TOP = [n for n, _ in TOP_N_GRAMS]
NS_DUP = [n for n, _ in DUP_N_GRAMS]


def gram_cte(ns) -> str:
    """g(id, n, gram, pos): every n-gram; pos(id, i, s): word offsets in the re-joined words."""
    grams = " UNION ALL ".join(
        f"""SELECT id, {n} AS n, i AS pos, array_to_string(words[i:i + {n - 1}], ' ') AS gram
        FROM (SELECT id, words, unnest(range(1, len(words) - {n - 1} + 1)) AS i FROM w WHERE len(words) >= {n})"""
        for n in ns
    )
    return f"WITH w AS (SELECT id, words, n_char FROM {PARTS}), g AS ({grams})"


def top_select(value: str) -> str:
    return f"""SELECT id, n, {value} FROM (SELECT id, n, gram, count(*) AS c,
    row_number() OVER (PARTITION BY id, n ORDER BY count(*) DESC, length(gram) DESC, gram) AS r
    FROM g GROUP BY id, n, gram) WHERE r = 1"""


@query(
    "top_ngram_char_frac",
    gram_cte(NS_TOP)
    + ", t AS (" + top_select("length(gram) * c AS chars") + ") SELECT w.id, "
    + ", ".join(
        ratio_sql(f"coalesce((SELECT chars FROM t WHERE t.id = w.id AND n = {n}), 0)", "n_char") + f" AS top_{n}_gram"
        for n in NS_TOP
    )
    + " FROM w",
)
def top_ngram_char_frac(spark, sf):
    df, p = with_parts(busy_docs(spark, sf))
    return with_ngram_fractions(df, p, NS_TOP, []).select("id", *[f"top_{n}_gram" for n in NS_TOP])


DUP_TAIL = """, off AS (SELECT id, k AS pos, (sum(length(words[k]) + 1) OVER (PARTITION BY id ORDER BY k) - length(words[k]) - 1) AS s
   FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS k FROM w)),
 later AS (SELECT * FROM (SELECT g.*, row_number() OVER (PARTITION BY id, n, gram ORDER BY pos) AS r FROM g) WHERE r > 1),
 span AS (SELECT later.id, n, s, s + length(gram) AS e FROM later JOIN off ON off.id = later.id AND off.pos = later.pos),
 cover AS (SELECT id, n, sum(least(e, coalesce(nxt, e)) - s) AS chars
   FROM (SELECT *, lead(s) OVER (PARTITION BY id, n ORDER BY s) AS nxt FROM span) GROUP BY id, n)"""


@query(
    "dup_ngram_char_frac",
    gram_cte(NS_DUP) + DUP_TAIL + ", p AS (SELECT id, "
    + ", ".join(f"max(CASE WHEN n = {n} THEN chars END) AS c{n}" for n in NS_DUP)
    + " FROM cover GROUP BY id) SELECT w.id, "
    + ", ".join(ratio_sql(f"coalesce(c{n}, 0)", "n_char") + f" AS dup_{n}_gram" for n in NS_DUP)
    + " FROM w LEFT JOIN p ON p.id = w.id",
)
def dup_ngram_char_frac(spark, sf):
    df, p = with_parts(busy_docs(spark, sf))
    return with_ngram_fractions(df, p, [], NS_DUP).select("id", *[f"dup_{n}_gram" for n in NS_DUP])


LINE_REASON = f"""CASE WHEN {dup_sql('lines')} > 0.35 THEN 'dup_line_frac' WHEN {dup_sql('paras')} > 0.35 THEN 'dup_para_frac'
 WHEN {dup_char_sql('lines')} > 0.2 THEN 'dup_line_char_frac' WHEN {dup_char_sql('paras')} > 0.2 THEN 'dup_para_char_frac' END"""


def repetition_ctes(ns=tuple(NS_TOP + NS_DUP)) -> str:
    """Ends with rep(id, line_reason, gram_reason)."""
    limits = [(f"top_{n}_gram", f"t{n}", t) for n, t in TOP_N_GRAMS]
    limits += [(f"duplicated_{n}_gram", f"c{n}", t) for n, t in DUP_N_GRAMS]
    whens = " ".join(f"WHEN {ratio_sql(f'coalesce({c}, 0)', 'n_char')} > {t} THEN '{name}'" for name, c, t in limits)
    return (
        gram_cte(ns) + DUP_TAIL
        + ", t AS (" + top_select("length(gram) * c AS chars") + ")"
        + ", tp AS (SELECT id, " + ", ".join(f"max(CASE WHEN n = {n} THEN chars END) AS t{n}" for n in NS_TOP) + " FROM t GROUP BY id)"
        + ", cp AS (SELECT id, " + ", ".join(f"max(CASE WHEN n = {n} THEN chars END) AS c{n}" for n in NS_DUP) + " FROM cover GROUP BY id)"
        + f", rep AS (SELECT p.id, {LINE_REASON} AS line_reason, CASE {whens} END AS gram_reason FROM {PARTS} p"
        + " LEFT JOIN tp ON tp.id = p.id LEFT JOIN cp ON cp.id = p.id)"
    )


@query(
    "gopher_repetition",
    repetition_ctes() + """ SELECT id, CASE WHEN coalesce(line_reason, gram_reason) IS NOT NULL THEN 'GopherRepetitionFilter' END AS filter_module,
    coalesce(line_reason, gram_reason) AS filter_reason FROM rep""",
)
def gopher_repetition(spark, sf):
    df, p = with_parts(busy_docs(spark, sf))
    df = flt.annotate(df, "GopherRepetitionFilter", flt.line_repetition_rules(p))
    df = with_ngram_fractions(df, p, NS_TOP, NS_DUP, F.col("filter_reason").isNull())
    return flt.annotate(df, "GopherRepetitionFilter", ngram_rules()).select("id", "filter_module", "filter_reason")


@query(
    "extra_field_filter",
    f"""SELECT id, CASE WHEN lang NOT IN ('en', 'fr') OR source = 'src0' THEN 'ExtraFieldFilter' END AS filter_module,
    CASE WHEN lang NOT IN ('en', 'fr') OR source = 'src0' THEN 'extra_field' END AS filter_reason FROM {DOCS}""",
)
def extra_field_filter(spark, sf):
    fields = F.to_json(F.struct(F.col("lang").alias("original_language"), F.col("source").alias("from")))
    df = busy_docs(spark, sf).withColumn("extra", F.when(F.col("source") == "src0", "{}").otherwise(fields))
    return flt.extra_field_filter(df, "original_language", ["en", "fr"], raise_missing=False).select(
        "id", "filter_module", "filter_reason"
    )


@query(
    "regex_filter",
    f"""SELECT id, CASE WHEN regexp_matches(text, '([0-9°]{{3,}})|(\\.([\\w]{{2,4}}))|(/\\w+/\\w+)|(WorldCat)|(Wikikids)')
    THEN 'regex' END AS filter_reason FROM {DOCS}""",
)
def regex_filter(spark, sf):
    ascii_form = r"([0-9°]{3,})|(\.(\w{2,4}))|(\/\w+\/\w+)|(WorldCat)|(Wikikids)"
    return flt.regex_filter(busy_docs(spark, sf), ascii_form).select("id", "filter_reason")
