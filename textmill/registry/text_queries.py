"""Row shape, normalisation and formatting."""

from pyspark.sql import functions as F

from textmill.functions import normalize as norm
from textmill.functions.fixed_values import PUNCTUATION_ONE_TO_ONE, PUNCTUATION_SPELLED_OUT
from textmill.functions.text import text_metrics, words
from textmill.operators import rows
from textmill.registry.base import DOCS, busy_docs, docs, query, table, words_sql

# The documents hold no rare characters, so some are planted by rule on both sides.
PLANT_DECOMPOSED = "replace(text, chr(233), 'e' || chr(769))"


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def punctuation_sql(text: str) -> str:
    source = _sql_text("".join(PUNCTUATION_ONE_TO_ONE))
    target = _sql_text("".join(PUNCTUATION_ONE_TO_ONE.values()))
    out = f"translate({text}, {source}, {target})"
    for sign, spelled in PUNCTUATION_SPELLED_OUT.items():
        out = f"replace({out}, {_sql_text(sign)}, {_sql_text(spelled)})"
    return out


SPACES = r"[\t\r\f\x{000B}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"


def whitespace_sql(text: str) -> str:
    return f"regexp_replace({text}, '{SPACES}', ' ', 'g')"


@query(
    "delivery_format",
    f"""SELECT id::VARCHAR AS id, text, NULL::VARCHAR AS title, source, NULL::VARCHAR AS author, NULL::VARCHAR AS license,
    source AS dataset_name, NULL::VARCHAR AS dataset_url, lang AS language, NULL::DOUBLE AS language_score,
    n_chars AS n_char, NULL::BIGINT AS n_non_symbol_words, NULL::DOUBLE AS avg_word_length FROM {DOCS}""",
)
def delivery_format(spark, sf):
    df = docs(spark, sf).select(
        F.col("id").cast("string").alias("id"), "text", "source", F.col("source").alias("dataset_name"),
        F.col("lang").alias("language"), F.col("n_chars").alias("n_char"), "lang",
    )
    return rows.delivery_format(df, fill_missing=True)


@query(
    "profile",
    f"""SELECT 'n_chars' AS "column", count(n_chars) AS count, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS std,
    min(n_chars)::DOUBLE AS min, quantile_cont(n_chars, 0.25) AS q25, quantile_cont(n_chars, 0.5) AS q50,
    quantile_cont(n_chars, 0.75) AS q75, max(n_chars)::DOUBLE AS max FROM documents""",
)
def profile(spark, sf):
    out = rows.profile(docs(spark, sf), ["n_chars"])
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


PROFILED = {
    "l_orderkey": "l_orderkey", "line": "nullif(l_linenumber, 3)", "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice",
    "below": "l_discount - 0.05::DOUBLE", "rare": "CASE WHEN l_orderkey < 40 THEN l_tax END",
}


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x)::DOUBLE AS min,
    quantile_cont(x::DOUBLE, 0.25) AS q25, quantile_cont(x::DOUBLE, 0.5) AS q50, quantile_cont(x::DOUBLE, 0.75) AS q75, max(x)::DOUBLE AS max
    FROM (SELECT {sql} AS x FROM lineitem)""" for name, sql in PROFILED.items()
    ),
)
def profile_columns(spark, sf):
    """Six columns at once: whole numbers, fractions, negative ones, ties and nulls."""
    df = table(spark, sf, "lineitem").select(*[F.expr(sql.replace("::DOUBLE", "D")).alias(name) for name, sql in PROFILED.items()])
    return rows.profile(df).withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})



@query(
    "chunk_text",
    f"""SELECT id, source, (i - 1)::INTEGER AS chunk_idx, substring(text, (i - 1) * 700 + 1, 700) AS text
    FROM (SELECT *, unnest(range(1, ceil(length(text) / 700)::BIGINT + 1)) AS i FROM {DOCS})""",
)
def chunk_text(spark, sf):
    return rows.chunk_text(docs(spark, sf).select("id", "source", "text"), 700)


@query(
    "plan_file_split",
    f"""SELECT id, (floor(coalesce(sum(strlen(text)) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    / 100000))::BIGINT AS file_no FROM {DOCS}""",
)
def plan_file_split(spark, sf):
    return rows.plan_file_split(docs(spark, sf), 100_000, ["id"]).select("id", "file_no")


@query(
    "split_rows",
    f"""SELECT id, (i - 1)::INTEGER AS part_idx, parts[i] AS text FROM (SELECT id, parts, unnest(range(1, len(parts) + 1)) AS i
    FROM (SELECT id, string_split(text, chr(10)) AS parts FROM {DOCS}))""",
)
def split_rows(spark, sf):
    return rows.split_rows(docs(spark, sf).select("id", "text"))


@query(
    "combine_rows",
    """SELECT conv_id AS id, string_agg(text, chr(10) ORDER BY turn) AS text, arg_min(role, turn) AS role
    FROM conversations GROUP BY conv_id""",
)
def combine_rows(spark, sf):
    df = table(spark, sf, "conversations").withColumnRenamed("conv_id", "id")
    return rows.combine_rows(df, "id", "turn", "\n")


@query(
    "unicode_normalize",
    f"""SELECT id, nfc_normalize(t) <> t AS changed, length(nfc_normalize(t))::BIGINT AS n_char, md5(nfc_normalize(t)) AS digest
    FROM (SELECT id, {PLANT_DECOMPOSED} AS t FROM {DOCS})""",
)
def unicode_normalize(spark, sf):
    df = busy_docs(spark, sf).withColumn("text", F.replace("text", F.lit("\u00e9"), F.lit("e\u0301")))
    out = norm.with_changed_flag(df, norm.unicode_normalize)
    return out.select("id", "changed", F.length("text").cast("long").alias("n_char"), F.md5("text").alias("digest"))


# Two kinds of misreading, and right accents and dashes beside them.
WRONG = "caf\u00c3\u00a9 \u00e2\u20ac\u0153na\u00c3\u00afve\u00e2\u20ac\u009d \u00e2\u0080\u0094 \u00c3\u0178 \u00f0\u0178\u02dc\u20ac CAF\u00c9\u2014\u00c9\u00a0\u2026 "
RIGHT = "caf\u00e9 \u201cna\u00efve\u201d \u2014 \u00df \U0001f600 CAF\u00c9\u2014\u00c9\u00a0\u2026 "


@query(
    "fix_mojibake",
    f"""SELECT id, CASE id % 6 WHEN 2 THEN '{RIGHT}— ' || text WHEN 3 THEN 'é {RIGHT}' || text WHEN 4 THEN '{RIGHT}' || text ELSE text END AS text FROM {DOCS}""",
)
def fix_mojibake(spark, sf):
    """Misread texts come back: whole ones, once or twice misread, and parts of right texts."""
    text, kind = F.col("text"), F.col("id") % 6

    def misread(t):
        return F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")

    latin, windows = "".join(map(chr, norm.WINDOWS_1252.values())), "".join(norm.WINDOWS_1252)
    planted = (
        F.when(kind == 0, misread(text))
        .when(kind == 2, F.concat(F.lit(WRONG + "— "), text))
        .when(kind == 3, F.concat(F.lit("é " + WRONG), text))
        .when(kind == 4, F.concat(F.translate(misread(F.lit(RIGHT)), latin, windows), text))
        .when(kind == 5, misread(misread(text)))
        .otherwise(text)
    )
    return docs(spark, sf).select("id", norm.fix_mojibake(planted).alias("text"))


PLANTED = "replace(replace(text, ', ', '，'), '. ', '…')"


@query("normalize_punctuation", f"SELECT id, {punctuation_sql(PLANTED)} AS text FROM {DOCS}")
def normalize_punctuation(spark, sf):
    planted = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit("，")), F.lit(". "), F.lit("…"))
    return docs(spark, sf).select("id", norm.normalize_punctuation(planted).alias("text"))


@query(
    "normalize_whitespace",
    f"SELECT id, {whitespace_sql('replace(text, chr(32), chr(160))')} AS text FROM {DOCS}",
)
def normalize_whitespace(spark, sf):
    planted = F.replace("text", F.lit(" "), F.lit("\u00a0"))
    return docs(spark, sf).select("id", norm.normalize_whitespace(planted).alias("text"))


@query(
    "collapse_repeated_words",
    f"""SELECT id, array_to_string(list_transform({words_sql()}, lambda w, i: regexp_replace(w, '[^A-Za-z]', '', 'g') || (i - 1)), ' ') AS text
    FROM {DOCS}""",
)
def collapse_repeated_words(spark, sf):
    """Numbered words never repeat; every third is tripled and every fifth given seven times."""

    def planted(w, i):
        word = F.concat(F.regexp_replace(w, "[^A-Za-z]", ""), i.cast("string"))
        times = F.when(i % 5 == 0, 7).when(i % 3 == 0, 3).otherwise(1)
        return F.array_join(F.array_repeat(word, times), " ")

    numbered = F.array_join(F.transform(words(F.col("text")), planted), " ")
    return busy_docs(spark, sf).select("id", norm.collapse_repeated_words(numbered).alias("text"))


@query(
    "strip_bracket_tags",
    f"""SELECT id, regexp_replace(regexp_replace(text, ', ', ' [Music] ', 'g'),
    '\\s?\\[[a-zA-Z&;_à-üÀ-Ü\\s]{{0,15}}\\]', '', 'g') AS text FROM {DOCS}""",
)
def strip_bracket_tags(spark, sf):
    planted = F.replace("text", F.lit(", "), F.lit(" [Music] "))
    return docs(spark, sf).select("id", norm.strip_bracket_tags(planted).alias("text"))


@query(
    "patch_newline_spaces",
    f"SELECT id, regexp_replace(replace(text, chr(10), ' ' || chr(10) || '   '), ' \\n +', ' ' || chr(10), 'g') AS text FROM {DOCS}",
)
def patch_newline_spaces(spark, sf):
    planted = docs(spark, sf).select("id", F.replace("text", F.lit("\n"), F.lit(" \n   ")).alias("text"))
    return norm.apply_patches(planted, [norm.patch_newline_spaces])


@query(
    "text_metrics",
    f"""SELECT id, length(text)::BIGINT AS n_char, len(p)::BIGINT AS n_non_symbol_words,
    CASE WHEN len(p) > 0 THEN list_sum(list_transform(p, lambda w: length(w)))::DOUBLE / len(p) ELSE 0.0 END AS avg_word_length
    FROM (SELECT id, text, list_filter({words_sql()}, lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]')) AS p FROM {DOCS})""",
)
def text_metrics_(spark, sf):
    return text_metrics(busy_docs(spark, sf)).select("id", "n_char", "n_non_symbol_words", "avg_word_length")
