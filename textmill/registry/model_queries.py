"""Language, toxicity and perplexity models; batched inference."""

from pyspark.sql import functions as F

from textmill.functions.fixed_values import PARAGRAPH_PROMPT
from textmill.operators import filters as flt, inference, language as lng, perplexity as ppl, toxicity
from textmill.operators.language import BUCKETS, calibrate, calibration_examples, fit_language_model
from textmill.operators.stats import with_file
from textmill.registry.base import DOCS, busy_docs, docs, query, table, words_sql
from textmill.session import materialize, scratch_path


def language_model(spark, sf):
    """Counted on the even ids, calibrated on examples cut from the odd ones."""
    rows = busy_docs(spark, sf)
    even = F.pmod("id", F.lit(2)) == 0
    return calibrate(fit_language_model(rows.where(even)), calibration_examples(rows.where(~even), step=2))


def language_ctes(judged: str = "text") -> str:
    """Ends with det(id, language, language_score) of every document's ``judged`` text."""
    return f"""WITH base AS (SELECT id, lang, text, {words_sql()} AS w FROM {DOCS}),
 cuts AS (SELECT id, j, lang, w, 1 + (id * 31 + j * 17) % {lng.EXCERPT_WORDS} AS n FROM base, range({lng.EXCERPTS}) t(j) WHERE id % 2 = 1),
 starts AS (SELECT *, (id * 13 + j * 101) % greatest(1, len(w) - n + 1) AS s FROM cuts),
 mixes AS (SELECT a.id, j, a.lang AS la, b.lang AS lb, a.w AS wa, b.w AS wb, least(len(a.w), 1 + (a.id * 7 + j * 29) % {lng.MIX_WORDS}) AS na,
   least(len(b.w), 1 + (a.id * 11 + j * 23) % {lng.MIX_WORDS}) AS nb FROM base a JOIN base b ON b.id = a.id + 2 AND b.lang <> a.lang, range({lng.MIXES}) t(j) WHERE a.id % 2 = 1),
 ex AS (SELECT id, -1 AS j, lang AS label, text FROM base
   UNION ALL SELECT id, j, lang, array_to_string(w[s + 1:s + n], ' ') FROM starts
   UNION ALL SELECT id, -2, lang, {judged} FROM base
   UNION ALL SELECT id, {lng.EXCERPTS} + j, CASE WHEN na >= nb THEN la ELSE lb END, array_to_string(list_concat(wa[1:na], wb[1:nb]), ' ') FROM mixes),
 gr AS (SELECT id, j, label,
   (ord(c[i]) * 4398046511104 + ord(c[i + 1]) * 2097152 + ord(c[i + 2])) % {BUCKETS} AS g FROM (
   SELECT id, j, label, c, unnest(range(1, len(c) - 1)) AS i FROM (SELECT id, j, label, string_split(lower(text), '') AS c FROM ex) WHERE len(c) >= 3)),
 tri AS (SELECT id, j, any_value(label) AS label, g, count(*) AS c FROM gr GROUP BY id, j, g),
 cnt AS (SELECT label AS lang, g, sum(c) AS c FROM tri WHERE j = -1 AND id % 2 = 0 GROUP BY label, g),
 tot AS (SELECT lang, sum(c) AS n FROM cnt GROUP BY lang),
 voc AS (SELECT DISTINCT g FROM cnt),
 size AS (SELECT count(*) AS v FROM voc),
 train AS (SELECT lang FROM base WHERE id % 2 = 0),
 pri AS (SELECT lang, round((ln((count(*) + 1)::DOUBLE) - ln(((SELECT count(*) FROM train) + (SELECT count(*) FROM tot))::DOUBLE)) * 1000000)::BIGINT AS pi FROM train GROUP BY lang),
 theta AS (SELECT tot.lang, voc.g, round((ln((coalesce(c, 0) + 1)::DOUBLE) - ln((n + v)::DOUBLE)) * 1000000)::BIGINT AS t
   FROM voc CROSS JOIN tot CROSS JOIN size LEFT JOIN cnt ON cnt.g = voc.g AND cnt.lang = tot.lang),
 keys AS (SELECT id, j, any_value(label) AS label, sum(c) AS n FROM tri GROUP BY id, j),
 lead AS (SELECT tri.id, tri.j, theta.lang, sum(tri.c * t) AS s FROM tri JOIN theta ON theta.g = tri.g GROUP BY ALL),
 sc AS (SELECT k.id, k.j, k.label, k.n, pri.lang, pi + coalesce(s, 0) AS s FROM keys k CROSS JOIN pri LEFT JOIN lead l ON l.id = k.id AND l.j = k.j AND l.lang = pri.lang),
 best AS (SELECT id, j, any_value(label) AS label, any_value(n) AS n, arg_max(lang, s) AS language, list_reverse_sort(list(s)) AS s FROM sc GROUP BY id, j),
 cell AS (SELECT *, least({lng.LENGTHS - 1}, length(bin(n::BIGINT)) - 1) AS len, least({lng.LEADS - 1}, (s[1] - s[2]) * {lng.STEPS} // (n * 1000000)) AS led FROM best),
 seen AS (SELECT len, led, count(*) FILTER (language = label) AS r, count(*) AS n FROM cell WHERE id % 2 = 1 AND j > -2 GROUP BY len, led),
 dense AS (SELECT x.len, y.led, 0.5::DOUBLE + coalesce(r, 0) AS r, 1.0::DOUBLE + coalesce(n, 0) AS n
   FROM range({lng.LENGTHS}) x(len) CROSS JOIN range({lng.LEADS}) y(led) LEFT JOIN seen ON seen.len = x.len AND seen.led = y.led),
 cum AS (SELECT len, led, r, n, sum(r) OVER w AS cr, sum(n) OVER w AS cn FROM dense WINDOW w AS (PARTITION BY len ORDER BY led)),
 means AS (SELECT a.len, a.led AS lo, z.led AS hi, (z.cr - a.cr + a.r) / (z.cn - a.cn + a.n) AS m FROM cum a JOIN cum z ON z.len = a.len AND z.led >= a.led),
 least_of AS (SELECT d.len, d.led, m.lo, min(m.m) AS m FROM dense d JOIN means m ON m.len = d.len AND m.lo <= d.led AND m.hi >= d.led GROUP BY ALL),
 share AS (SELECT len, led, max(m) AS share FROM least_of GROUP BY len, led),
 det AS (SELECT id, language, round(share, 4) AS language_score FROM cell JOIN share ON share.len = cell.len AND share.led = cell.led WHERE j = -2)"""


LANGUAGE_CTES = language_ctes()


@query(
    "detect_language",
    LANGUAGE_CTES + f" SELECT d.id, language, coalesce(language_score, 0.0) AS language_score FROM {DOCS} d LEFT JOIN det ON det.id = d.id",
)
def detect_language(spark, sf):
    out = language_model(spark, sf).detect(busy_docs(spark, sf))
    return out.select("id", "language", F.round("language_score", 4).alias("language_score"))


@query(
    "language_filter",
    LANGUAGE_CTES + f""" SELECT d.id, CASE WHEN coalesce(language, '') NOT IN ('en', 'de') THEN 'language'
    WHEN coalesce(language_score, 0.0) < 0.65 THEN 'language_score' END AS filter_reason FROM {DOCS} d LEFT JOIN det ON det.id = d.id""",
)
def language_filter(spark, sf):
    out = language_model(spark, sf).detect(busy_docs(spark, sf))
    # Rounded as in SQL, so that both see the same side of the limit.
    out = out.withColumn("language_score", F.round("language_score", 4))
    return flt.language_filter(out, ["en", "de"], 0.65).select("id", "filter_reason")


@query(
    "pre_language_filter",
    f"SELECT id, CASE WHEN lang NOT IN ('en') THEN 'language' END AS filter_reason FROM {DOCS}",
)
def pre_language_filter(spark, sf):
    df = docs(spark, sf).withColumns({"language": F.col("lang"), "language_score": F.lit(1.0)})
    return flt.language_filter(df, ["en"], 0.65).select("id", "filter_reason")


def toxicity_model(spark, sf):
    labelled = docs(spark, sf).join(
        table(spark, sf, "labels").withColumnRenamed("doc_id", "id"), "id"
    )
    return toxicity.fit_toxicity_model(labelled)


@query("toxic_spans")
def toxic_spans(spark, sf):
    out = toxicity.toxic_spans(busy_docs(spark, sf), toxicity_model(spark, sf), threshold=0.9)
    return out.select("id", "ToxicLanguage")


@query("toxic_doc_flag")
def toxic_doc_flag(spark, sf):
    out = toxicity.toxic_spans(busy_docs(spark, sf), toxicity_model(spark, sf), threshold=0.9)
    return toxicity.toxic_doc_flag(out).select("id", "is_toxic", "max_toxicity")


# A model with weights by a rule: sums of its 512ths have one value in whatever order they are added.
RULED_WEIGHT = "((({0}) * 7919) % 2001 - 1000) / 512.0"
RULED_INTERCEPT, RULED_THRESHOLD = -2.0, 0.9


def ruled_toxicity_model():
    return toxicity.ToxicityModel([((b * 7919) % 2001 - 1000) / 512.0 for b in range(toxicity.BUCKETS)], RULED_INTERCEPT)


# The hash of a word: a polynomial of its bytes modulo 2^64, mixed (toxicity._hashed).
_M = "18446744073709551616::UHUGEINT"
PIECE = rf"(?s)(?:[^.!?\n]{{1,256}}[.!?\n]*[ ]*|[.!?\n]+[ ]*)"
TOXIC_CTES = rf"""WITH long_pieces AS (SELECT id, regexp_extract_all(text, '{PIECE}') AS p FROM {DOCS}),
 pieces AS (SELECT id, flatten(list_transform(p, lambda s: regexp_extract_all(s, '(?s).{{1,256}}'))) AS p FROM long_pieces),
 piece AS (SELECT id, k, p[k] AS sentence, coalesce(list_sum(list_transform(p[1:k - 1], lambda s: length(s))), 0)::BIGINT AS start_index
   FROM (SELECT id, p, unnest(range(1, len(p) + 1)) AS k FROM pieces)),
 used AS (SELECT id, k, unnest(regexp_extract_all(sentence, '[A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS w FROM piece),
 bytes AS (SELECT w, list_transform(range(1, strlen(w) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::UHUGEINT) AS b
   FROM (SELECT DISTINCT w FROM used)),
 folded AS (SELECT w, list_reduce(list_concat([{{'h': 0::UHUGEINT, 'p': 6364136223846793005::UHUGEINT, 'b': 0::UHUGEINT}}],
     list_transform(b, lambda x: {{'h': 0::UHUGEINT, 'p': 1::UHUGEINT, 'b': CASE WHEN x BETWEEN 65 AND 90 THEN x + 32 ELSE x END}})),
   lambda a, x: {{'h': (a.h + (((x.b + 1) * 11400714819323198485::UHUGEINT) % {_M}) * a.p % {_M}) % {_M},
     'p': a.p * 6364136223846793005::UHUGEINT % {_M}, 'b': 0::UHUGEINT}}).h AS h FROM bytes),
 mixed AS (SELECT w, xor(h::UBIGINT, (h // 4294967296)::UBIGINT)::UHUGEINT AS h FROM folded),
 bucket AS (SELECT w, ((h * 13787848793156543929::UHUGEINT % {_M}) // 1099511627776 % {toxicity.BUCKETS})::BIGINT AS b FROM mixed),
 logit AS (SELECT id, k, sum({RULED_WEIGHT.format("b")}) AS x FROM used JOIN bucket USING (w) GROUP BY id, k),
 scored AS (SELECT id, k, start_index, sentence, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({RULED_INTERCEPT}::DOUBLE + coalesce(x, 0)))) AS score
   FROM piece LEFT JOIN logit USING (id, k)),
 spans AS (SELECT * FROM scored WHERE score >= {RULED_THRESHOLD})"""


@query("toxic_spans_ruled", TOXIC_CTES + " SELECT id, start_index, sentence, 'toxic' AS label, round(score, 9) AS score FROM spans")
def toxic_spans_ruled(spark, sf):
    out = toxicity.toxic_spans(busy_docs(spark, sf), ruled_toxicity_model(), RULED_THRESHOLD)
    spans = out.select("id", F.explode("ToxicLanguage").alias("x")).select("id", "x.*")
    return spans.withColumn("score", F.round("score", 9))


@query(
    "toxic_doc_flag_ruled",
    TOXIC_CTES + f" SELECT d.id, count(score) > 0 AS is_toxic, round(max(score), 9) AS max_toxicity FROM {DOCS} d LEFT JOIN spans s ON s.id = d.id GROUP BY d.id",
)
def toxic_doc_flag_ruled(spark, sf):
    out = toxicity.toxic_spans(busy_docs(spark, sf), ruled_toxicity_model(), RULED_THRESHOLD)
    return toxicity.toxic_doc_flag(out).select("id", "is_toxic", F.round("max_toxicity", 9).alias("max_toxicity"))


# Even ids are scored by the counts of odd ones and the other way round (side is the fold that is scored).
BIGRAM_CTES = f"""WITH w AS (SELECT id, lang, {words_sql()} AS words FROM {DOCS}),
 b AS (SELECT id, lang, id % 2 AS side, words[i] AS w1, words[i + 1] AS w2 FROM (SELECT *, unnest(range(1, len(words))) AS i FROM w)),
 pr AS (SELECT 1 - side AS side, w1, w2, count(*) AS n_pair FROM b GROUP BY ALL),
 fi AS (SELECT 1 - side AS side, w1, count(*) AS n_first FROM b GROUP BY ALL),
 vo AS (SELECT 1 - side AS side, count(*) AS v FROM (SELECT side, w1 FROM b UNION SELECT side, w2 FROM b) GROUP BY ALL),
 lp AS (SELECT id, lang, round(ln(coalesce(n_pair, 0) + 0.1::DOUBLE) * 1000000)::BIGINT - round(ln(coalesce(n_first, 0) + 0.1::DOUBLE * v) * 1000000)::BIGINT AS micro
   FROM b LEFT JOIN pr USING (side, w1, w2) LEFT JOIN fi USING (side, w1) JOIN vo USING (side)),
 pp AS (SELECT id, lang, count(*) AS n_bigrams, exp(-(sum(micro)::DOUBLE / 1000000 / count(*))) AS perplexity FROM lp GROUP BY id, lang)"""


def scored(spark, sf):
    """Even ids are scored by the counts of odd ones and odd ids by those of even ones, so unseen bigrams occur."""
    return ppl.fold_perplexity(busy_docs(spark, sf), "id", ["lang"], F.pmod("id", F.lit(2)))


@query("perplexity", BIGRAM_CTES + " SELECT id, lang, n_bigrams, round(perplexity, 6) AS perplexity FROM pp")
def perplexity(spark, sf):
    return scored(spark, sf).withColumn("perplexity", F.round("perplexity", 6))


SUMMARY_SQL = """ SELECT lang, count(*) AS n, round(sum(perplexity), 4) AS total, round(avg(perplexity), 4) AS mean, round(min(perplexity), 4) AS min,
 round(max(perplexity), 4) AS max, round(stddev_pop(perplexity), 4) AS std FROM pp GROUP BY lang"""


def rounded(df):
    return df.select("lang", "n", *[F.round(c, 4).alias(c) for c in ("total", "mean", "min", "max", "std")])


@query("perplexity_summary", BIGRAM_CTES + SUMMARY_SQL)
def perplexity_summary(spark, sf):
    return rounded(ppl.perplexity_summary(scored(spark, sf), ["lang"]))


@query(
    "perplexity_histogram",
    BIGRAM_CTES + """ SELECT lang, value, n FROM (SELECT lang, value, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, value) AS r
    FROM (SELECT lang, round(perplexity) AS value, count(*) AS n FROM pp GROUP BY lang, round(perplexity))) WHERE r <= 100000""",
)
def perplexity_histogram(spark, sf):
    return ppl.perplexity_histogram(scored(spark, sf), ["lang"])


@query("merge_stats", BIGRAM_CTES + SUMMARY_SQL)
def merge_stats(spark, sf):
    return rounded(ppl.merge_stats(ppl.partial_stats(scored(spark, sf), ["lang"]), ["lang"]))


@query(
    "merge_histograms",
    BIGRAM_CTES + """ SELECT lang, value, n FROM (SELECT lang, value, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, value) AS r
    FROM (SELECT lang, round(perplexity / 100) * 100 AS value, count(*) AS n FROM pp GROUP BY ALL)) WHERE r <= 5""",
)
def merge_histograms(spark, sf):
    """The five most frequent hundreds of perplexity per language, merged from sixteen shards."""
    shards = materialize(ppl.partial_histograms(scored(spark, sf), ["lang"], F.pmod(F.xxhash64("id"), F.lit(16)), -2), "shards")
    return ppl.merge_histograms(shards, ["lang"], 5)


def stand_in_translator():
    """Stand-in for a translation model."""
    return lambda texts: [t.replace("e", "3") for t in texts]


def lead_model():
    """Stand-in for a text generator: answers with the prompt's own sentences."""
    return lambda prompts: [p.split("Sentences:\n", 1)[-1].rsplit("\n\nParagraph:", 1)[0] for p in prompts]


@query("batched_inference", f"SELECT id, replace(text, 'e', '3') AS text FROM {DOCS}")
def batched_inference(spark, sf):
    return inference.apply_model(busy_docs(spark, sf).select("id", "text"), stand_in_translator, 32)


@query("bucketed_inference", f"SELECT id, replace(text, 'e', '3') AS text FROM {DOCS}")
def bucketed_inference(spark, sf):
    """Batches of similar length, rows in their order."""
    return inference.bucketed_model(docs(spark, sf).select("id", "text"), stand_in_translator, 32)


@query("ledgered_inference", f"SELECT id, text, replace(text, 'e', '3') AS answer FROM {DOCS}")
def ledgered_inference(spark, sf):
    """Half of the rows first; the second job infers only what the ledger does not hold."""
    rows, ledger = docs(spark, sf).select("id", "text"), scratch_path(spark, "ledger")
    inference.ledgered_model(rows.where("id % 2 = 0"), stand_in_translator, ledger, "stand-in", rounds=2, out="answer")
    return inference.ledgered_model(rows, stand_in_translator, ledger, "stand-in", rounds=2, out="answer")


@query("translate", f"SELECT id, replace(text, 'e', '3') AS text FROM {DOCS}")
def translate(spark, sf):
    return inference.translate(busy_docs(spark, sf).select("id", "text"), stand_in_translator)


@query(
    "translate_dry_run",
    f"""SELECT 'documents.parquet' AS filename, count(*) AS n_docs, sum(ceil(length(text) / 1024))::BIGINT AS n_chunks,
    ceil(sum(ceil(length(text) / 1024)) / 32)::BIGINT AS n_batches FROM {DOCS}""",
)
def translate_dry_run(spark, sf):
    return inference.translate_dry_run(with_file(docs(spark, sf)), "filename")


@query(
    "stop_at",
    f"""SELECT id, replace(substring(text, 1, 32 * 64), 'e', '3') AS text FROM (SELECT * FROM {DOCS} ORDER BY id LIMIT 200)""",
)
def stop_at(spark, sf):
    """The trial-run options: the first 200 rows, one batch of 32 chunks each."""
    first = docs(spark, sf).select("id", "text").orderBy("id").limit(200)
    return inference.translate(first, stand_in_translator, chunk_size=64, batch_stop_at=1)


PROMPT_SQL = "replace('" + PARAGRAPH_PROMPT.replace("'", "''").replace("\n", "' || chr(10) || '") + "', '{text}', text)"


@query("llm_prompt", f"SELECT id, {PROMPT_SQL} AS prompt, text AS answer FROM {DOCS}")
def llm_prompt(spark, sf):
    df = busy_docs(spark, sf).withColumn("prompt", inference.fill_prompt(PARAGRAPH_PROMPT, F.col("text")))
    return inference.apply_model(df, lead_model, 1000, "prompt", "answer").select("id", "prompt", "answer")
