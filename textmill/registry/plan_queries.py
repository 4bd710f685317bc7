"""Delivery statistics, stages, chains and the delivery procedure."""

from pyspark.sql import functions as F

from textmill.functions.normalize import normalize_whitespace
from textmill.functions.text import drop_parts, text_metrics, with_parts, words
from textmill.operators import filters as flt, stats
from textmill.plans import stages
from textmill.plans.chain import curation_chain
from textmill.plans.delivery import deliver
from textmill.registry.base import DOCS, PARTS, busy_docs, docs, query, r6, table, words_sql
from textmill.registry.dedup_queries import CLUSTER_CTES
from textmill.registry.filter_queries import QUALITY_SQL, dup_sql, list_mean, list_median, planted_parts, repetition_ctes, CHARS, LINE_WORDS
from textmill.registry.io_queries import NORDIC_REASON
from textmill.registry.model_queries import (
    BIGRAM_CTES, RULED_THRESHOLD, SUMMARY_SQL, TOXIC_CTES, language_ctes, language_model, lead_model, rounded, ruled_toxicity_model,
    stand_in_translator, toxicity_model,
)
from textmill.registry.pii_queries import MASKED_SQL, grouped_ctes, planted
from textmill.registry.text_queries import punctuation_sql, whitespace_sql
from textmill.session import scratch_path
from textmill.sources.reader import null_guard
from textmill.sources.writer import write_sized

METRICS = f"""(SELECT 'documents.parquet' AS filename, id, source, lang AS language, length(text)::BIGINT AS n_char, len(p)::BIGINT AS n_non_symbol_words,
 CASE WHEN len(p) > 0 THEN list_sum(list_transform(p, lambda w: length(w)))::DOUBLE / len(p) ELSE 0.0 END AS avg_word_length,
 (id % 100) / 100.0::DOUBLE AS language_score, CASE id % 4 WHEN 0 THEN 'CC0' WHEN 1 THEN 'CC-BY-4.0' WHEN 2 THEN 'ODC-By' END AS license
 FROM (SELECT *, list_filter({words_sql()}, lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]')) AS p FROM {DOCS}))"""


def measured(spark, sf):
    """documents with the delivery columns; license and score follow from the id."""
    df = stats.with_file(docs(spark, sf))
    df = text_metrics(df).withColumns(
        {
            "language": F.col("lang"),
            "language_score": F.col("id") % 100 / 100.0,
            "license": F.when(F.col("id") % 4 == 0, "CC0").when(F.col("id") % 4 == 1, "CC-BY-4.0").when(F.col("id") % 4 == 2, "ODC-By"),
        }
    )
    return df.drop("n_chars", "lang")


def column_sql(name: str) -> str:
    v = f"{name}::DOUBLE"
    return f"""SELECT filename, '{name}' AS "column", round(sum({v}), 4) AS total, round(avg({v}), 6) AS mean, min({v}) AS min, max({v}) AS max,
    round(stddev_pop({v}), 6) AS std FROM {METRICS} GROUP BY filename"""


@query("column_stats", " UNION ALL ".join(column_sql(c) for c in stats.COUNT_COLUMNS))
def column_stats(spark, sf):
    out = stats.column_stats(measured(spark, sf), ["filename"])
    return out.select(
        "filename", "column", F.round("total", 4).alias("total"), r6("mean", "mean"), "min", "max", r6("std", "std")
    )


def spread_sql(name: str) -> str:
    return f"""round(avg({name}), 6) AS {name}_mean, min({name}) AS {name}_min, max({name}) AS {name}_max,
    round(stddev_pop({name}), 6) AS {name}_std"""


@query(
    "language_stats",
    f"""SELECT filename, language, count(language) AS language_count, sum(n_non_symbol_words)::BIGINT AS n_non_symbol_words_sum,
    {spread_sql('n_non_symbol_words')}, sum(n_char)::BIGINT AS n_char_sum, {spread_sql('n_char')}, {spread_sql('language_score')},
    round(avg(avg_word_length), 6) AS avg_word_length_mean, round(stddev_pop(avg_word_length), 6) AS avg_word_length_std
    FROM {METRICS} GROUP BY filename, language""",
)
def language_stats(spark, sf):
    out = stats.language_stats(measured(spark, sf), ["filename"])
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith(("_mean", "_std"))})


@query("distinct_licenses", f"SELECT DISTINCT filename, license FROM {METRICS}")
def distinct_licenses(spark, sf):
    return stats.distinct_licenses(measured(spark, sf), ["filename"])


@query(
    "schema_stats",
    """SELECT 'documents.parquet' AS filename, count(*) AS n_rows, 5 AS n_columns, 'doc_id,text,lang,source,n_chars' AS columns,
    'bigint,string,string,string,bigint' AS column_types FROM documents""",
)
def schema_stats(spark, sf):
    out = stats.schema_stats(stats.with_file(table(spark, sf, "documents")), ["filename"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("columns", "column_types")})


@query("dataset_stats")
def dataset_stats(spark, sf):
    folder = scratch_path(spark, "delivery")
    write_sized(measured(spark, sf).drop("filename"), folder, 2**20)
    return stats.dataset_stats(spark, folder)


@query(
    "collection_rollup",
    f"""SELECT language AS collection, source AS file, grouping_id(language, source)::BIGINT AS level, count(*) AS n_rows,
    sum(n_char)::BIGINT AS n_char_total, sum(n_non_symbol_words)::BIGINT AS n_words_total FROM {METRICS} GROUP BY ROLLUP(language, source)""",
)
def collection_rollup(spark, sf):
    df = measured(spark, sf).withColumnsRenamed({"language": "collection", "source": "file"})
    return stats.collection_rollup(df, "collection", "file")


@query(
    "heuristic_kept_by_lang",
    f"""SELECT lang, CASE WHEN r IS NOT NULL THEN 'Heuristics' END AS filter_module, r AS filter_reason, count(*) AS n_rows FROM (
    SELECT lang, coalesce({NORDIC_REASON}, CASE WHEN {dup_sql('lines')} > 0.35 THEN 'dup_line_frac' END) AS r
    FROM {planted_parts(whitespace_sql('text'))}) GROUP BY ALL""",
)
def heuristic_kept_by_lang(spark, sf):
    df = null_guard(busy_docs(spark, sf)).withColumn("text", normalize_whitespace(F.col("text")))
    df, p = with_parts(df)
    rules = flt.nordic_rules(p, min_mean_med_char=None, min_mean_med_word=None)
    rules += flt.line_repetition_rules(p, dup_para_frac=None, dup_line_char_frac=None, dup_para_char_frac=None)
    return stats.stage_counts(drop_parts(flt.annotate(df, "Heuristics", rules)), ["lang"])


@query(
    "data_splitting",
    f"""SELECT id, (i - 1)::INTEGER AS chunk_idx, substring(text, (i - 1) * 1000 + 1, 1000) AS text, lang, source, '' AS extra
    FROM (SELECT *, unnest(range(1, ceil(length(text) / 1000)::BIGINT + 1)) AS i FROM {DOCS})""",
)
def data_splitting(spark, sf):
    meta = F.struct("lang", "source").alias("metadata")
    df = table(spark, sf, "documents").select(F.col("doc_id").alias("extraction_uid"), "text", meta)
    return stages.data_splitting(df, line_chunk_size=1000).kept


NORMAL_SQL = whitespace_sql(punctuation_sql("nfc_normalize(text)"))


@query("string_normalization", f"SELECT id, {NORMAL_SQL} AS text FROM {DOCS}")
def string_normalization(spark, sf):
    return stages.string_normalization(busy_docs(spark, sf).select("id", "text")).kept


LINE_SHAPE = f"""CASE WHEN {list_mean(CHARS)} < 9 OR {list_median(CHARS)} < 9 THEN 'min_mean_med_char'
 WHEN {list_mean(LINE_WORDS)} < 2.1::DOUBLE OR {list_median(LINE_WORDS)} < 2.1::DOUBLE THEN 'min_mean_med_word' END"""


def heuristics_sql(text: str = "text") -> str:
    """Ends with verdict(id, filter_module, filter_reason)."""
    parts = planted_parts(text)
    return repetition_ctes().replace(PARTS, parts) + f""", ql AS (SELECT id, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'language' END AS lr,
  coalesce({NORDIC_REASON}, {LINE_SHAPE}) AS nr, {QUALITY_SQL} AS qr FROM {parts}),
 verdict AS (SELECT ql.id, CASE WHEN lr IS NOT NULL THEN 'LanguageFilter' WHEN nr IS NOT NULL THEN 'NordicPileQualityFilter'
   WHEN qr IS NOT NULL THEN 'GopherQualityFilter' WHEN coalesce(line_reason, gram_reason) IS NOT NULL THEN 'GopherRepetitionFilter' END AS filter_module,
   coalesce(lr, nr, qr, line_reason, gram_reason) AS filter_reason FROM ql JOIN rep ON rep.id = ql.id)"""


@query("heuristic_filtering", heuristics_sql() + " SELECT id, coalesce(filter_reason, 'kept') AS verdict FROM verdict")
def heuristic_filtering(spark, sf):
    df = busy_docs(spark, sf).withColumns({"language": F.col("lang"), "language_score": F.lit(1.0)})
    judged = stages.annotate_heuristics(df, languages=["en", "de", "fr"])
    return judged.select("id", F.coalesce("filter_reason", F.lit("kept")).alias("verdict"))


@query("pii_masking", grouped_ctes() + MASKED_SQL + " SELECT id, text FROM masked")
def pii_masking(spark, sf):
    return stages.pii_masking(planted(spark, sf).select("id", "text"), replacement_type="MARKER").kept.select("id", "text")


@query("toxic_language_detection")
def toxic_language_detection(spark, sf):
    out = stages.toxic_language_detection(busy_docs(spark, sf), toxicity_model(spark, sf)).kept
    return out.select("id", "ToxicLanguage")


@query("machine_translation")
def machine_translation(spark, sf):
    df = busy_docs(spark, sf).withColumn("extra", F.to_json(F.struct(F.col("lang").alias("original_language"))))
    done = stages.machine_translation(
        df, stand_in_translator, language_model(spark, sf), languages=["en", "de", "es", "fr"], language_threshold=0.0
    )
    return done.kept.select("id", "text").unionByName(done.removed.select("id", "text"))


@query("toxic_language_detection_ruled", TOXIC_CTES + f" SELECT d.id, count(score) AS n_spans FROM {DOCS} d LEFT JOIN spans s ON s.id = d.id GROUP BY d.id")
def toxic_language_detection_ruled(spark, sf):
    out = stages.toxic_language_detection(busy_docs(spark, sf), ruled_toxicity_model(), RULED_THRESHOLD).kept
    return out.select("id", F.size("ToxicLanguage").cast("long").alias("n_spans"))


def to_english_model():
    """Stand-in for a translation that leaves its mark on every e."""
    return lambda texts: [t.replace("e", "3") for t in texts]


NUMBERED_SQL = "array_to_string(list_transform(w, lambda x, i: regexp_replace(x, '[^A-Za-z]', '', 'g') || (i - 1)), ' ')"


@query(
    "machine_translation_verdicts",
    language_ctes(f"replace({NUMBERED_SQL}, 'e', '3')") + f""" SELECT d.id, CASE WHEN lang NOT IN ('de', 'fr') THEN 'extra_field'
   WHEN coalesce(language, '') NOT IN ('de') THEN 'language' WHEN coalesce(language_score, 0.0) < 0.9 THEN 'language_score' ELSE 'kept' END AS verdict,
   md5(CASE WHEN lang IN ('de', 'fr') THEN replace({NUMBERED_SQL}, 'e', '3') ELSE {NUMBERED_SQL} END) AS digest FROM base d LEFT JOIN det ON det.id = d.id""",
)
def machine_translation_verdicts(spark, sf):
    """Rows of two languages are translated; what does not read as German with some certainty is rejected.

    Words are numbered, so that the clean-up before has nothing to collapse.
    """
    numbered = F.transform(words(F.col("text")), lambda w, i: F.concat(F.regexp_replace(w, "[^A-Za-z]", ""), i.cast("string")))
    df = busy_docs(spark, sf).select(
        "id", F.array_join(numbered, " ").alias("text"), F.to_json(F.struct(F.col("lang").alias("original_language"))).alias("extra")
    )
    done = stages.machine_translation(
        df, to_english_model, language_model(spark, sf), allowed_values=["de", "fr"], languages=["de"], language_threshold=0.9
    )
    kept = done.kept.select("id", "text", F.lit("kept").alias("verdict"))
    rows = kept.unionByName(done.removed.select("id", "text", F.col("filter_reason").alias("verdict")))
    return rows.select("id", "verdict", F.md5("text").alias("digest"))


JUNK = r"([0-9°]{3,})|(\.(\w{2,4}))|(/\w+/\w+)|(WorldCat)|(Wikikids)"


@query(
    "llm_processing",
    f"""SELECT id, string_agg(line, chr(10) ORDER BY i) AS text FROM (SELECT id, i, parts[i] AS line FROM (
    SELECT id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT id, string_split(text, chr(10)) AS parts FROM {DOCS})))
    WHERE NOT regexp_matches(line, '{JUNK}') GROUP BY id""",
)
def llm_processing(spark, sf):
    done = stages.llm_processing(
        busy_docs(spark, sf).select("id", "text"), lead_model, language_model(spark, sf), regex_exp=JUNK,
        languages=["en", "de", "es", "fr"], language_threshold=0.0,
    )
    return done.kept.select("id", "text")


@query("quality_analysis", BIGRAM_CTES + SUMMARY_SQL)
def quality_analysis(spark, sf):
    return rounded(stages.quality_analysis(busy_docs(spark, sf), group=["lang"], fold=F.pmod("id", F.lit(2)))["summary"])


CHAIN_SQL = (
    f"""WITH RECURSIVE body AS (SELECT id, {NORMAL_SQL} AS text FROM {DOCS}),
 judged AS ({heuristics_sql(NORMAL_SQL)} SELECT id, filter_reason FROM verdict),
 passed AS (SELECT body.id, body.text FROM body JOIN judged ON judged.id = body.id WHERE filter_reason IS NULL), """
    + CLUSTER_CTES.replace("WITH RECURSIVE ", "").replace(DOCS, "passed")
    + """ SELECT id, text FROM passed WHERE id IN (SELECT min(id) FROM passed GROUP BY text)
 AND id NOT IN (SELECT id FROM cl WHERE id <> cluster_id)"""
)


@query("curation_chain", CHAIN_SQL)
def curation_chain_(spark, sf):
    """Split, normalise, filter, deduplicate; the border after the filters is written."""
    source = table(spark, sf, "documents").select(
        F.col("doc_id").alias("extraction_uid"), "text", F.col("lang").alias("language"), F.lit(1.0).alias("language_score")
    )
    config = {
        "input_from_previous_output": True,
        "stages": [
            {"stage": "data_splitting"},
            {"stage": "string_normalization"},
            {"stage": "heuristic_filtering", "languages": ["en", "de", "fr"], "output_folder": scratch_path(spark, "chain")},
            {"stage": "deduplication", "bit_precision": 32},
        ],
    }
    return curation_chain(spark, config, source).kept.select("id", "text")


@query("chain_counters", heuristics_sql() + " SELECT coalesce(filter_reason, 'kept') AS reason, count(*) AS n_rows FROM verdict GROUP BY ALL")
def chain_counters(spark, sf):
    """What the chain counted while it wrote the filtered rows."""
    source = table(spark, sf, "documents").select(
        F.col("doc_id").alias("extraction_uid"), "text", F.col("lang").alias("language"), F.lit(1.0).alias("language_score")
    )
    steps = [{"stage": "data_splitting"}, {"stage": "heuristic_filtering", "languages": ["en", "de", "fr"], "output_folder": scratch_path(spark, "counted")}]
    counted = curation_chain(spark, {"stages": steps}, source).counters["2_heuristic_filtering"]
    assert counted["total"] == counted["forwarded"] + sum(counted["removed"].values())
    rows = [("kept", counted["forwarded"]), *((reason, n) for (_, reason), n in counted["removed"].items())]
    return spark.createDataFrame(rows, "reason string, n_rows long")


@query("delivery", f"SELECT count(*) AS n_rows, sum(length(text))::BIGINT AS n_char, true AS valid, true AS named FROM {DOCS}")
def delivery(spark, sf):
    source, target = scratch_path(spark, "collection"), scratch_path(spark, "delivered")
    write_sized(measured(spark, sf).drop("filename"), source)
    listed = deliver(spark, source, target, "corpus", 2**20)
    chars = F.filter("column_stats", lambda c: c["column"] == "n_char")[0]["total"].cast("long")
    return listed.agg(
        F.sum("n_rows").alias("n_rows"), F.sum(chars).alias("n_char"), F.bool_and("valid").alias("valid"),
        F.bool_and(F.col("new_name").rlike("^corpus_[0-9]{4}\\.parquet$")).alias("named"),
    )
