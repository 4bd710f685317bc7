"""Scans, sinks and file-level operators."""

from pyspark.sql import functions as F

from textmill.operators import filters
from textmill.operators.stats import stage_counts
from textmill.registry.base import DOCS, docs, query, table
from textmill.session import scratch_path
from textmill.sources import files, reader, rolling, writer
from textmill.functions.text import with_parts


@query("read_documents", f"SELECT id, text, lang FROM {DOCS}")
def read_documents(spark, sf):
    df = reader.read_documents(spark, sf, glob="documents.parquet", id_key="doc_id")
    return df.select("id", "text", "lang")


@query("read_paths_file", f"SELECT id, n_chars FROM {DOCS}")
def read_paths_file(spark, sf):
    listing = scratch_path(spark, "paths")
    spark.createDataFrame([("documents.parquet",)], "value string").write.text(listing)
    return reader.read_paths_file(spark, listing, root=sf).select(F.col("doc_id").alias("id"), "n_chars")


@query("scan_skip_limit", f"SELECT id, n_chars FROM {DOCS} ORDER BY id LIMIT 500 OFFSET 100")
def scan_skip_limit(spark, sf):
    return reader.scan_skip_limit(docs(spark, sf).select("id", "n_chars"), skip=100, limit=500)


@query("rename_id", "SELECT doc_id AS id, source FROM documents")
def rename_id(spark, sf):
    df = table(spark, sf, "documents").withColumnRenamed("doc_id", "extraction_uid")
    return reader.rename_id(df, "extraction_uid").select("id", "source")


@query(
    "null_guard",
    f"""SELECT id, coalesce(nullif(text, 'That it.'), '') AS text,
    CASE WHEN lang = 'en' THEN '' ELSE '{{"original_language":"' || lang || '"}}' END AS extra FROM {DOCS}""",
)
def null_guard(spark, sf):
    df = docs(spark, sf).select(
        "id",
        F.when(F.col("text") != "That it.", F.col("text")).alias("text"),
        F.when(F.col("lang") != "en", F.to_json(F.struct(F.col("lang").alias("original_language")))).alias("extra"),
    )
    return reader.null_guard(df)


@query("expand_metadata", f"SELECT id, source, lang, n_chars, upper(lang) AS text FROM {DOCS}")
def expand_metadata(spark, sf):
    meta = F.struct("source", "lang", F.upper("lang").alias("text"))
    df = docs(spark, sf).select("id", "text", "n_chars", meta.alias("metadata"))
    return reader.expand_metadata(df)


@query("expand_metadata_forms", f"SELECT id, upper(lang) AS text, source, n_chars, CASE WHEN id % 3 = 2 AND id % 2 = 0 THEN 'x' END AS note FROM {DOCS}")
def expand_metadata_forms(spark, sf):
    """Structs, maps and JSON text whose objects differ; the metadata's text wins."""
    df, form = docs(spark, sf), F.col("id") % 3
    struct = df.where(form == 0).select("id", "text", F.struct("source", F.upper("lang").alias("text"), "n_chars").alias("metadata"))
    pairs = F.create_map(F.lit("source"), F.col("source"), F.lit("text"), F.upper("lang"), F.lit("n_chars"), F.col("n_chars").cast("string"))
    mapped = df.where(form == 1).select("id", "text", pairs.alias("metadata"))
    note = F.when(F.col("id") % 2 == 0, F.lit("x")).alias("note")
    json = F.to_json(F.struct("source", F.upper("lang").alias("text"), "n_chars", note))
    texts = df.where(form == 2).select("id", "text", json.alias("metadata"))
    out = reader.expand_metadata(texts)
    for part in (struct, mapped):
        flat = reader.expand_metadata(part)
        out = out.unionByName(flat.withColumn("n_chars", F.col("n_chars").cast("long")), allowMissingColumns=True)
    return out.select("id", "text", "source", "n_chars", "note")


@query("write_sized", f"SELECT source, count(*) AS n_rows, sum(length(text))::BIGINT AS n_char FROM {DOCS} GROUP BY source")
def write_sized(spark, sf):
    path = scratch_path(spark, "sized")
    writer.write_sized(docs(spark, sf), path, max_file_bytes=2**20)
    back = spark.read.parquet(path)
    return back.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_char")
    )


@query("write_rolling", f"SELECT count(*) AS n_rows, sum(length(text))::BIGINT AS n_char, true AS near_target, true AS same_digests FROM {DOCS}")
def write_rolling(spark, sf):
    """Files end at the target; the inventory of the writing tasks is that of the files read back."""
    path, target = scratch_path(spark, "rolled"), 2**17
    source = docs(spark, sf)
    rolling.write_rolling(source, path, target)
    written, read = rolling.written_inventory(spark, path), files.file_inventory(spark, path)
    short = F.count_if(F.col("size") < target) <= source.rdd.getNumPartitions()
    sizes = written.agg(F.sum("n_rows").alias("n_rows"), (short & (F.max("size") < 1.5 * target)).alias("near_target"))
    both = written.join(read, ["filename", "size", "file_sha256_hex_hash"], "full_outer")
    same = both.agg((F.count("n_rows") == F.count("*")).alias("same_digests"))
    chars = spark.read.parquet(path).agg(F.sum(F.length("text")).alias("n_char"))
    one = F.lit(1).alias("one")
    found = sizes.select(one, "*").join(same.select(one, "*"), "one").join(chars.select(one, "*"), "one")
    return found.select("n_rows", "n_char", "near_target", "same_digests")


NORDIC_REASON = r"""CASE WHEN CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE / length(text)
   ELSE 0 END > 0.2 THEN 'max_digit_fraction' WHEN length(text) < 50 THEN 'min_n_char' END"""


@query(
    "write_removed",
    f"""SELECT 'NordicPileQualityFilter' AS filter_module, {NORDIC_REASON} AS filter_reason, id
    FROM {DOCS} WHERE {NORDIC_REASON} IS NOT NULL""",
)
def write_removed(spark, sf):
    df, p = with_parts(docs(spark, sf))
    rules = filters.nordic_rules(p, min_mean_med_char=None, min_mean_med_word=None)
    judged = filters.annotate(df, "NordicPileQualityFilter", rules).select("id", "text", "filter_module", "filter_reason")
    path = scratch_path(spark, "removed")
    writer.write_removed(judged, path)
    back = spark.read.schema(judged.schema).parquet(f"{path}/removed_data")
    return back.select("filter_module", "filter_reason", "id")


@query("tee_write", f"SELECT lang, count(*) AS n_rows FROM {DOCS} GROUP BY lang")
def tee_write(spark, sf):
    copied = writer.tee_write(docs(spark, sf), scratch_path(spark, "tee"))
    return copied.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))


@query("overwrite_stage", f"SELECT lang, count(*) AS n_rows FROM {DOCS} WHERE lang <> 'en' GROUP BY lang")
def overwrite_stage(spark, sf):
    path = scratch_path(spark, "stage")
    writer.overwrite_stage(docs(spark, sf), path)
    writer.overwrite_stage(docs(spark, sf).where("lang <> 'en'"), path)
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))


TABLES = "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier".split()
NAMES = ", ".join(f"('{t}.parquet')" for t in TABLES)


@query("audit_files", f"SELECT name AS filename, true AS valid FROM (VALUES {NAMES}) t(name)")
def audit_files(spark, sf):
    return files.audit_files(spark, sf).select(files.file_name(F.col("path")).alias("filename"), "valid")


@query("file_inventory")
def file_inventory(spark, sf):
    return files.file_inventory(spark, sf)


@query(
    "delivery_names",
    f"SELECT name AS filename, printf('corpus_%04d.parquet', row_number() OVER (ORDER BY name)) AS new_name FROM (VALUES {NAMES}) t(name)",
)
def delivery_names(spark, sf):
    listed = files.list_files(spark, sf).select(files.file_name(F.col("path")).alias("filename"))
    return files.delivery_names(listed, "corpus", "filename")


@query(
    "stage_audit",
    "SELECT * FROM (VALUES ('data_splitting', true, 0::BIGINT), ('deduplication', true, 0::BIGINT)) t(stage, all_valid, n_invalid)",
)
def stage_audit(spark, sf):
    root = scratch_path(spark, "run")
    writer.overwrite_stage(docs(spark, sf), f"{root}/stage1_data_splitting")
    writer.overwrite_stage(docs(spark, sf).dropDuplicates(["text"]), f"{root}/stage2_deduplication")
    verdict = files.stage_audit(files.audit_files(spark, root))
    return verdict.select("stage", "all_valid", F.size("invalid_files").cast("long").alias("n_invalid"))


@query(
    "stage_counts",
    f"""SELECT lang, CASE WHEN {NORDIC_REASON} IS NOT NULL THEN 'NordicPileQualityFilter' END AS filter_module,
    {NORDIC_REASON} AS filter_reason, count(*) AS n_rows FROM {DOCS} GROUP BY ALL""",
)
def stage_counts_(spark, sf):
    df, p = with_parts(docs(spark, sf))
    rules = filters.nordic_rules(p, min_mean_med_char=None, min_mean_med_word=None)
    return stage_counts(filters.annotate(df, "NordicPileQualityFilter", rules), ["lang"])
