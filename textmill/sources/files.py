"""File-level checks and listings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.operators.ordering import global_row_number
from textmill.sources.digests import chained_digests, literal_path

STAGE_NAMES = [
    "data_splitting",
    "string_normalization",
    "heuristic_filtering",
    "toxic_language_detection",
    "deduplication",
    "pii_masking",
    "machine_translation",
    "llm_processing",
]
# Files of more bytes are not read by one task.
WHOLE = 1 << 29


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """Path and size of every file; the content column is pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", F.col("length").alias("size"))
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _footers_ok(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    def readable(path: str) -> bool:
        try:
            uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path
            filesystem, inner = pafs.FileSystem.from_uri(uri)
            with filesystem.open_input_file(inner) as handle:
                pq.ParquetFile(handle)
            return True
        except Exception:
            return False

    for batch in batches:
        yield batch.assign(valid=batch["path"].map(readable).astype(bool))


def audit_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per parquet file below ``path``: can its footer be opened?

    Only names travel; each task opens the footers of its own share of files.
    """
    names = list_files(spark, path).select("path")
    return names.mapInPandas(_footers_ok, "path string, valid boolean")


def audit_verdict(audit: DataFrame) -> DataFrame:
    """all_valid plus the list of bad files (invalid files only, so a short list)."""
    return audit.agg(
        F.coalesce(F.bool_and("valid"), F.lit(True)).alias("all_valid"),
        F.array_sort(F.collect_list(F.when(~F.col("valid"), F.col("path")))).alias("invalid_files"),
    )


def stage_audit(audit: DataFrame, stages: list[str] = STAGE_NAMES) -> DataFrame:
    """Verdict per stage folder of a run; stages without a folder are left out."""
    stage = F.regexp_extract("path", "/[^/]*(" + "|".join(stages) + ")[^/]*/", 1)
    folder = F.regexp_extract("path", "^(.*/[^/]*(?:" + "|".join(stages) + ")[^/]*)/", 1)
    return (
        audit.withColumns({"stage": stage, "folder": folder})
        .where(F.col("stage") != "")
        .groupBy("stage")
        .agg(
            F.min("folder").alias("path"),
            F.bool_and("valid").alias("all_valid"),
            F.array_sort(F.collect_list(F.when(~F.col("valid"), F.col("path")))).alias("invalid_files"),
        )
    )


def file_inventory(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """filename, size and SHA-256 of every file in the folder.

    Files of up to WHOLE bytes are read by one task each. Larger ones are digested split
    by split, so that no task reads or holds the whole of them.
    """

    def files(at: str | list[str]) -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "false")
            .load(at)
        )

    def whole(found: DataFrame) -> DataFrame:
        return found.select(
            file_name(F.col("path")).alias("filename"),
            F.col("length").alias("size"),
            F.sha2("content", 256).alias("file_sha256_hex_hash"),
        )

    found = files(path if path.endswith(".parquet") else f"{path.rstrip('/')}/{glob}")
    most = min(WHOLE, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    large = [(r.path, r.length) for r in found.where(F.col("length") > most).select("path", "length").collect()]
    if not large:
        return whole(found)
    digests = chained_digests(spark, large)
    rows = [(p.rsplit("/", 1)[-1], size, digests[p]) for p, size in large if p in digests]
    out = whole(found.where(F.col("length") <= most))
    out = out.unionByName(spark.createDataFrame(rows, "filename string, size long, file_sha256_hex_hash string"))
    left = [literal_path(p) for p, _ in large if p not in digests]
    return out.unionByName(whole(files(left))) if left else out


def delivery_names(files: DataFrame, prefix: str, path_col: str = "path") -> DataFrame:
    """Old path to new name: sorted files become prefix_0001.parquet, prefix_0002.parquet, ..."""
    numbered = global_row_number(files.select(path_col), [path_col], "_no")
    return numbered.select(
        path_col, F.format_string("%s_%04d.parquet", F.lit(prefix), F.col("_no")).alias("new_name")
    )
