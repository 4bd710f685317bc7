"""Delivery of a finished collection: patch, audit, name, format, measure, audit again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.functions.normalize import apply_patches, patch_newline_spaces
from textmill.operators.rows import delivery_format
from textmill.operators.stats import dataset_stats
from textmill.sources.files import audit_files, audit_verdict, delivery_names, list_files
from textmill.sources.reader import read_documents
from textmill.sources.writer import STAGE_FILE_BYTES, write_sized


def deliver(
    spark: SparkSession, source: str, target: str, prefix: str, max_file_bytes: int = STAGE_FILE_BYTES
) -> DataFrame:
    """Write the formatted collection to ``target`` and return one row per delivered file.

    Stops when the source holds unreadable files. Names are a mapping: the data
    files keep the names Spark gave them, ``new_name`` is the one to publish.
    """
    before = audit_verdict(audit_files(spark, source)).first()
    if not before.all_valid:
        raise ValueError(f"unreadable files in {source}: {before.invalid_files}")
    documents = delivery_format(apply_patches(read_documents(spark, source), [patch_newline_spaces]))
    write_sized(documents, target, max_file_bytes, mode="overwrite")
    files = list_files(spark, target, recursive=False)
    names = delivery_names(files, prefix)
    audit = audit_files(spark, target)
    file_of = F.element_at(F.split("path", "/"), -1)
    listed = names.join(audit, "path").select(file_of.alias("filename"), "new_name", "valid")
    return listed.join(dataset_stats(spark, target), "filename")
