"""Delivery statistics per file, language and collection."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from textmill.operators.filters import REASONS
from textmill.sources.files import file_inventory, list_files

COUNT_COLUMNS = ["n_non_symbol_words", "n_char", "avg_word_length"]
SAMPLE_FILES = 3


def with_file(df: DataFrame) -> DataFrame:
    """Add the source file's name to a fresh scan."""
    return df.withColumn("filename", F.col("_metadata.file_name"))


def with_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed nulls for absent columns, so older deliveries can be measured too."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    )


def _spread(name: str, prefix: str | None = None) -> list[Column]:
    p = f"{prefix or name}_"
    c = F.col(name)
    return [
        F.avg(c).alias(p + "mean"), F.min(c).alias(p + "min"), F.max(c).alias(p + "max"),
        F.stddev_pop(c).alias(p + "std"),
    ]


def column_stats(df: DataFrame, by: list[str], columns: list[str] = COUNT_COLUMNS) -> DataFrame:
    """Long form: one row per group and column. std is the population one; absent columns give no row."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of {columns} is in the table")
    long = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in present])
        ).alias("x"),
    ).select(*by, "x.column", "x.v")
    return long.groupBy(*by, "column").agg(
        F.sum("v").alias("total"), F.avg("v").alias("mean"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.stddev_pop("v").alias("std"),
    )


def language_stats(df: DataFrame, by: list[str]) -> DataFrame:
    """Per language; null forms a group whose count of non-null languages is 0."""
    return df.groupBy(*by, "language").agg(
        F.count("language").alias("language_count"),
        F.sum("n_non_symbol_words").alias("n_non_symbol_words_sum"), *_spread("n_non_symbol_words"),
        F.sum("n_char").alias("n_char_sum"), *_spread("n_char"),
        *_spread("language_score"),
        F.avg("avg_word_length").alias("avg_word_length_mean"),
        F.stddev_pop("avg_word_length").alias("avg_word_length_std"),
    )


def distinct_licenses(df: DataFrame, by: list[str]) -> DataFrame:
    """Distinct licenses per file, null included; a missing column is an error."""
    if "license" not in df.columns:
        raise ValueError("the table has no license column")
    return df.select(*by, "license").distinct()


def schema_stats(df: DataFrame, by: list[str]) -> DataFrame:
    """n_rows, n_columns, names and types per file."""
    fields = [f for f in df.schema.fields if f.name not in by]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumns(
        {
            "n_columns": F.lit(len(fields)),
            "columns": F.array(*[F.lit(f.name) for f in fields]),
            "column_types": F.array(*[F.lit(f.dataType.simpleString()) for f in fields]),
        }
    )


def dataset_stats(spark: SparkSession, path: str, sample: bool = False) -> DataFrame:
    """One row per file: size, checksum, schema, licenses, column and language statistics.

    All parts but the licenses come from map-side combined aggregates; groups
    are files, columns and languages, so they are few.
    """
    inventory = file_inventory(spark, path)
    if sample:
        names = list_files(spark, path, recursive=False).select(
            F.element_at(F.split("path", "/"), -1).alias("filename")
        )
        inventory = inventory.join(F.broadcast(names.orderBy("filename").limit(SAMPLE_FILES)), "filename", "left_semi")
    root = path if path.endswith(".parquet") else f"{path.rstrip('/')}/*.parquet"
    df = with_file(spark.read.parquet(root))
    width = len(df.columns) - 1
    df = with_missing(
        df,
        {"license": "string", "language": "string", "language_score": "double",
         "n_char": "bigint", "n_non_symbol_words": "bigint", "avg_word_length": "double"},
    )
    by = ["filename"]

    def nested(stats: DataFrame, name: str) -> DataFrame:
        inner = F.struct(*[c for c in stats.columns if c not in by])
        return stats.groupBy(*by).agg(F.array_sort(F.collect_list(inner)).alias(name))

    out = inventory.join(
        schema_stats(df.select(*df.columns[: width + 1]), by), by
    )
    out = out.join(nested(distinct_licenses(df, by), "licenses"), by)
    out = out.join(nested(column_stats(df, by), "column_stats"), by)
    return out.join(nested(language_stats(df, by), "language_stats"), by)


def collection_rollup(df: DataFrame, collection: str, file: str) -> DataFrame:
    """The same totals per file, per collection and over everything."""
    return df.rollup(collection, file).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_char").alias("n_char_total"),
        F.sum("n_non_symbol_words").alias("n_words_total"),
    )


def stage_counts(annotated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per filter and reason; kept rows have null in both."""
    return annotated.groupBy(*(by or []), "filter_module", "filter_reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def stage_totals(annotated: DataFrame) -> DataFrame:
    """total and forwarded counters of a stage."""
    return annotated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("filter_reason").isNull()).alias("forwarded"),
    )


def observed_counts(annotated: DataFrame, name: str = "stage") -> tuple[DataFrame, Callable[[], dict]]:
    """The same rows, and what they turn out to be: total, forwarded and rows per module and reason.

    The counts are taken while the rows pass, by whatever action comes first; the
    function returns them after it. Reasons are those the filters have noted in the column.
    """
    noted = annotated.schema["filter_reason"].metadata.get(REASONS, []) if "filter_reason" in annotated.columns else []
    reasons = list(dict.fromkeys(tuple(r.split(":", 1)) for r in noted))
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    is_kept = F.col("filter_reason").isNull() if "filter_reason" in annotated.columns else F.lit(True)
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(is_kept).alias("forwarded")]
    for i, (module, reason) in enumerate(reasons):
        counts.append(F.count_if((F.col("filter_module") == module) & (F.col("filter_reason") == reason)).alias(f"r{i}"))

    def found() -> dict:
        got = seen.get
        per = {key: got[f"r{i}"] for i, key in enumerate(reasons) if got[f"r{i}"]}
        return {"total": got["total"], "forwarded": got["forwarded"], "removed": per}

    return annotated.observe(seen, *counts), found
