"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key with more than ``hot_rows`` rows and its number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)


def salted_join(
    big: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which rows of hot keys of ``big`` are spread over several tasks.

    A key gets as many salts as it has times ``hot_rows`` rows. Exact: only the
    matching rows of ``table`` are repeated, once per salt. ``spread`` names
    columns of ``big`` that differ between rows of one key; ``hot`` may bring
    the result of hot_keys when it is known already. Adaptive execution chooses
    how the hot keys are joined.
    """
    if hot is None:
        hot = hot_keys(big, keys, hot_rows)
    hot = hot.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    left = big.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
    right = table.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], how).drop("_salt")


def keep_smallest(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """One row per key, the one with the smallest id.

    The winners come from a map-side combined minimum and are matched on the
    unique id, so no task ever holds all rows of a key.
    """
    winners = df.groupBy(*keys).agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(winners, id_col, "left_semi")
