"""Small DataFrame helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.session import materialize

SALTS = 16


def whole_text(text: str | Column) -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def left_lookup(rows: DataFrame, table: DataFrame, keys: list[str], spread: Column, salts: int = SALTS) -> DataFrame:
    """Left join to a table with one row per key, safe when a key holds a large share of ``rows``.

    Every row draws a salt from ``spread`` and the (small) table is repeated
    once per salt, so the rows of a hot key reach ``salts`` tasks; adaptive
    execution may split them further.
    """
    drawn = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return drawn.join(repeated, [*keys, "_salt"], "left").drop("_salt")


def ranked(rows: DataFrame, groups: list[str], order: list[str], label: str) -> DataFrame:
    """Add _pos, a row's place (from 0) in its group by ``order``, and _size, the group's rows.

    Ranges of (group, order) are sorted and written, numbered as they lie; only
    one row per range and group then decides the offsets, so no task holds a
    group. Group columns are not null; ``order`` tells rows apart.
    """
    keys = [*groups, *order]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    laid = materialize(laid, label).withColumn("_range", F.shiftright("_at", 33))
    runs = laid.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*groups)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *groups, "_range",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_n").over(group).alias("_size"),
    )
    return laid.join(offsets, [*groups, "_range"]).withColumn("_pos", F.col("_at") + F.col("_offset")).drop("_at", "_range", "_offset")
