"""Row numbers and running totals over a whole table, without a one-task window.

Rows go to ranges of the ordering key. Each range is summed with a map-side
combine, the sums (one row per range) give every range its offset, and the
window then runs inside one range only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_RANGE = 500_000
SAMPLES_PER_RANGE = 20


def range_cuts(df: DataFrame, keys: list[str], rows_per_range: int = ROWS_PER_RANGE) -> list:
    """Ordered cut points from a hash sample of the keys.

    There are as many ranges as shuffle partitions, or more when they would hold
    more than ``rows_per_range`` rows each.
    """
    n_rows = df.count()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(2, partitions, n_rows // rows_per_range + 1)
    wanted = n_ranges * SAMPLES_PER_RANGE
    step = max(1, n_rows // wanted)
    sample = (
        df.select(*keys)
        .where(F.pmod(F.xxhash64(*keys), F.lit(step)) == 0)
        .distinct()
        .collect()
    )
    points = sorted(tuple(r) for r in sample)
    stride = max(1, len(points) // n_ranges)
    return points[stride::stride]


def range_of(keys: list[str], cuts: list) -> Column:
    """Range number of a row: a balanced tree of comparisons with the cut points."""
    key = F.struct(*keys)

    def at(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        cut = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, cuts[mid])])
        return F.when(key <= cut, at(lo, mid)).otherwise(at(mid + 1, hi))

    return at(0, len(cuts))


def running_total(
    df: DataFrame,
    keys: list[str],
    value: Column,
    out: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows in key order (exclusive)."""
    cuts = range_cuts(df, keys, rows_per_range)
    df = df.withColumns({"_value": value.cast("long"), "_range": range_of(keys, cuts)})
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: small by construction.
    across = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("_range")
        .agg(F.sum("_value").alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_offset"))
    )
    return (
        df.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_value", "_range", "_offset")
    )


def global_row_number(
    df: DataFrame, keys: list[str], out: str, rows: Column | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add ``out``: 1, 2, 3, ... over all rows in key order.

    A row that stands for several counts as ``rows`` and gets the number of its last.
    """
    rows = F.lit(1) if rows is None else rows
    numbered = running_total(df, keys, rows, out, rows_per_range)
    return numbered.withColumn(out, F.col(out) + rows)
