"""Exact quantiles of many columns at once, by radix selection.

Every number has a 64-bit key in its order. One pass counts the leading 16 bits
of all columns; the counts tell in which of these cells each wanted rank lies. The
next pass counts the next 16 bits inside those cells only, and after four passes
the keys are known to the last bit. What travels are counts of cells, combined
before they do; what comes to the driver is one row per column and rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

DIGIT = 16
SHIFTS = (48, 32, 16, 0)
_FLIP = np.int64(2**63 - 1)


def order_key(value: Column, kind: DataType) -> Column:
    """A signed 64-bit number in the order of the values (NaN last, both zeros one)."""
    if isinstance(kind, (DoubleType, FloatType)):

        @F.arrow_udf("long")
        def ordered(values: pa.Array) -> pa.Array:
            gone = values.is_null().to_numpy(zero_copy_only=False)
            bits = (values.fill_null(0.0).to_numpy().astype(np.float64) + 0.0).view(np.int64)
            return pa.array(np.where(bits < 0, bits ^ _FLIP, bits), pa.int64(), mask=gone)

        return ordered(value)
    if isinstance(kind, DecimalType):
        if kind.precision > 18:
            raise ValueError("decimals of more than 18 digits have no 64-bit key")
        return (value * F.lit(10**kind.scale)).cast("decimal(38,0)").cast("long")
    return value.cast("long")


def key_value(key: int, kind: DataType) -> float:
    if isinstance(kind, (DoubleType, FloatType)):
        bits = np.array([key], np.int64)
        return float(np.where(bits < 0, bits ^ _FLIP, bits).view(np.float64)[0])
    return key / 10**kind.scale if isinstance(kind, DecimalType) else float(key)


def select_ranks(df: DataFrame, ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The value at every wanted rank (from 0, nulls left out) of every column, in four passes over ``df``."""
    spark, names = df.sparkSession, list(ranks)
    kinds = {c: df.schema[c].dataType for c in names}
    keyed = df.select(*[order_key(F.col(f"`{c}`"), kinds[c]).alias(f"k{i}") for i, c in enumerate(names)])
    # Where each rank is: (column, rank) -> (bits known so far, rank among the keys that begin with them).
    known = {(c, r): (0, r) for c in names for r in ranks[c]}
    for shift in SHIFTS:
        cells = []
        for i, c in enumerate(names):
            key = F.col(f"k{i}")
            if shift == SHIFTS[0]:
                prefix, digit, open_ = F.lit(0).cast("long"), F.shiftright(key, shift), key.isNotNull()
            else:
                prefix = F.shiftright(key, shift + DIGIT)
                digit = F.shiftright(key, shift).bitwiseAND(F.lit(2**DIGIT - 1).cast("long"))
                open_ = prefix.isin(sorted({p for (name, _), (p, _) in known.items() if name == c}))
            cells.append(F.when(open_, F.struct(F.lit(i).alias("c"), prefix.alias("prefix"), digit.alias("digit"))))
        counted = keyed.select(F.explode(F.array(*cells)).alias("x")).where("x is not null").groupBy("x.c", "x.prefix", "x.digit")
        counted = counted.agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("c", "prefix").orderBy("digit"))
        placed = counted.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
        wanted = [(names.index(c), p, r, left) for (c, r), (p, left) in known.items()]
        wanted = spark.createDataFrame(wanted, "c int, prefix long, rank long, left long")
        here = (F.col("left") >= F.col("before")) & (F.col("left") < F.col("upto"))
        for r in placed.join(F.broadcast(wanted), ["c", "prefix"]).where(here).collect():
            known[names[r["c"]], r["rank"]] = ((r["prefix"] << DIGIT) + r["digit"], r["left"] - r["before"])
    return {(c, r): key_value(key, kinds[c]) for (c, r), (key, _) in known.items()}


def quantiles(df: DataFrame, counts: dict[str, int], wanted: list[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column, given how many values each has."""
    at = {c: [(n - 1) * q for q in wanted] for c, n in counts.items() if n}
    ranks = {c: sorted({f(p) for p in spots for f in (math.floor, math.ceil)}) for c, spots in at.items()}
    values = select_ranks(df, ranks) if ranks else {}
    out = {}
    for c in counts:
        spots = []
        for p in at.get(c, []):
            low, high = values[c, math.floor(p)], values[c, math.ceil(p)]
            spots.append(low if low == high else low + (p - math.floor(p)) * (high - low))
        out[c] = spots or [None] * len(wanted)
    return out
