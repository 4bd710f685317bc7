"""Array helpers built from higher-order functions, so rows never shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column, zero: Column | None = None) -> Column:
    zero = F.lit(0) if zero is None else zero
    return F.aggregate(values, zero, lambda acc, x: acc + x)


def count_where(values: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(values, test))


def _prefix(values: Column, zero: Column, merge) -> Column:
    """Exclusive scan with one pass per element; meant for one block."""
    return F.transform(
        values, lambda _, i: F.aggregate(F.slice(values, 1, i), zero, lambda a, x: merge(a, x))
    )


def prefix_scan(values: Column, zero: Column, merge) -> Column:
    """Exclusive scan of an array: element i is merge over elements 0..i-1.

    Blocks of a size that follows the array's keep the work near size to the power
    4/3 instead of size squared, so one row with very many matches stays affordable.
    """

    def over_blocks(a: Column, block: Column) -> Column:
        blocks = F.when(
            F.size(a) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")),
                lambda b: F.aggregate(F.slice(a, b * block + 1, block), zero, merge),
            ),
        ).otherwise(F.array(zero))
        return let(
            blocks,
            lambda sums: let(
                _prefix(sums, zero, merge),
                lambda offsets: F.transform(
                    a,
                    lambda _, i: F.aggregate(
                        F.slice(a, i - i % block + 1, i % block),
                        F.get(offsets, F.floor(i / block).cast("int")),
                        merge,
                    ),
                ),
            ),
        )

    def sized(a: Column) -> Column:
        return let(F.ceil(F.cbrt(2 * F.greatest(F.size(a), F.lit(4)))).cast("int"), lambda block: over_blocks(a, block))

    return let(values, sized)


def prefix_sums(values: Column) -> Column:
    return prefix_scan(values, F.lit(0), lambda a, x: a + x)


def run_starts(sorted_values: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Indices (0-based) at which a new run begins in a sorted array."""

    def starts(a: Column) -> Column:
        return F.filter(
            F.transform(
                a, lambda x, i: F.when((i == 0) | ~same(F.get(a, i - 1), x), i)
            ),
            lambda i: i.isNotNull(),
        )

    return let(sorted_values, starts)


def runs(sorted_values: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Split a sorted array into an array of runs of equal neighbours."""
    return let(
        sorted_values,
        lambda a: let(
            run_starts(a, same),
            lambda s: F.transform(
                s,
                lambda from_, k: F.slice(
                    a, from_ + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - from_
                ),
            ),
        ),
    )


def char_blocks(text: Column, size: int) -> Column:
    """Cut a text into pieces of ``size`` characters in one linear pass."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))


def explode_once(df: DataFrame, keep: list, array: Column, out: str, pos: str | None = None) -> DataFrame:
    """One row per element, none for an empty array.

    A plain explode makes the optimizer test the array's size below it, which
    computes a costly array twice; the outer form does not.
    """
    index = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(index, out)).where(F.col(index).isNotNull())
    return rows if pos else rows.drop(index)
