"""Words, lines, paragraphs and the metrics every filter shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import let, total

WORD_GAP = "[ \\t\\r\\n]+"
WORD_SIGN = "[\\p{L}\\p{N}]"
VISIBLE = "[^ \\t\\r\\n]"


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def non_symbol_words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w.rlike(WORD_SIGN))


def lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(VISIBLE))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n{2,}"), lambda x: x.rlike(VISIBLE))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 over an empty base."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def lengths(items: Column) -> Column:
    return F.transform(items, lambda x: F.length(x))


def mean(values: Column) -> Column:
    return let(values, lambda v: ratio(total(v), F.size(v)))


def median(values: Column) -> Column:
    """Exact middle of a small in-row array; 0.0 when empty."""

    def middle(v: Column) -> Column:
        low = F.get(v, F.floor((F.size(v) - 1) / 2).cast("int"))
        high = F.get(v, F.floor(F.size(v) / 2).cast("int"))
        return F.when(F.size(v) > 0, (low + high) / 2.0).otherwise(F.lit(0.0))

    return let(F.array_sort(values), middle)


@dataclass(frozen=True)
class Parts:
    """Text and its pieces as columns of one DataFrame."""

    text: Column
    n_char: Column
    words: Column
    lines: Column
    paragraphs: Column


_PARTS = ("_words", "_lines", "_paragraphs")


def with_parts(df: DataFrame, text: str = "text") -> tuple[DataFrame, Parts]:
    """Add the pieces once, so many rules share one split of the text."""
    col = F.col(text)
    df = df.withColumns(
        {"_words": words(col), "_lines": lines(col), "_paragraphs": paragraphs(col)}
    )
    return df, Parts(col, F.length(col), *(F.col(c) for c in _PARTS))


def drop_parts(df: DataFrame) -> DataFrame:
    return df.drop(*_PARTS)


def text_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_char, n_non_symbol_words and avg_word_length."""
    df = df.withColumn("_plain", non_symbol_words(F.col(text)))
    plain = F.col("_plain")
    return df.withColumns(
        {
            "n_char": F.length(text).cast("long"),
            "n_non_symbol_words": F.size(plain).cast("long"),
            "avg_word_length": mean(lengths(plain)),
        }
    ).drop("_plain")
