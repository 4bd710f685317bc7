"""Row-shape operators: chunking, splitting, combining, file plans, delivery format."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from textmill.functions.arrays import char_blocks, explode_once
from textmill.operators.ordering import ROWS_PER_RANGE, running_total
from textmill.operators.radix import quantiles

DELIVERY_COLUMNS = {
    "id": "string",
    "text": "string",
    "title": "string",
    "source": "string",
    "author": "string",
    "license": "string",
    "dataset_name": "string",
    "dataset_url": "string",
    "language": "string",
    "language_score": "double",
    "n_char": "bigint",
    "n_non_symbol_words": "bigint",
    "avg_word_length": "double",
}


def delivery_format(df: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Keep the standard columns in their fixed order; absent ones are skipped or typed nulls."""
    out = []
    for name, kind in DELIVERY_COLUMNS.items():
        if name in df.columns:
            out.append(F.col(name))
        elif fill_missing:
            out.append(F.lit(None).cast(kind).alias(name))
    return df.select(*out)


def exact_quantiles(df: DataFrame, column: str, names: dict[str, float]) -> DataFrame:
    """Interpolated quantiles as one row, one column per name; null for an empty column."""
    only = df.select(F.col(f"`{column}`"))
    n_values = only.agg(F.count(F.col(f"`{column}`"))).first()[0]
    values = quantiles(only, {column: n_values}, list(names.values()))[column]
    return df.sparkSession.createDataFrame([tuple(values)], ", ".join(f"`{n}` double" for n in names))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, sample std, min, quartiles and max.

    Five passes over the rows, however many columns there are: one for the
    aggregates, four for the quartiles of all columns. The figures are computed here;
    the result is a table of one row per column.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    figures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    exprs = [f(F.col(f"`{c}`")).cast("long" if k == "count" else "double").alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in figures.items()]
    found = df.agg(*exprs).first() if columns else {}
    counts = {c: found[f"count_{i}"] for i, c in enumerate(columns)}
    quartiles = quantiles(df.select(*[F.col(f"`{c}`") for c in columns]), counts, [0.25, 0.5, 0.75])
    rows = [(*[found[f"{k}_{i}"] for k in figures], c, *quartiles[c]) for i, c in enumerate(columns)]
    schema = "count long, mean double, std double, min double, max double, column string, q25 double, q50 double, q75 double"
    return df.sparkSession.createDataFrame(rows, schema)


def first_rows(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The preview rows that go with a profile."""
    return df.orderBy(id_col).limit(n)


def chunk_text(df: DataFrame, n: int, text: str = "text") -> DataFrame:
    """Each row becomes ceil(length / n) rows of n characters; empty text yields none."""
    keep = [c for c in df.columns if c != text]
    return explode_once(df, keep, char_blocks(F.col(text), n), text, "chunk_idx")


def plan_file_split(
    df: DataFrame,
    target_bytes: int,
    keys: list[str],
    text: str = "text",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add file_no: rows in key order fill files up to a byte target."""
    df = running_total(df, keys, F.octet_length(text), "_bytes_before", rows_per_range)
    return df.withColumn("file_no", F.floor(F.col("_bytes_before") / target_bytes)).drop("_bytes_before")


def split_rows(df: DataFrame, text: str = "text", separator: str = "\n") -> DataFrame:
    """One row per piece of the text, numbered by part_idx."""
    keep = [c for c in df.columns if c != text]
    return explode_once(df, keep, F.split(text, separator), text, "part_idx")


def combine_rows(
    df: DataFrame, id_col: str | list[str], idx: str, separator: str, text: str = "text"
) -> DataFrame:
    """Join the parts of every document in index order; other columns come from the first part.

    ``id_col`` names what tells documents apart, several columns if the id alone
    does not. A group is one output document, so its size is that of a single row.
    """
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    parts = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(parts, lambda x: x["t"]), separator)
    others = [c for c in df.columns if c not in (*keys, idx, text)]
    return df.groupBy(*keys).agg(
        joined.alias(text), *[F.min_by(c, idx).alias(c) for c in others]
    )
