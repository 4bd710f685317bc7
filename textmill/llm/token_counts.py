"""Token counts as an exact histogram of encoded lengths.

Documents are counted per encoded length; sums over the lengths from each one
upwards then answer, for every context limit: how many documents and tokens are
at or above it, what a corpus truncated to it holds, and any quantile. Only
lengths and counts travel.

Defined results
    null and empty texts have length 0. Repeated rows count as often as they
    occur. An empty table has an empty histogram.
    Very long texts are encoded whole. Other columns stay; one named like the output is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from textmill.llm.rows import whole_text
from textmill.session import materialize

# Lengths per block of the suffix sums. A text has fewer than 2^31 tokens, so
# there are at most 2^19 blocks, of at most 2^12 rows each.
BLOCK = 1 << 12


@lru_cache(maxsize=2)
def byte_encoding(path: str):
    """The byte-level encoding whose ranks are listed in the file."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as listed:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, listed)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_counter(path: str | None = None) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens under a byte-level vocabulary."""
    path = path or default_path()

    def count(texts: list[str]) -> list[int]:
        encoding = byte_encoding(path)
        return [len(encoding.encode_ordinary(t)) for t in texts]

    return count


def with_token_count(
    df: DataFrame, counter: Callable[[list[str]], list[int]] | None = None, text: str = "text", out: str = "n_tokens"
) -> DataFrame:
    """Add the encoded length of every text; no row moves."""
    counter = counter or byte_counter()

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(counter(texts.to_pylist()), pa.int64())

    # Marked so that no filter pushed below it makes the call a second time.
    return df.withColumn(out, counted.asNondeterministic()(whole_text(text)))


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per length that occurs, with its documents and the sums from it upwards.

    docs_from, tokens_from: documents and tokens of this length or more.
    truncated_total: tokens left when every document is cut to this length.
    docs_share: share of documents of this length or less.
    """
    counted = lengths.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n_docs"))
    # A row per length that occurs, read twice below: written, so that every text is encoded once.
    counted = materialize(counted.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens")), "lengths")
    blocked = counted.withColumn("_block", F.floor(F.col("length") / BLOCK))
    inside = Window.partitionBy("_block").orderBy(F.desc("length"))
    sums = blocked.select(
        "*", F.sum("n_docs").over(inside).alias("_docs"), F.sum("n_tokens").over(inside).alias("_tokens")
    )
    # One row per block: bounded by the longest possible text.
    totals = blocked.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    above = Window.orderBy(F.desc("_block"))
    everything = Window.partitionBy()
    totals = totals.select(
        "_block",
        (F.sum("_d").over(above) - F.col("_d")).alias("_docs_above"),
        (F.sum("_t").over(above) - F.col("_t")).alias("_tokens_above"),
        F.sum("_d").over(everything).alias("_all_docs"),
        F.sum("_t").over(everything).alias("_all_tokens"),
    )
    joined = sums.join(totals, "_block")
    docs_from = F.col("_docs") + F.col("_docs_above")
    tokens_from = F.col("_tokens") + F.col("_tokens_above")
    return joined.select(
        "length",
        "n_docs",
        "n_tokens",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("_all_tokens") - tokens_from + F.col("length") * docs_from).alias("truncated_total"),
        ((F.col("_all_docs") - docs_from + F.col("n_docs")) / F.col("_all_docs")).alias("docs_share"),
    )


def quantile(histogram: DataFrame, q: float) -> int | None:
    """The smallest length that a share of at least q of the documents does not exceed."""
    return histogram.where(F.col("docs_share") >= q).agg(F.min("length")).first()[0]


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit`` tokens."""
    row = histogram.agg(
        F.coalesce(F.sum(F.when(F.col("length") <= limit, F.col("n_tokens"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), F.lit(0)),
    ).first()
    return row[0] + limit * row[1]
