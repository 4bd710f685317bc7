"""Perplexity under an add-k word bigram model, its summaries and their merge.

fold_perplexity counts every bigram and word by 64-bit hashes, in partitioned tables
that grow with the corpus. Log-probabilities are kept as whole micro-nats, so sums do not depend on their order.

Texts are split once. Their n-grams travel as arrays: a block of about a million words of
one fold sends each of its n-grams once, with the uses in the block, and gets the uses in the
other fold back. A frequent n-gram is thus one entry per block, however many documents have it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.functions.text import words
from textmill.session import materialize

MICRO = 1_000_000
TOP_VALUES = 100_000
WORDS_AT_ONCE = 1 << 20
# The n-grams of a block are cut by their leading bits; a task counts those of one slot, or of some while they are few.
SLOT_BITS, GRAMS_AT_ONCE = 10, 4_000_000
BLOCK = "block long, slot int, fold int, size int, grams binary, uses binary, docs binary, runs binary, begins binary, pairs binary, firsts binary"


def packed(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on: small values compress well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpacked(value: pa.Scalar, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(value.as_buffer(), np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def packed_places(places: np.ndarray, runs: np.ndarray) -> bytes:
    """Places in runs, ascending in each, as distances."""
    far = np.sort(np.repeat(np.arange(len(runs)) << 32, runs) | places) & 0xFFFFFFFF
    steps = np.diff(far, prepend=0)
    start = np.cumsum(runs) - runs
    steps[start] = far[start]
    return packed(steps.astype(np.uint32))


def unpacked_places(value: pa.Scalar, runs: np.ndarray) -> np.ndarray:
    steps = unpacked(value, np.uint32).astype(np.int64)
    sums = np.cumsum(steps)
    start = np.cumsum(runs) - runs
    return sums - np.repeat(sums[start] - steps[start], runs)


def gram_blocks(coded: DataFrame) -> DataFrame:
    """Blocks of the documents of coded(doc, fold, codes), as rows of BLOCK.

    Per block and slot, a row with the block's n-grams in ascending order and their uses; a bigram
    is odd, a word even. Words that begin no bigram have no use. The row with slot -1 has the
    documents (runs of bigrams, and whether a run is the first of its document) and the places of
    their bigrams, and of the first words of these, among the n-grams of the block.
    """
    at_once, slot_bits = WORDS_AT_ONCE, SLOT_BITS

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero, one, shift = np.uint64(0), np.uint64(1), np.uint64(64 - slot_bits)
        block = TaskContext.get().partitionId() << 32
        names = [part.split()[0] for part in BLOCK.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 7]

        def blocks_of(fold: int, docs: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal block
            owner = np.repeat(np.arange(len(docs)), lengths)
            spots = np.flatnonzero(owner[1:] == owner[:-1])
            owner = owner[spots]
            change = np.flatnonzero(owner[1:] != owner[:-1])
            first, last = np.zeros(len(spots), bool), np.zeros(len(spots), bool)
            first[np.append(0, change + 1)] = True
            last[np.append(change, len(spots) - 1)] = True
            for a in range(0, len(spots), at_once):
                here = slice(a, a + at_once)
                w1, w2 = codes[spots[here]], codes[spots[here] + 1]
                pair = w1 * np.uint64(0x9E3779B97F4A7C15) + w2 * np.uint64(0xC2B2AE3D27D4EB4F)
                pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                pair ^= pair >> np.uint64(29)
                n = len(w1)
                gram, places = np.unique(np.concatenate([pair | one, w1 & ~one, w2[last[here]] & ~one]), return_inverse=True)
                uses = np.bincount(places[: 2 * n], minlength=len(gram)).astype(np.int32)
                slot = (gram >> shift).astype(np.int32)
                cut = np.append(np.flatnonzero(np.append(True, slot[1:] != slot[:-1])), len(gram))
                start = np.flatnonzero(np.append(True, owner[here][1:] != owner[here][:-1]))
                runs = np.diff(np.append(start, n))
                block += 1
                k = len(cut) - 1
                pieces = [
                    [block] * k, slot[cut[:-1]], [fold] * k, np.diff(cut).astype(np.int32),
                    [packed(np.diff(gram[i:j], prepend=zero)) for i, j in zip(cut[:-1], cut[1:])],
                    [packed(uses[i:j]) for i, j in zip(cut[:-1], cut[1:])], *[[None] * k] * 5,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(pieces, types)], names)
                whole = [
                    block, -1, fold, len(gram), None, None, docs[owner[here][start]].tobytes(), packed(runs),
                    first[here][start].tobytes(), packed_places(places[:n], runs), packed_places(places[n : 2 * n], runs),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(whole, types)], names)

        held: dict[int, list] = {0: [], 1: []}
        count = {0: 0, 1: 0}

        def emptied(fold: int) -> Iterator[pa.RecordBatch]:
            if held[fold]:
                parts = [np.concatenate(x) for x in zip(*held[fold])]
                held[fold], count[fold] = [], 0
                yield from blocks_of(fold, *parts)

        for batch in batches:
            docs, folds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            offsets = batch.column(2).offsets.to_numpy()
            lengths = np.diff(offsets)
            codes = batch.column(2).values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
            for fold in (0, 1):
                mine = (folds == fold) & (lengths > 1)
                if mine.any():
                    held[fold].append((docs[mine], lengths[mine], codes[np.repeat(mine, lengths)]))
                    count[fold] += int(lengths[mine].sum())
                if count[fold] >= at_once:
                    yield from emptied(fold)
        for fold in (0, 1):
            yield from emptied(fold)

    return coded.mapInArrow(cut_up, BLOCK)


def other_uses(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, slot, uses) per piece of gram_blocks: uses of its n-grams in the other fold; and (fold, words), adding up to the distinct words of a fold."""

    def counted(table: pa.Table) -> pa.Table:
        block, slot, fold, size = (table.column(c).to_numpy() for c in ("block", "slot", "fold", "size"))
        gram = np.concatenate([np.cumsum(unpacked(x, np.uint64)) for x in table.column("grams")])
        uses = np.concatenate([unpacked(x, np.int32) for x in table.column("uses")])
        side = np.repeat(fold, size)
        distinct, place = np.unique(gram, return_inverse=True)
        n = [np.bincount(place[side == f], uses[side == f], len(distinct)).astype(np.int64) for f in (0, 1)]
        there = [np.bincount(place[side == f], minlength=len(distinct)) > 0 for f in (0, 1)]
        found = np.where(side == 0, n[1][place], n[0][place])
        ends = np.cumsum(size)
        words_of = [int(np.count_nonzero(t & (distinct & np.uint64(1) == 0))) for t in there]
        columns = [
            pa.array([*block.tolist(), None, None], pa.int64()), pa.array([*slot.tolist(), None, None], pa.int32()),
            pa.array([*[packed(found[e - s : e]) for s, e in zip(size, ends)], None, None], pa.binary()),
            pa.array([*[None] * len(block), 0, 1], pa.int32()), pa.array([*[None] * len(block), *words_of], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, ["block", "slot", "uses", "fold", "words"])

    bucket = F.shiftright(F.col("slot") * buckets, SLOT_BITS).alias("bucket")
    pieces = blocks.where("slot >= 0").select(bucket, "block", "slot", "fold", "size", "grams", "uses")
    return pieces.groupBy("bucket").applyInArrow(counted, "block long, slot int, uses binary, fold int, words long")


def block_sums(blocks: DataFrame, other: DataFrame, sizes: dict[int, int], k: float) -> DataFrame:
    """(doc, micro, uses, open, rows) per document and block: its log-probabilities, bigrams, bigrams without a value, first runs."""

    def summed(table: pa.Table) -> pa.Table:
        slot = table.column("slot").to_numpy()
        top = int(np.flatnonzero(slot == -1)[0])
        fold = table.column("fold")[top].as_py()
        docs = np.frombuffer(table.column("docs")[top].as_buffer(), np.int64)
        begins = np.frombuffer(table.column("begins")[top].as_buffer(), bool)
        runs = unpacked(table.column("runs")[top], np.int64)
        n = np.concatenate([unpacked(table.column("uses")[int(i)], np.int64) for i in np.argsort(slot)[1:]])
        pairs, firsts = (n[unpacked_places(table.column(c)[top], runs)] for c in ("pairs", "firsts"))
        vocabulary = sizes.get(1 - fold, 0)
        args = [pairs + k, firsts + k * vocabulary]
        logs = [np.log(np.where(x > 0, x, 1.0)) * MICRO for x in args]
        # Halves away from zero, as Spark rounds. Places are in no order within a run, their sums have none.
        up, down = (np.trunc(x + np.copysign(0.5, x)).astype(np.int64) for x in logs)
        unknown = ((args[0] <= 0) | (args[1] <= 0) | (vocabulary == 0)).astype(np.int64)
        start = np.cumsum(runs) - runs
        columns = [
            pa.array(docs), pa.array(np.add.reduceat(up - down, start)), pa.array(runs),
            pa.array(np.add.reduceat(unknown, start)), pa.array(begins.astype(np.int64)),
        ]
        return pa.Table.from_arrays(columns, ["doc", "micro", "uses", "open", "rows"])

    back = other.where("block is not null").select("block", "slot", "uses")
    places = blocks.where("slot = -1").select("block", "slot", "fold", "docs", "runs", "begins", "pairs", "firsts")
    both = places.unionByName(back, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(summed, "doc long, micro long, uses long, open long, rows long")


def fold_perplexity(
    df: DataFrame, id_col: str, keep: list[str], fold: Column, text: str = "text", k: float = 0.1
) -> DataFrame:
    """exp of the mean negative log-probability of the texts of each fold (0 or 1) under the exact counts of the other one.

    No row for texts under two words; null where the other fold has no bigram.
    Rows stay apart though ids repeat.
    """
    spark = df.sparkSession
    body = F.coalesce(text, F.lit(""))
    side = fold.cast("long")
    doc = F.xxhash64(id_col, body, side).alias("doc")
    coded = df.where(side.isin(0, 1)).select(doc, side.alias("fold"), F.transform(words(body), lambda w: F.xxhash64(w)).alias("codes"))
    blocks = materialize(gram_blocks(coded), "blocks")
    entries = blocks.where("slot >= 0").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Several buckets to a partition, so that their hashes deal them out evenly.
    spread = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    other = materialize(other_uses(blocks, min(1 << SLOT_BITS, max(spread, entries // GRAMS_AT_ONCE))), "other")
    sizes = {r["fold"]: r["v"] for r in other.where("fold is not null").groupBy("fold").agg(F.sum("words").alias("v")).collect()}

    # Equal rows share one sum, which holds the uses of all of them; a long document may lie in several blocks.
    sums = block_sums(blocks, other, sizes, k).groupBy("doc").agg(
        (F.sum("uses") / F.sum("rows")).cast("long").alias("n_bigrams"),
        F.when(F.sum("open") == 0, F.sum("micro") / MICRO / F.sum("uses")).alias("_mean"),
    )
    texts = df.select(id_col, *keep, doc)
    joined = texts.join(sums, "doc").withColumn("perplexity", F.exp(-F.col("_mean")))
    return joined.select(id_col, *keep, "n_bigrams", "perplexity")


def partial_stats(scored: DataFrame, group: list[str]) -> DataFrame:
    """Mergeable figures per group and input partition, as a shard would report them.

    Spread is kept as the sum of squared distances from the shard's own mean.
    """
    v = F.col("perplexity")
    return scored.withColumn("shard", F.spark_partition_id()).groupBy("shard", *group).agg(
        F.count(v).alias("n"),
        F.sum(v).alias("total"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


def merge_stats(partials: DataFrame, group: list[str]) -> DataFrame:
    """One summary per group from any number of partial ones.

    Squared distances are moved to the common mean, never taken as a difference
    of large sums of squares.
    """
    whole = Window.partitionBy(*group)
    mean = F.sum("total").over(whole) / F.sum("n").over(whole)
    away = F.when(F.col("n") > 0, F.col("total") / F.col("n") - F.col("_mean"))
    return (
        partials.withColumn("_mean", mean)
        .groupBy(*group)
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            (F.sum("total") / F.sum("n")).alias("mean"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.sqrt(F.sum(F.col("m2") + F.col("n") * away * away) / F.sum("n")).alias("std"),
        )
    )


def perplexity_summary(scored: DataFrame, group: list[str]) -> DataFrame:
    v = F.col("perplexity")
    return scored.groupBy(*group).agg(
        F.count(v).alias("n"),
        F.sum(v).alias("total"),
        F.avg(v).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.stddev_pop(v).alias("std"),
    )


def perplexity_histogram(
    scored: DataFrame, group: list[str], digits: int = 0, top_k: int = TOP_VALUES
) -> DataFrame:
    """Rounded value to count, the ``top_k`` most frequent values per group."""
    counts = (
        scored.withColumn("value", F.round("perplexity", digits))
        .groupBy(*group, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_values(counts, group, top_k)


def partial_histograms(scored: DataFrame, group: list[str], shard: Column, digits: int = 0) -> DataFrame:
    """(shard, group, value, n): what every shard counts by itself, whole."""
    return (
        scored.select(shard.alias("shard"), *group, F.round("perplexity", digits).alias("value"))
        .groupBy("shard", *group, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_histograms(partials: DataFrame, group: list[str], top_k: int = TOP_VALUES) -> DataFrame:
    """The exact ``top_k`` values of each group from whole partial counts, most of which stay where they are.

    Three rounds over the (written) partials. Every shard sends its own top
    list; the k-th of the sums so far is a count that the final k-th reaches as
    well. Split over m shards, it is a count that a value must have in some
    shard to get there, so every shard sends what reaches it. A value's sum,
    and that count for every shard that has not sent it, bounds its total; the
    values whose bound reaches the k-th sum known by then are asked for in all
    shards. Ties go to the smaller value, as in one pass.
    """
    keys = [*group, "value"]
    own = Window.partitionBy("shard", *group).orderBy(F.desc("n"), "value")
    listed = partials.withColumn("_rank", F.row_number().over(own)).where(F.col("_rank") <= top_k)
    first = listed.groupBy(*keys).agg(F.sum("n").alias("n"))
    shards = partials.groupBy("shard", *group).agg(F.lit(1).alias("_1")).groupBy(*group).agg(F.count("*").alias("_m"))
    # Groups with fewer than top_k values so far bound nothing.
    kth = top_values(first, group, top_k, "_rank").where(F.col("_rank") == top_k).select(*group, F.col("n").alias("_kth"))
    share = _null_safe(shards, kth, group, "left").select(*group, "_m", (F.coalesce("_kth", F.lit(0)) / F.col("_m")).alias("_share"))
    share = materialize(share, "shares")
    sent = _null_safe(partials, share, group, "inner").where(F.col("n") >= F.col("_share"))
    sums = sent.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum("n") + (F.max("_m") - F.count("*")) * F.max("_share")).alias("_bound")
    )
    sums = materialize(sums, "sums")
    kth = top_values(sums.select(*keys, "n"), group, top_k, "_rank").where(F.col("_rank") == top_k).select(*group, F.col("n").alias("_kth"))
    asked = _null_safe(sums, kth, group, "left").where(F.col("_bound") >= F.coalesce("_kth", F.lit(0))).select(*keys)
    whole = _null_safe(partials, asked, keys, "inner").groupBy(*keys).agg(F.sum("n").alias("n"))
    return top_values(whole, group, top_k)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which nulls are equal; the key columns come from the left."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(named[f"_r_{k}"]) for k in keys]
    return left.join(named, reduce(and_, same), how).drop(*[f"_r_{k}" for k in keys])


def top_values(counts: DataFrame, group: list[str], top_k: int, rank: str | None = None) -> DataFrame:
    # The rank limit is pushed below the shuffle, so a group sends at most top_k rows per task.
    w = Window.partitionBy(*group).orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= top_k)
    return ranked.withColumnRenamed("_rank", rank) if rank else ranked.drop("_rank")
