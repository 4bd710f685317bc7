"""All pairs of different texts with a shingle Jaccard at or above a threshold.

Equal texts are one node, named by their smallest id. Most texts have no partner,
which a third of their shingles tells; those of the others alone travel as a whole,
and no text does. Shingles have one order for all: rarest first. Two sets that reach the threshold share a shingle among the
first few of each, so only those are indexed. A shingle at place i of a set of n
leaves n - i that can still be shared, which bounds the sizes of the partners it
can lead to; sets look their partners up by shingle and size class, and a hash
bitmap of each set rules out most pairs before they leave the join. What is left
is verified on the sets, each pair once, the pairs of a group of near copies side by
side, so that a set travels once for all of them.

Shingles that one text alone has come first and lead nowhere. A group of near
copies whose own shingles exceed what the threshold allows therefore makes no
pairs at all, however large it is.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import let
from textmill.functions.text import words
from textmill.operators.dedup import N_GRAMS, ROW_KEY, keyed_rows, shingle_hashes, split_rows_by_key
from textmill.session import materialize

THRESHOLD = 0.8
# Sizes of one class differ by no more than this factor.
CLASS_STEP = 1.05
BITMAP_LONGS = 16
# Different texts on either side of the pairs that are verified side by side.
BLOCK = 256
SLACK = 1e-9
# Of the shingles two sets must share, the share by which the first ones looked at exceed the least that would do.
EXTRA = 1 / 8


def text_nodes(df: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """(id, digest, node, n_copies) of every row; node is the smallest id of the rows with its text."""
    digests = materialize(df.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest")), "digests")
    nodes = digests.groupBy("digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n_copies"))
    return digests.join(nodes, "digest")


def text_set(text: str, n_grams: int) -> Column:
    """The distinct shingles of a text, by hash."""
    return F.sort_array(F.array_distinct(shingle_hashes(words(F.col(text)), n_grams, 64)))


def likely_rows(rows: DataFrame, threshold: float, n_grams: int, id_col: str, text: str) -> DataFrame:
    """Keys of the keyed rows (of different texts) that may have a partner.

    By hash, a set of n holds at most n - ceil(t * n) shingles that a partner lacks. So
    among that many and ``extra(n)`` more, the first ones of both, there are as many that
    both have as the smaller set has extra ones. Only these first shingles travel.
    """

    def fewest(n: Column) -> Column:
        return F.ceil(threshold * n - SLACK)

    def extra(n: Column) -> Column:
        return F.floor(n * threshold * EXTRA) + 1

    def first_of(s: Column) -> Column:
        n = F.size(s)
        # A partner has fewest(n) shingles at least.
        return F.struct(F.slice(s, 1, (n - fewest(n) + extra(n)).cast("int")).alias("first"), extra(fewest(n)).alias("need"))

    heads = rows.select(ROW_KEY, F.col(id_col).alias("id"), let(text_set(text, n_grams), first_of).alias("_h"))
    heads = materialize(heads, "heads")
    tokens = heads.select("id", F.explode("_h.first").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    met = tokens.join(often, "token", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("_met"))
    return heads.select(ROW_KEY, "id", "_h.need").join(met, "id").where("_met >= need").select(ROW_KEY)


def shared_shingles(df: DataFrame, nodes: DataFrame, threshold: float, n_grams: int, id_col: str, text: str) -> DataFrame:
    """(id, n, shared) per distinct text that can have a partner: its shingles that such texts share, rarest first."""
    rows = keyed_rows(df.select(id_col, text).where(F.col(id_col).isNotNull() & F.col(text).isNotNull()), id_col)
    digests = rows.select(ROW_KEY, F.col(f"{ROW_KEY}.id").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    first = nodes.where("id = node").select("id", "digest")
    first = digests.join(first, ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.min(ROW_KEY).alias(ROW_KEY))
    _, rows = split_rows_by_key(rows, first.select(ROW_KEY))
    _, rows = split_rows_by_key(rows, likely_rows(rows, threshold, n_grams, id_col, text))
    sets = materialize(rows.select(F.col(id_col).alias("id"), text_set(text, n_grams).alias("_set")), "sets")
    tokens = sets.select("id", F.size("_set").alias("n"), F.explode("_set").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = tokens.join(often, "token").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("_s"))
    return held.select("id", "n", F.col("_s.token").alias("shared")).where(F.size("shared") >= threshold * F.col("n") - SLACK)


def set_bitmaps(sets: DataFrame) -> DataFrame:
    """Add b0, b1, ...: hashed bits of the shared shingles, and spare: how many shingles there are more than bits."""

    @F.arrow_udf("array<long>")
    def bits(lists: pa.Array) -> pa.Array:
        offsets = np.asarray(lists.offsets)
        spots = np.asarray(lists.values)[offsets[0] : offsets[-1]].view(np.uint64) % np.uint64(64 * BITMAP_LONGS)
        row = np.repeat(np.arange(len(lists)), np.diff(offsets)) * BITMAP_LONGS
        out = np.zeros(len(lists) * BITMAP_LONGS, np.uint64)
        np.bitwise_or.at(out, row + (spots // np.uint64(64)).astype(np.int64), np.uint64(1) << (spots % np.uint64(64)))
        ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * BITMAP_LONGS)
        return pa.ListArray.from_arrays(ends, pa.array(out.view(np.int64)))

    marked = sets.withColumn("_bits", bits.asNondeterministic()("shared"))
    ones = F.aggregate("_bits", F.lit(0), lambda n, b: n + F.bit_count(b))
    marked = marked.withColumn("spare", F.size("shared") - ones)
    return marked.withColumns({f"b{k}": F.col("_bits")[k] for k in range(BITMAP_LONGS)}).drop("_bits")


def size_class(n: Column) -> Column:
    return F.floor(F.ln(n.cast("double")) / math.log(CLASS_STEP))


def index_rows(sets: DataFrame, threshold: float) -> DataFrame:
    """A row per set and indexed shingle: (token, id, n, most, spare, b...).

    ``most`` is the size of the largest partner the shingle can lead to: with i
    shingles before it, n - i can be shared, and t / (1 + t) of both sizes must be.
    """
    places = sets.select("id", "n", "spare", *[f"b{k}" for k in range(BITMAP_LONGS)], F.size("shared").alias("_m"), F.posexplode("shared").alias("_i", "token"))
    left = F.col("_m") - F.col("_i")
    most = F.floor((1 + threshold) / threshold * left + SLACK) - F.col("n")
    return places.withColumn("most", most).where(F.col("most") >= threshold * F.col("n") - SLACK).drop("_m", "_i")


def candidate_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct pairs (a, b), a < b, of sets that no filter rules out as partners."""
    rows = materialize(index_rows(set_bitmaps(sets), threshold), "index")
    # Of a pair the larger set looks up, the smaller one is found (of equal sizes, the smaller id).
    smallest = F.ceil(threshold * F.col("n") - SLACK)
    largest = F.least("most", F.col("n").cast("long"))
    classes = F.sequence(size_class(smallest), size_class(largest))
    asks = rows.where(largest >= smallest).withColumn("class", F.explode(classes)).alias("a")
    found = rows.where(F.col("most") >= F.col("n")).withColumn("class", size_class(F.col("n"))).alias("b")
    ordered = (F.col("b.n") < F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.id") < F.col("a.id")))
    fits = (F.col("b.n") <= F.col("a.most")) & (F.col("a.n") <= F.col("b.most")) & (F.col("b.n") >= threshold * F.col("a.n") - SLACK)
    bits = reduce(add, [F.bit_count(F.col(f"a.b{k}").bitwiseAND(F.col(f"b.b{k}"))) for k in range(BITMAP_LONGS)])
    enough = (1 + threshold) * (bits + F.least("a.spare", "b.spare")) >= threshold * (F.col("a.n") + F.col("b.n")) - SLACK
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.class") == F.col("b.class"))
    met = asks.join(found, same & ordered & fits & enough)
    return met.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def pair_blocks(pairs: DataFrame) -> DataFrame:
    """(a, b, lead, i, j): pairs of one group of near copies share a block, those of a large group some blocks.

    ``lead`` is the smallest id that ``a`` pairs with, or ``a`` itself; i and j are shares of
    about BLOCK different ``a`` and ``b`` each.
    """
    leads = pairs.groupBy(F.col("b").alias("_id")).agg(F.min("a").alias("_lead"))
    led = pairs.join(leads, F.col("a") == F.col("_id"), "left").select("a", "b", F.coalesce("_lead", "a").alias("lead"))
    led = materialize(led, "led")

    def shares(c: str) -> Column:
        return F.ceil(F.approx_count_distinct(c) / BLOCK)

    sizes = led.groupBy("lead").agg(shares("a").alias("_i"), shares("b").alias("_j"))
    i, j = F.pmod(F.xxhash64("a"), F.col("_i")), F.pmod(F.xxhash64("b"), F.col("_j"))
    return materialize(led.join(sizes, "lead").select("a", "b", "lead", i.alias("i"), j.alias("j")), "blocks")


def verified_pairs(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, jaccard) of the pairs that reach the threshold. A set travels once per block of pairs, not per pair."""
    blocks, block = pair_blocks(pairs), ["lead", "i", "j"]
    ends = blocks.select(*[F.col(c).alias(f"_{c}") for c in block], F.explode(F.array("a", "b")).alias("id"))
    members = ends.distinct().join(sets, "id")

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        lists, n, rows = right["shared"].combine_chunks(), right["n"].to_pylist(), {}
        for row, key in enumerate(right["id"].to_pylist()):
            rows.setdefault(key, []).append(row)
        _, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        parts = np.split(codes, np.cumsum(lists.value_lengths().to_numpy())[:-1])
        partners, found = {}, []
        for x, y in zip(left["a"].to_pylist(), left["b"].to_pylist()):
            partners.setdefault(x, []).append(y)
        for x, others in partners.items():
            for p in rows.get(x, []):
                mine = np.zeros(len(codes), bool)
                mine[parts[p]] = True
                for y in others:
                    for q in rows.get(y, []):
                        both = int(np.count_nonzero(mine[parts[q]]))
                        jaccard = both / (n[p] + n[q] - both)
                        if jaccard >= threshold:
                            found.append((x, y, jaccard))
        a, b, jaccards = zip(*found) if found else ((), (), ())
        key = left.schema.field("a").type
        return pa.table({"a": pa.array(a, key), "b": pa.array(b, key), "jaccard": pa.array(jaccards, pa.float64())})

    key = sets.schema["id"].dataType.simpleString()
    met = blocks.groupBy(*block).cogroup(members.groupBy(*[f"_{c}" for c in block]))
    return met.applyInArrow(verify, f"a {key}, b {key}, jaccard double")


def near_dup_pairs(
    df: DataFrame, threshold: float = THRESHOLD, n_grams: int = N_GRAMS, id_col: str = "id", text: str = "text"
) -> DataFrame:
    """(a, b, jaccard, copy): every pair of different texts, and every further row of a text.

    Texts stand under the smallest id of their rows. A pair has a < b and copy
    false; a row with a text seen under a smaller id has copy true, a being that
    id. Pairs of copies are not spelled out. Texts under n_grams words have no
    shingles, null texts no node; ids tell rows apart.
    """
    df = df.where(F.col(text).isNotNull())
    nodes = materialize(text_nodes(df, id_col, text), "nodes")
    sets = materialize(shared_shingles(df, nodes, threshold, n_grams, id_col, text), "shingles")
    pairs = materialize(candidate_pairs(sets, threshold), "candidates")
    copies = nodes.where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("jaccard"), F.lit(True).alias("copy"))
    return verified_pairs(pairs, sets, threshold).withColumn("copy", F.lit(False)).unionByName(copies)
