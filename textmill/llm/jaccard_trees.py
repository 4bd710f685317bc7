"""Exact Jaccard join of word 5-gram sets by signature trees.

Two documents link when they share at least ``PERCENT`` % of their shingles.
Equal sets are one node from the start. Three steps find all other links:

1.  Tokens that no two nodes have cannot be shared, so a node that can link at
    all has many common ones. With the tokens in one order for all, linked sets
    of sizes a and b share at least l tokens among the first a - need(a) + l and
    b - need(b) + l. So nodes with too few common tokens among those leave, and
    only the rest have their whole sets counted; they need ``PERCENT`` % common
    tokens, and linked ones meet in a token among their rarest.
2.  Every node is verified against the most central node of each of its tokens,
    the text most others are copies of.
3.  Members of a token that are still in different components form a signature
    tree: leaves hold LEAF members, a node above FAN nodes, each with the OR of
    the token bitmaps below, the range of sizes and the range of component
    labels. The tree is traversed against itself; a pair of nodes goes on only
    while the overlap its bitmaps allow could reach the least their sizes need
    and its labels differ. Pairs of members that pass are verified.

Trees, traversal and verification are joins of rows, so a hot token's tree is
spread over tasks, and no task or driver holds a group.

Defined results
    null text: empty. No words: no shingles, linked with nothing.
    Fewer than five words: one shingle, the whole sequence.
    Repeated ids and rows: a row's component depends on its text alone.
    component_id is the smallest id of the component, null only when all are.
    Very long texts count whole. Empty table: no rows.
    Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.llm.rows import left_lookup, ranked, whole_text
from textmill.llm.text_arrays import SHINGLE, buffers, grouped, mix, shingles, slices, word_hashes, words
from textmill.operators.addresses import address, is_scan, split_by_bitmap
from textmill.operators.dedup import cluster_components
from textmill.session import materialize

PERCENT = 80
# Tokens that linked prefixes must share, in hundredths of the set.
EXTRA = 10
BITS = 2048
WORDS64 = BITS // 64
LEAF = 128
FAN = 8
SHARES = 64
# Frequent tokens are found in one row of SAMPLE; at most HOT of them.
SAMPLE, HOT = 16, 100_000
SLICE_BYTES = 2 << 20


def needed(n, percent: int):
    """The least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def shared_tokens(n):
    """l for a set of n."""
    return np.maximum(1, EXTRA * n // 100)


# Sets ------------------------------------------------------------------------


def lowered_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts and where each text's begin (n + 1 places)."""
    data, offsets = buffers(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    start, end, doc = words(data, offsets)
    key, doc = shingles(word_hashes(data, start, end), doc, size)
    order, head = grouped(key, doc)
    first = order[head]
    key, doc = key[first], doc[first]
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    return key, at


def total_by_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of unsigned values per text."""
    sums = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    return sums[at[1:]] - sums[at[:-1]]


def first_of_each(key: np.ndarray, at: np.ndarray, count: np.ndarray) -> pa.Array:
    """Per text its first ``count`` tokens."""
    offsets = np.append(0, np.cumsum(count))
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], count) + np.repeat(at[:-1], count)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(key[place].view(np.int64)))


def set_rows(texts: DataFrame, percent: int, size: int, whole: bool) -> DataFrame:
    """(at, id, n, hi, lo, tokens) of rows (at, id, text): hi and lo name the set, tokens are its prefix or all."""
    kind = pa.struct([("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<n:long,hi:long,lo:long,tokens:array<long>>")
    def described(batch: pa.Array) -> pa.Array:
        parts = []
        for first, last in slices(batch, SLICE_BYTES):
            key, at = lowered_sets(batch.slice(first, last - first), size)
            n = np.diff(at)
            count = n if whole else np.where(n > 0, n - needed(n, percent) + shared_tokens(n), 0)
            hi, lo = (total_by_text(mix(key ^ np.uint64(seed)), at).view(np.int64) for seed in (0x9D39247E33776D41, 0x2AF7398005AAA5C7))
            columns = [pa.array(n), pa.array(hi), pa.array(lo), first_of_each(key, at, count)]
            parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return texts.select("at", "id", described.asNondeterministic()("text").alias("s")).select("at", "id", "s.*")


def with_frequency(tokens: DataFrame) -> DataFrame:
    """(no, token, df) of the rows (no, token) whose token has two rows or more.

    Tokens a sample shows to be very frequent are counted where they are and
    joined by broadcast, so no task gets all rows of one. The others are sent
    once: counts and join read the same exchange.
    """
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sampled = tokens.where(F.pmod(F.xxhash64("no"), F.lit(SAMPLE)) == 0).groupBy("token").agg(F.count("*").alias("c"))
    sampled = materialize(sampled.where("c > 1"), "sampled")
    total = sampled.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    # At most HOT tokens can each hold a HOT-th of the uses.
    hot = materialize(sampled.where(F.col("c") * HOT >= total).select("token"), "hot")
    often = tokens.join(F.broadcast(hot), "token").groupBy("token").agg(F.count("*").alias("df"))
    often = materialize(often.where("df > 1"), "often")
    cold = tokens.join(F.broadcast(hot), "token", "left_anti").repartition(parts, "token")
    # Both columns are used on both sides, so that both read one exchange.
    counts = cold.groupBy("token").agg(F.count("no").alias("df"), F.min("no").alias("_a"), F.max("no").alias("_z"))
    rare = cold.join(counts.where("_a < _z").drop("_a", "_z").hint("merge"), "token")
    return rare.unionByName(tokens.join(F.broadcast(often), "token"))


def common_rows(signed: DataFrame, percent: int) -> DataFrame:
    """(hi, lo, no, at) of one row of every set with enough prefix tokens that other rows have in theirs as well."""
    tokens = signed.select(F.col("_row").alias("no"), F.explode("tokens").alias("token"))
    counts = with_frequency(tokens).groupBy("no").agg(F.count("*").alias("_c"))
    partner = F.ceil(percent * F.col("n") / 100)
    enough = F.col("_c") >= F.greatest(F.lit(1), F.floor(EXTRA * partner / 100))
    rows = signed.select(F.col("_row").alias("no"), "at", "n", "hi", "lo").join(counts, "no").where(enough)
    return rows.groupBy("hi", "lo").agg(F.min(F.struct("no", "at")).alias("_m")).select("hi", "lo", "_m.no", "_m.at")


def whole_sets(texts: DataFrame, alive: DataFrame, percent: int, size: int) -> DataFrame:
    """(no, n, tokens) of the sets of ``alive``, made anew from the rows at its addresses."""
    _, wanted = split_by_bitmap(texts, alive.select("at"), "at")
    rows = set_rows(wanted, percent, size, True)
    return rows.join(alive.select("no", "at"), "at").select("no", "n", "tokens")


def profiles(sets: DataFrame, percent: int) -> DataFrame:
    """(no, n, weight, tokens): common tokens of each set, rarest first, where there are enough to link.

    weight is the number of sets that its tokens stand in, all added up.
    """
    held = with_frequency(sets.select("no", F.explode("tokens").alias("token"))).groupBy("no")
    # Two lists of one aggregate keep one order.
    held = held.agg(F.collect_list(F.col("df").cast("int")).alias("_df"), F.collect_list("token").alias("_token"))
    held = held.join(sets.select("no", "n"), "no").where(100 * F.size("_df") >= percent * F.col("n"))
    ordered = F.sort_array(F.arrays_zip("_df", "_token"))
    weight = F.aggregate("_df", F.lit(0).cast("long"), lambda total, df: total + df)
    return held.select("no", "n", weight.alias("weight"), F.transform(ordered, lambda x: x["_token"]).alias("tokens"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that link, as (src, dst). The partners of a hot ``a`` fall into shares."""
    shared = pairs.withColumn("share", F.pmod(F.xxhash64("b"), F.lit(SHARES)).cast("int"))
    heads = shared.select("a", "share").distinct().join(
        sets.select(F.col("no").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a")), "a"
    )
    members = shared.join(sets.select(F.col("no").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b")), "b")
    both = F.size(F.array_intersect("t_a", "t_b"))
    links = (100 + percent) * both >= percent * (F.col("n_a") + F.col("n_b"))
    return members.join(heads, ["a", "share"]).where(links).select(F.col("a").alias("src"), F.col("b").alias("dst"))


# Signature trees ------------------------------------------------------------------


def bitmaps(sets: DataFrame) -> DataFrame:
    """(no, spare, bits): BITS hashed bits of each set and how many tokens it has more than bits."""

    @F.arrow_udf("array<long>")
    def hashed(lists: pa.Array) -> pa.Array:
        offsets = np.asarray(lists.offsets)
        tokens = np.asarray(lists.values)[offsets[0] : offsets[-1]].view(np.uint64) % np.uint64(BITS)
        owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
        out = np.zeros(len(lists) * WORDS64, np.uint64)
        place = owner * WORDS64 + (tokens >> np.uint64(6)).astype(np.int64)
        np.bitwise_or.at(out, place, np.uint64(1) << (tokens & np.uint64(63)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * WORDS64), pa.array(out.view(np.int64)))

    rows = sets.select("no", F.size("tokens").alias("_size"), hashed.asNondeterministic()("tokens").alias("bits"))
    ones = F.aggregate("bits", F.lit(0), lambda n, b: n + F.bit_count(b))
    return rows.select("no", (F.col("_size") - ones).alias("spare"), "bits")


def leaf_rows(members: DataFrame) -> DataFrame:
    """(token, at, ...) with the members of each leaf as lists; ``bits`` are those of all, one after the other."""
    lists = ["no", "n", "spare", "label", "bits"]
    grouped = members.groupBy("token", F.floor(F.col("_pos") / LEAF).alias("at"))
    grouped = grouped.agg(F.max("_size").alias("_size"), *[F.collect_list(c).alias(c) for c in lists])
    return materialize(grouped.withColumn("bits", F.flatten("bits")), "leaves")


def tree_levels(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of all tokens' trees from the leaves up: (token, at, bits, spare, low, high, label0, label1)."""
    most = -(-(leaves.agg(F.max("_size")).first()[0] or 0) // LEAF)
    words = [F.aggregate(F.transform(F.sequence(F.lit(k), F.size("bits") - 1, F.lit(WORDS64)), lambda i: F.col("bits")[i]),
                         F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)) for k in range(WORDS64)]
    lowest = leaves.select(
        "token", "at", F.array(*words).alias("bits"), F.array_max("spare").alias("spare"), F.array_min("n").alias("low"),
        F.array_max("n").alias("high"), F.array_min("label").alias("label0"), F.array_max("label").alias("label1"),
    )
    levels = [materialize(lowest, "tree")]
    while most > 1:
        grouped = levels[-1].groupBy("token", F.floor(F.col("at") / FAN).alias("at")).agg(
            F.array(*[F.bit_or(F.col("bits")[k]) for k in range(WORDS64)]).alias("bits"),
            F.max("spare").alias("spare"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.min("label0").alias("label0"), F.max("label1").alias("label1"),
        )
        levels.append(materialize(grouped, "tree"))
        most = -(-most // FAN)
    return levels


def could_link(percent: int) -> Column:
    """Whether some member below x and some below y may link and are not in one component yet.

    Shared tokens lie on shared bits, and a member has at most ``spare`` tokens more than bits.
    """
    both = F.zip_with("x.bits", "y.bits", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    most = F.aggregate(both, F.lit(0), add) + F.least("x.spare", "y.spare")
    apart = F.least("x.label0", "y.label0") != F.greatest("x.label1", "y.label1")
    sizes = (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    return apart & sizes & ((100 + percent) * most >= percent * (F.col("x.low") + F.col("y.low")))


def met(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (token, i, j) of one level beside their nodes, as p, x and y."""
    p, x, y = pairs.alias("p"), nodes.alias("x"), nodes.alias("y")
    left = p.join(x, (F.col("p.token") == F.col("x.token")) & (F.col("p.i") == F.col("x.at")))
    return left.join(y, (F.col("p.token") == F.col("y.token")) & (F.col("p.j") == F.col("y.at")))


def leaf_pairs(pairs: DataFrame, leaves: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the members of paired leaves that the same bounds leave."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                no, n, spare, label, bits = (
                    [np.asarray(row[f"{side}_{c}"].values) for side in "xy"] for c in ("no", "n", "spare", "label", "bits")
                )
                words = [w.view(np.uint64).reshape(-1, WORDS64) for w in bits]
                shared = np.zeros((len(no[0]), len(no[1])), np.int64)
                for w in range(WORDS64):
                    shared += np.bitwise_count(words[0][:, w, None] & words[1][None, :, w])
                most = shared + np.minimum(spare[0][:, None], spare[1][None, :])
                left, right = n[0][:, None], n[1][None, :]
                fits = (100 + percent) * most >= percent * (left + right)
                fits &= (100 * left >= percent * right) & (100 * right >= percent * left)
                fits &= label[0][:, None] != label[1][None, :]
                if row["i"].as_py() == row["j"].as_py():
                    fits = np.triu(fits, 1)
                i, j = np.nonzero(fits)
                a, b = no[0][i], no[1][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    lists = ["no", "n", "spare", "label", "bits"]
    rows = met(pairs, leaves).select("p.i", "p.j", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in lists])
    return rows.mapInArrow(compared, "a long, b long")


def traversed(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of the members (token, no, n, label, spare, bits, _pos, _size) that no bound on the way down rules out."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = leaf_rows(members)
    levels = tree_levels(leaves)
    pairs = levels[-1].select("token", F.col("at").alias("i"), F.col("at").alias("j"))
    for k in range(len(levels) - 1, -1, -1):
        pairs = met(pairs, levels[k]).where(could_link(percent)).select("p.token", "p.i", "p.j")
        if k:
            below = [F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1)).alias(c) for c in ("i", "j")]
            pairs = pairs.select("token", below[0], "j").select("token", "i", below[1]).where("i <= j")
            # A few rows that stand for much work: dealt out whatever their bytes.
            pairs = pairs.repartition(parts, "token", "i", "j")
    return leaf_pairs(pairs.repartition(parts, "token", "i", "j"), leaves, percent).distinct()


# Components ------------------------------------------------------------------------


def set_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, cluster_id) of every set of ``profiles`` with a link: components of all links."""
    # The first tokens of a set, of which linked sets share one; those no other set has come before all.
    first = F.size("tokens") - F.ceil(percent * F.col("n") / 100).cast("int") + 1
    members = sets.select("no", "n", "weight", F.explode(F.slice("tokens", F.lit(1), first)).alias("token"))
    heads = members.groupBy("token").agg(F.max(F.struct("weight", "no")).alias("_h"), F.count("*").alias("_c"))
    heads = heads.where("_c > 1").select("token", F.col("_h.no").alias("head"))
    headed = materialize(members.join(heads, "token").where("no <> head").select("token", "no", "n", "head"), "headed")
    stars = headed.select(F.col("head").alias("a"), F.col("no").alias("b")).distinct()
    links = materialize(verified(stars, sets, percent), "links")
    labels = cluster_components(links)

    known = headed.join(labels.select(F.col("id").alias("no"), F.col("cluster_id").alias("label")), "no", "left")
    known = known.select("token", "no", "n", F.col("label").isNull().alias("single"), F.coalesce("label", "no").alias("label"))
    mixed = known.groupBy("token").agg(F.min("label").alias("_a"), F.max("label").alias("_z")).where("_a < _z").select("token")
    rest = materialize(known.join(mixed, "token", "left_semi"), "mixed")
    if rest.isEmpty():
        return labels
    placed = ranked(rest, ["token"], ["single", "label", "n", "no"], "placed")
    bits = bitmaps(sets.join(rest.select("no").distinct(), "no", "left_semi"))
    members = placed.join(bits, "no").select("token", "no", "n", "label", "spare", "bits", "_pos", "_size")
    left = materialize(traversed(materialize(members, "tree-members"), percent), "open")
    if left.isEmpty():
        return labels
    more = materialize(verified(left, sets, percent), "links")
    return labels if more.isEmpty() else cluster_components(links.union(more))


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE
) -> DataFrame:
    """(id, n, component_id) of every row. Rows that are no file scan are written first, to be read by address."""
    texts = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    texts = texts if is_scan(texts) else materialize(texts, "texts")
    texts = texts.select(address().alias("at"), "id", "text")
    signed = materialize(set_rows(texts, percent, size, False).withColumn("_row", F.monotonically_increasing_id()), "signed")
    alive = materialize(common_rows(signed, percent), "alive")
    sets = materialize(whole_sets(texts, alive, percent, size), "sets")
    labels = set_links(materialize(profiles(sets, percent), "profiles"), percent)

    labelled = alive.join(labels, alive["no"] == labels["id"]).select("hi", "lo", F.col("cluster_id").alias("label"))
    every = signed.where("n > 0").groupBy("hi", "lo").agg(F.min("id").alias("least"), F.count("*").alias("_c"))
    every = every.join(labelled, ["hi", "lo"], "left").where("label is not null or _c > 1").drop("_c")
    every = materialize(every, "components")
    least = every.where("label is not null").groupBy("label").agg(F.min("least").alias("component"))
    by_set = every.join(least, "label", "left").select("hi", "lo", F.coalesce("component", "least").alias("component_id"))
    rows = left_lookup(signed.select("id", "n", "hi", "lo", "_row"), by_set, ["hi", "lo"], F.col("_row"))
    return rows.select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
