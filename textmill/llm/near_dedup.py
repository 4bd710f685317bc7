"""MinHash near-deduplication with ProbMinHash signatures.

A document is a set of five-word shingles weighted by how often they occur.
Every shingle is a Poisson process whose rate is its weight: its arrivals fall
on random registers, a register keeps the shingle that arrives first, and a
document stops as soon as no later arrival can be a first one. Two documents
agree on a register with the probability Jaccard similarity J_P of their
weighted shingles (plain Jaccard when no shingle repeats).

Registers form bands. In every bucket of a band each member is verified against
one head, the text that most of them are copies of, not against all others.
Members of one class then need no further check, and exact bounds (the distances
to the head, as 1 - J_P is a metric, and the weight of shingles that only one
text has) rule most other pairs out. Only what is left, pairs of different
classes that may still be close, is verified as well. Classes are the connected
components of all verified links; equal texts are one node from the start.

Defined results
    null text: the empty text. Wordless texts are alike only when equal.
    A text of fewer than five words has one shingle, all its words.
    Repeated ids and rows: a row's class depends on its text alone; the class
    id is the smallest id in the class (null only when all its ids are null), so
    classes that share a repeated id share the class id, but not the label.
    Very long texts count whole.
    Empty table: no rows. Only the id and the text are read; a column named _id or _node
    is replaced in keep_one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.llm.rows import left_lookup, whole_text
from textmill.llm.text_arrays import SHINGLE, give_back, grouped, mix, slices, text_shingles
from textmill.operators.dedup import cluster_components
from textmill.session import materialize

BANDS = 24
ROWS = 5
THRESHOLD = 0.8
SHARES = 64
# Bits and members of a comparison.
BITS = 2048
WORDS64 = BITS // 64
LEAF = 256
# Text signed or compared at a time, which bounds a worker's arrays.
SIGNED_BYTES = 2 << 20


# Signatures ------------------------------------------------------------------


def weighted(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per text, ordered by text and hash: hash, text number, count."""
    order, head = grouped(key, doc)
    first = order[head]
    return key[first], doc[first], np.diff(np.append(head, len(key)))


def prob_minhash(key: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The first shingle to arrive at each register of each text (0 where there is none)."""
    first = np.full(n_docs * registers, np.inf)
    who = np.zeros(n_docs * registers, np.uint64)
    state, time = mix(key), np.zeros(len(key))
    while len(key):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight
        slot = doc * registers + (mix(state ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        who[slot[won]] = key[won]
        # Later arrivals of a shingle that is already behind all registers change nothing.
        alive = time < first.reshape(n_docs, registers).max(axis=1)[doc]
        key, doc, weight, state, time = key[alive], doc[alive], weight[alive], state[alive], time[alive]
    return who.reshape(n_docs, registers)


def band_keys(texts: pa.Array, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> list[np.ndarray]:
    """One 64-bit key per band and text; none for texts without words."""
    out = []
    for first, last in slices(texts, SIGNED_BYTES):
        key, doc, weight = weighted(*text_shingles(texts.slice(first, last - first), size))
        who = prob_minhash(key, doc, weight, last - first, bands * rows).reshape(last - first, bands, rows)
        code = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (last - first, 1))
        for k in range(rows):
            code = mix(code ^ who[:, :, k])
        some = np.zeros(last - first, bool)
        some[doc] = True
        out += [c.view(np.int64) if s else c[:0].view(np.int64) for c, s in zip(code, some)]
    give_back()
    return out


def digest(text: Column) -> Column:
    """128 bits of the text's SHA-256: the node equal texts share."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def signed_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, node, bands) of every row; no text travels."""

    @F.arrow_udf("array<long>")
    def keys(texts: pa.Array) -> pa.Array:
        return pa.array(band_keys(texts, bands, rows), pa.list_(pa.int64()))

    whole = df.select(F.col(id_col).alias("id"), whole_text(text).alias("_text"))
    return whole.select("id", digest(F.col("_text")).alias("node"), keys("_text").alias("bands"))


# Verification ----------------------------------------------------------------


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets given as sorted hashes and weights."""
    both = np.union1d(a[0], b[0])
    if not len(both):
        return 1.0
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])] = a[1]
    y[np.searchsorted(both, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # For a shared i: sum over j of max(x_j / x_i, y_j / y_i), split at the ratio of i.
    shared = np.flatnonzero((x > 0) & (y > 0))
    upto = np.searchsorted(ratio, ratio[shared], "right")
    below, above = np.append(0, np.cumsum(x))[upto], y.sum() - np.append(0, np.cumsum(y))[upto]
    return float((1.0 / (below / x[shared] + above / y[shared])).sum())


def similarities(left: pa.Array, right: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """J_P of the texts of each row."""
    sides = []
    for texts in (left, right):
        key, doc, weight = weighted(*text_shingles(texts, size))
        sides.append((key, weight, np.searchsorted(doc, np.arange(len(texts) + 1))))
    out = np.empty(len(left))
    for i in range(len(left)):
        pair = [(key[at[i] : at[i + 1]], weight[at[i] : at[i + 1]]) for key, weight, at in sides]
        out[i] = probability_jaccard(*pair)
    return out


def node_texts(df: DataFrame, nodes: DataFrame, id_col: str, text: str) -> DataFrame:
    """(node, text) for nodes given with the id of one row that holds them."""
    rows = df.select(F.col(id_col).alias("_id"), whole_text(text).alias("text")).withColumn("node", digest(F.col("text")))
    wanted = nodes.select("node", F.col("id").alias("_id"))
    met = rows.join(wanted, (rows["node"] == wanted["node"]) & rows["_id"].eqNullSafe(wanted["_id"]), "left_semi")
    return met.select("node", "text").dropDuplicates(["node"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Add sim, the exact J_P, to distinct pairs (a, b).

    The partners of a hot ``a`` fall into shares, and its text is sent once per
    share that exists.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_a, text_b = batch.column("text_a"), batch.column("text_b")
            for first, last in slices(text_a, SIGNED_BYTES):
                # A range bounded by the left texts is cut again by the right ones.
                for f, l in slices(text_b.slice(first, last - first), SIGNED_BYTES):
                    at, n = first + f, l - f
                    sim = similarities(text_a.slice(at, n), text_b.slice(at, n))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("a").slice(at, n), batch.column("b").slice(at, n), pa.array(sim)], ["a", "b", "sim"]
                    )

    shared = pairs.withColumn("share", F.pmod(F.xxhash64("b"), F.lit(SHARES)).cast("int"))
    heads = shared.select("a", "share").distinct().join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    members = shared.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    met = members.join(heads, ["a", "share"]).select("a", "b", "text_a", "text_b")
    return met.mapInArrow(measured, "a binary, b binary, sim double")


# Classes ---------------------------------------------------------------------


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(band, node, head) for buckets of two or more nodes.

    The head is the member whose own buckets are the fullest, which is the text
    that most others are copies of; of equals the largest node.
    """
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    sizes = exploded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    full = materialize(left_lookup(exploded, sizes, ["band"], F.col("node")).where("n > 1"), "full")
    ranked = full.join(full.groupBy("node").agg(F.sum("n").alias("rank")), "node").select("band", "node", "rank")
    heads = ranked.groupBy("band").agg(F.max(F.struct("rank", "node")).alias("_h")).select("band", F.col("_h.node").alias("head"))
    return left_lookup(full.select("band", "node"), heads, ["band"], F.col("node"))


def masses(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per text (node) its weight in shingles that other texts have too and in its own, and a bitmap of the former.

    own, common: weight of shingles no other text has, and of the others;
    bits: BITS hashed bits of the different common shingles.
    """

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column("text"), 1 << 20):
                key, doc, weight = weighted(*text_shingles(batch.column("text").slice(first, last - first), size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, last - first).take(pa.array(doc)), pa.array(key.view(np.int64)), pa.array(weight)],
                    ["node", "key", "weight"],
                )

    @F.arrow_udf("array<long>")
    def hashed(lists: pa.Array) -> pa.Array:
        offsets = np.asarray(lists.offsets)
        place = np.asarray(lists.values)[offsets[0] : offsets[-1]].view(np.uint64) % np.uint64(BITS)
        word = np.repeat(np.arange(len(lists)) * WORDS64, np.diff(offsets)) + (place >> np.uint64(6)).astype(np.int64)
        out = np.zeros(len(lists) * WORDS64, np.uint64)
        np.bitwise_or.at(out, word, np.uint64(1) << (place & np.uint64(63)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * WORDS64), pa.array(out.view(np.int64)))

    rows = texts.select("node", "text").mapInArrow(exploded, "node binary, key long, weight long")
    common = rows.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key", F.lit(1).alias("_c"))
    shared = F.col("_c").isNotNull()
    summed = rows.join(common, "key", "left").groupBy("node").agg(
        F.sum(F.when(shared, 0).otherwise(F.col("weight"))).alias("own"),
        F.sum(F.when(shared, F.col("weight")).otherwise(0)).alias("common"),
        F.collect_list(F.when(shared, F.col("key"))).alias("_keys"),
    )
    return summed.select("node", "own", "common", hashed.asNondeterministic()("_keys").alias("bits"))


def open_members(members: DataFrame, sims: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, node, label, far) of buckets with more than one class; far is the distance to the head."""
    to_head = sims.select(F.col("a").alias("head"), F.col("b").alias("node"), "sim")
    known = (
        members.join(to_head, ["head", "node"], "left")
        .join(labels.select(F.col("id").alias("node"), F.col("cluster_id").alias("label")), "node", "left")
        .select("band", "node", F.coalesce("label", "node").alias("label"), (1 - F.coalesce("sim", F.lit(1.0))).alias("far"))
    )
    mixed = known.groupBy("band").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high")
    # Pairs with the head (far = 0) are settled; a text that shares nothing with it settles nothing.
    return known.join(mixed.select("band"), "band", "left_semi").where("far > 0")


def open_pairs(members: DataFrame, mass: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one bucket and of different classes that no bound rules out as links.

    Two bounds, both exact. The distances to the head may not differ by more
    than 1 - threshold. And with own weight p and common weight g on each side
    J_P is at most 1 / (1 + p/g + p'/g'), where common weight that the other side
    does not have counts as own: a bit of one bitmap that the other lacks stands for
    one shingle at least. A bucket's members are dealt to leaves of about LEAF;
    pairs of leaves are rows, so a large bucket is spread over tasks, and what
    leaves them are the few pairs that pass.
    """
    edge = 1 / threshold
    alive = mass.where((F.col("common") > 0) & (1 + F.col("own") / F.col("common") <= edge + 1e-9))
    sized = materialize(members.join(alive, "node"), "open-members")
    leaves = sized.groupBy("band").agg(F.ceil(F.count("*") / LEAF).alias("_leaves")).where("_leaves > 0")
    lists = ["node", "label", "far", "own", "common", "bits"]
    # A band's number of leaves is one row beside all its members: small, and joined as the planner likes.
    dealt = sized.join(leaves, "band").withColumn("leaf", F.pmod(F.xxhash64("node"), F.col("_leaves")))
    packed = dealt.groupBy("band", "leaf").agg(*[F.collect_list(c).alias(c) for c in lists])
    packed = materialize(packed.withColumn("bits", F.flatten("bits")), "open-leaves")

    def left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = ({c: batch.column(f"{side}_{c}")[k].values for c in lists} for side in "xy")
                words = [np.asarray(side["bits"]).view(np.uint64).reshape(-1, WORDS64) for side in (x, y)]
                both = np.zeros((len(words[0]), len(words[1])), np.int64)
                for w in range(WORDS64):
                    both += np.bitwise_count(words[0][:, w, None] & words[1][None, :, w])
                bound = np.ones(both.shape)
                for side, axis, w in ((x, (slice(None), None), words[0]), (y, (None, slice(None)), words[1])):
                    missing = np.bitwise_count(w).sum(axis=1, dtype=np.int64)[axis] - both
                    own, common = np.asarray(side["own"])[axis], np.asarray(side["common"])[axis]
                    bound += (own + missing) / np.maximum(common - missing, 1e-9)
                far = np.abs(np.asarray(x["far"])[:, None] - np.asarray(y["far"])[None, :])
                label = np.unique(np.array(x["label"].to_pylist() + y["label"].to_pylist(), object), return_inverse=True)[1]
                keep = (bound <= edge + 1e-9) & (far <= 1 - threshold + 1e-9)
                keep &= label[: len(both), None] != label[None, len(both) :]
                if batch.column("i")[k].as_py() == batch.column("j")[k].as_py():
                    keep = np.triu(keep, 1)
                i, j = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays([x["node"].take(pa.array(i)), y["node"].take(pa.array(j))], ["a", "b"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.col("_leaves") - 1
    pairs = leaves.select("band", "_leaves", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    pairs = pairs.select("band", "i", F.explode(F.sequence(F.col("i"), last)).alias("j")).repartition(parts, "band", "i", "j")
    left = packed.select("band", F.col("leaf").alias("i"), *[F.col(c).alias(f"x_{c}") for c in lists])
    right = packed.select("band", F.col("leaf").alias("j"), *[F.col(c).alias(f"y_{c}") for c in lists])
    met = pairs.join(left, ["band", "i"]).join(right, ["band", "j"]).select("i", "j", *[f"{side}_{c}" for side in "xy" for c in lists])
    found = met.mapInArrow(left_open, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_classes(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(id, node, label, class_id) of every row; class_id is the smallest id of the row's class.

    The label tells classes apart even when ids repeat and two classes share their smallest.
    """
    signed = materialize(signed_rows(df, id_col, text, bands, rows), "signed")
    nodes = materialize(
        signed.groupBy("node").agg(F.min("id").alias("id"), F.min_by("bands", "bands").alias("bands"), F.count("*").alias("n")),
        "nodes",
    )
    members = materialize(bucket_members(nodes), "buckets")

    stars = materialize(
        members.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "stars"
    )
    ends = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node")))
    texts = materialize(node_texts(df, nodes.join(ends, "node", "left_semi"), id_col, text), "texts")
    sims = materialize(verified(stars, texts), "sims")
    links = sims.where(F.col("sim") >= threshold).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    labels = cluster_components(links)
    parts = materialize(open_members(members, sims, labels), "mixed")
    held = texts.join(parts.select("node"), "node", "left_semi")
    left = materialize(open_pairs(parts, masses(held), threshold), "open")
    if not left.isEmpty():
        more = verified(left, texts).where(F.col("sim") >= threshold)
        labels = cluster_components(links.union(more.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    # Only nodes with a copy or a link can have a class id other than the row's own.
    grouped = nodes.select("node", "id", "n").join(
        labels.select(F.col("id").alias("node"), F.col("cluster_id").alias("label")), "node", "left"
    ).where("label is not null or n > 1")
    grouped = materialize(grouped.select("node", "id", F.coalesce("label", "node").alias("label")), "grouped")
    lowest = grouped.groupBy("label").agg(F.min("id").alias("class_id"))
    by_node = left_lookup(grouped.select("node", "label"), lowest, ["label"], F.col("node"))
    return left_lookup(signed.select("id", "node"), by_node, ["node"], F.col("id")).select(
        "id", "node", F.coalesce("label", "node").alias("label"), F.coalesce("class_id", "id").alias("class_id")
    )


def keep_one(df: DataFrame, classes: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one with the class id, and of its repeated rows a single one.

    ``classes`` is the (written) result of near_classes for the same rows. When
    all ids of a class are null, one row of each of its texts stays. Rows to drop are matched
    by id and node, so the texts of the others need not move when those are few.
    """
    key = ["_id", "_node"]
    rows = df.withColumns({"_id": F.col(id_col), "_node": digest(whole_text(text))})
    known = classes.select(F.col("id").alias("_id"), F.col("node").alias("_node"), "label", "class_id")
    # A class keeps its smallest id; of several texts of the class with that id the smallest node.
    stays = known.where("_id = class_id").groupBy("label").agg(F.min("_id").alias("_id"), F.min("_node").alias("_node"))
    stays = stays.select("_id", "_node")
    counted = known.groupBy(*key).agg(F.count("*").alias("_n"), F.max("class_id").alias("_class"))
    kept_key = stays.withColumn("_stays", F.lit(True))
    judged = counted.join(
        kept_key, counted["_id"].eqNullSafe(kept_key["_id"]) & (counted["_node"] == kept_key["_node"]), "left"
    ).select(counted["_id"], counted["_node"], "_n", F.coalesce("_stays", F.col("_class").isNull()).alias("_stays"))
    special = materialize(judged.where("not _stays or _n > 1"), "special")

    def matched(side: DataFrame, table: DataFrame, how: str) -> DataFrame:
        t = table.select(F.col("_id").alias("_i"), F.col("_node").alias("_d"))
        return side.join(t, side["_id"].eqNullSafe(t["_i"]) & (side["_node"] == t["_d"]), how)

    kept = matched(rows, special, "left_anti")
    repeated = special.where("_stays")
    if not repeated.isEmpty():
        # Rows equal in id and text, which are rare: only these pay for a second pass.
        kept = kept.unionByName(matched(rows, repeated, "left_semi").dropDuplicates(key))
    return kept.drop(*key)
