"""Exact and MinHash deduplication.

Signatures and bands are computed in the row. Buckets link every member to one
head through salted groups, so a bucket with a large share of all documents is
spread over many tasks and still yields a linear number of edges.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from textmill.functions.arrays import explode_once, let
from textmill.functions.text import words
from textmill.operators.addresses import address, is_scan, split_by_bitmap
from textmill.operators.skew import hot_keys, salted_join
from textmill.session import materialize

NUM_BUCKETS = 14
HASHES_PER_BUCKET = 8
N_GRAMS = 5
BUCKET_SALTS = 256
PRIME_31 = 2**31 - 1
_MASK = 2**64 - 1
TEXT_AT_ONCE = 1 << 20


ROW_KEY = "_key"


def keyed_rows(df: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows with a key of their own: the id and what tells rows of one id apart.

    Ids may repeat (parts of a document, injected copies); keys do not, and they
    order rows by id first. Rows of a file scan are keyed by their address, so
    nothing is written; others are written once, numbered, and read from there.
    """
    if is_scan(df):
        return df.withColumn(ROW_KEY, F.struct(F.col(id_col).alias("id"), *[address()[c].alias(c) for c in ("file", "row")]))
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    return numbered.withColumn(ROW_KEY, F.struct(F.col(id_col).alias("id"), F.col("_row").alias("row"))).drop("_row")


def split_rows_by_key(rows: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyed rows that are not in ``gone`` (keys), and those that are.

    Addressed rows are tested where they are scanned, against a bitmap per file.
    """
    if "file" in rows.schema[ROW_KEY].dataType.fieldNames():
        return split_by_bitmap(rows, gone, ROW_KEY)
    return rows.join(gone, ROW_KEY, "left_anti"), rows.join(gone, ROW_KEY, "left_semi")


def exact_duplicate_keys(digests: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Keys of all but the smallest key of every ``_digest``; only keys and digests travel."""
    winners = digests.groupBy(F.col("_digest").alias("_d")).agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # Null texts are equal as well.
    copies = digests.join(winners.where("_n > 1"), F.col("_digest").eqNullSafe(F.col("_d")))
    return copies.where(F.col(key) != F.col("_first")).select(key)


def exact_dedup(df: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """One row per distinct text, the one with the smallest id (any one of several equal rows)."""
    rows = keyed_rows(df, id_col)
    # Digests are read twice, texts once for them and once for the result.
    digests = materialize(rows.select(ROW_KEY, F.unhex(F.sha2(text, 256)).alias("_digest")), "digests")
    kept, _ = split_rows_by_key(rows, exact_duplicate_keys(digests))
    return kept.drop(ROW_KEY)


def hash_coefficients(count: int, precision: int, seed: int = 1) -> list[tuple[int, int]]:
    """Multiplier and offset per hash function, from a splitmix sequence."""
    state, drawn = seed, []
    for _ in range(2 * count):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        drawn.append(z ^ (z >> 31))
    if precision == 64:
        return [(a | 1, b) for a, b in zip(drawn[::2], drawn[1::2])]
    return [(1 + a % (PRIME_31 - 1), b % PRIME_31) for a, b in zip(drawn[::2], drawn[1::2])]


def shingle_hashes(word_list: Column, n: int, precision: int) -> Column:
    """One hash per run of n words: seeded 64-bit, or the leading 32 bits of MD5."""

    def hashed(w: Column) -> Column:
        spots = F.sequence(F.lit(1), F.size(w) - n + 1)
        if precision == 64:
            codes = F.transform(w, lambda x: F.xxhash64(x))
            body = let(codes, lambda c: F.transform(spots, lambda i: F.xxhash64(F.slice(c, i, n))))
        else:
            body = F.transform(
                spots,
                lambda i: F.conv(F.substring(F.md5(F.array_join(F.slice(w, i, n), " ")), 1, 8), 16, 10)
                .cast("long"),
            )
        return F.when(F.size(w) >= n, body).otherwise(F.array().cast("array<bigint>"))

    return let(word_list, hashed)


_MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_MD5_START = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]


def md5_heads(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The leading 32 bits of the MD5 of each run of bytes; runs of one MD5 block are worked on side by side."""
    out = np.empty(len(start), np.uint32)
    many = np.flatnonzero(size > 55)
    out[many] = [int.from_bytes(hashlib.md5(data[i : i + n].tobytes()).digest()[:4], "big") for i, n in zip(start[many], size[many])]
    few, at = np.flatnonzero(size <= 55), np.arange(64)
    # By length: which bytes of a block are the run's, and what stands behind them.
    own = np.where(at < np.arange(56)[:, None], 255, 0).astype(np.uint8)
    behind = np.where(at == np.arange(56)[:, None], 128, 0).astype(np.uint8)
    behind.view("<u8")[:, 7] = np.arange(56) * 8
    windows = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(64, np.uint8)), 64)
    for part in np.array_split(few, len(few) // 4096 + 1):
        block = windows[start[part]] & own[size[part]] | behind[size[part]]
        words_of = np.ascontiguousarray(block.view("<u4").T)
        a, b, c, d = (np.full(len(part), x, np.uint32) for x in _MD5_START)
        for i in range(64):
            if i < 16:
                mixed, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                mixed, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                mixed, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                mixed, g = c ^ (b | ~d), 7 * i % 16
            mixed += a
            mixed += words_of[g]
            mixed += np.uint32(_MD5_SINES[i])
            turn = _MD5_TURNS[i // 16][i % 4]
            a, d, c, b = d, c, b, b + ((mixed << np.uint32(turn)) | (mixed >> np.uint32(32 - turn)))
        out[part] = (a + np.uint32(_MD5_START[0])).byteswap()
    return out


def _md5_shingles(joined: list[bytes], counts: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text (its words, joined by spaces) the hashes of its runs of n words; as shingle_hashes with 32 bits."""
    data = np.frombuffer(b" ".join(joined), np.uint8)
    gaps = np.flatnonzero(data == 32)
    start, end = np.append(0, gaps + 1), np.append(gaps, len(data))
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
    heads = md5_heads(data, start[whole], end[whole + n - 1] - start[whole])
    return np.split(heads.astype(np.int64), np.cumsum(counts - n + 1)[:-1])


def _minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, precision: int) -> np.ndarray:
    best = None
    prime, bits = np.uint64(PRIME_31), np.uint64(31)
    # Short parts, whose values stay in the processor's cache.
    for at in range(0, len(hashes), 128):
        column = hashes[at : at + 128].astype(np.int64).view(np.uint64)[:, None]
        if precision == 64:
            value = (column ^ b) * a
            value ^= value >> np.uint64(32)
        else:
            # The remainder by 2^31 - 1: the bits above the 31st are added to those below, twice; the prime itself is 0.
            value = column * a
            value += b
            for _ in range(2):
                high = value >> bits
                value &= prime
                value += high
            if value.max() >= prime:
                value[value >= prime] -= prime
        low = value.min(axis=0)
        best = low if best is None else np.minimum(best, low)
    return best.view(np.int64)


def signature(
    df: DataFrame,
    num_buckets: int = NUM_BUCKETS,
    hashes_per_bucket: int = HASHES_PER_BUCKET,
    n_grams: int = N_GRAMS,
    bit_precision: int = 64,
    text: str = "text",
) -> DataFrame:
    """Add signature: num_buckets * hashes_per_bucket minima; empty below n_grams words."""
    if bit_precision not in (32, 64):
        raise ValueError("bit_precision is 32 or 64")
    pairs = hash_coefficients(num_buckets * hashes_per_bucket, bit_precision)
    a = np.array([p[0] for p in pairs], np.uint64)
    b = np.array([p[1] for p in pairs], np.uint64)

    empty = np.empty(0, np.int64)

    @F.pandas_udf(ArrayType(LongType()))
    def minima(lists: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([_minima(h, a, b, bit_precision) if n else empty for h, n in zip(lists, sizes)])

    @F.pandas_udf(ArrayType(LongType()))
    def md5_minima(joined: pd.Series, counts: pd.Series) -> pd.Series:
        out = [empty] * len(joined)
        held = [i for i, n in enumerate(counts) if n >= n_grams]
        ends = np.cumsum([len(joined[i]) for i in held])
        first = 0
        while first < len(held):
            # Some texts at a time, and one at least.
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + TEXT_AT_ONCE, "right")))
            some = held[first:last]
            lists = _md5_shingles([joined[i] for i in some], counts.to_numpy()[some], n_grams)
            for i, hashes in zip(some, lists):
                out[i] = _minima(hashes, a, b, bit_precision)
            first = last
        return pd.Series(out)

    # Marked so that the plan never copies the call into later expressions.
    minima, md5_minima = minima.asNondeterministic(), md5_minima.asNondeterministic()
    if bit_precision == 32:
        # Words hold no spaces, so joined by them they can be told apart again.
        df = df.withColumn("_words", words(F.col(text)))
        joined = F.coalesce(F.array_join("_words", " "), F.lit("")).cast("binary")
        return df.withColumn("signature", md5_minima(joined, F.coalesce(F.size("_words"), F.lit(0)))).drop("_words")
    # The hashes are used twice, which keeps them a column of their own: nested
    # lambdas must not end up inside the arguments of a Python function.
    df = df.withColumn("_hashes", shingle_hashes(words(F.col(text)), n_grams, bit_precision))
    return df.withColumn("signature", minima(F.col("_hashes"), F.size("_hashes"))).drop("_hashes")


def bands(
    signatures: DataFrame,
    id_col: str = "id",
    num_buckets: int = NUM_BUCKETS,
    hashes_per_bucket: int = HASHES_PER_BUCKET,
) -> DataFrame:
    """One row per document and band, keyed by 128 bits of the band's hashes."""

    def keyed(i: Column) -> Column:
        part = F.slice("signature", i * hashes_per_bucket + 1, hashes_per_bucket)
        return F.struct(
            i.alias("band"), F.xxhash64(part).alias("hi"), F.xxhash64(F.lit(1), part).alias("lo")
        )

    index = F.sequence(F.lit(0), F.lit(num_buckets - 1))
    signed = signatures.where(F.size("signature") > 0)
    return explode_once(signed, [id_col], F.transform(index, keyed), "k").select(id_col, "k.band", "k.hi", "k.lo")


def star_edges(
    members: DataFrame, keys: list[str], id_col: str = "id", salt: Column | None = None
) -> DataFrame:
    """Edges (src, dst) that connect all ids sharing a key; dst is the smaller id.

    Each id is linked to the head of its salted share of the key, each head to
    the key's smallest id. Heads come from map-side combined minima, so no task
    holds all ids of a key, and never are all pairs made.
    """
    if salt is None:
        salt = F.pmod(F.xxhash64(id_col), F.lit(BUCKET_SALTS))
    salted = members.withColumn("_salt", salt)
    heads = salted.groupBy(*keys, "_salt").agg(F.min(id_col).alias("_head"))
    tops = heads.groupBy(*keys).agg(F.min("_head").alias("_top"))
    inner = salted.join(heads, [*keys, "_salt"]).where(F.col(id_col) != F.col("_head")).select(
        F.col(id_col).alias("src"), F.col("_head").alias("dst")
    )
    outer = heads.join(tops, keys).where("_head <> _top").select(F.col("_head").alias("src"), F.col("_top").alias("dst"))
    return inner.union(outer).distinct()


def minhash_buckets(
    signatures: DataFrame,
    id_col: str = "id",
    num_buckets: int = NUM_BUCKETS,
    hashes_per_bucket: int = HASHES_PER_BUCKET,
    salt: Column | None = None,
) -> DataFrame:
    """Candidate edges: documents that agree on all hashes of at least one band.

    The bands are written once; both levels of edges read them, not the texts.
    """
    members = materialize(bands(signatures, id_col, num_buckets, hashes_per_bucket), "bands")
    return star_edges(members, ["band", "hi", "lo"], id_col, salt)


def cluster_components(edges: DataFrame) -> DataFrame:
    """Connected components as (id, cluster_id), cluster_id being the smallest id.

    Each round takes the smallest label of the neighbours, hooks it to the
    current parent as well, and halves the paths; every round is written out,
    and the loop ends when no label changes (labels only fall, so it ends).
    The joins have one row per id on one side; the rows of a hub on the other
    are split by adaptive execution, and minima are combined before they travel.
    """
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = edges.where("src <> dst").select(F.explode(ways).alias("e")).select("e.src", "e.dst")
    both = materialize(both.distinct(), "edges")
    labels = materialize(
        both.groupBy("src").agg(F.min("dst").alias("_m"))
        .select(F.col("src").alias("id"), F.least("src", "_m").alias("f")),
        "labels",
    )
    while True:
        of_neighbour = labels.select(F.col("id").alias("dst"), "f")
        nearest = both.join(of_neighbour, "dst").groupBy("src").agg(F.min("f").alias("m"))
        known = labels.join(nearest, labels["id"] == nearest["src"]).select("id", "f", "m")
        offers = known.select(
            F.explode(
                F.array(
                    F.struct(F.col("id").alias("id"), F.least("f", "m").alias("f")),
                    F.struct(F.col("f").alias("id"), F.least("f", "m").alias("f")),
                )
            ).alias("o")
        )
        hooked = materialize(offers.groupBy("o.id").agg(F.min("o.f").alias("f")), "hooked")
        parents = hooked.select(F.col("id").alias("f"), F.col("f").alias("g"))
        compared = hooked.join(parents, "f").join(labels.select("id", F.col("f").alias("_old")), "id").select(
            "id", F.col("g").alias("f"), (F.col("g") != F.col("_old")).alias("moved")
        )
        labels = materialize(compared, "labels")
        if labels.where("moved").isEmpty():
            return labels.select("id", F.col("f").alias("cluster_id"))


def removable(clusters: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids that are not the survivor of their cluster."""
    return clusters.where("id <> cluster_id").select(F.col("id").alias(id_col))


def minhash_filter(df: DataFrame, clusters: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Kept rows (one per cluster, all unclustered ones) and removed rows.

    ``id_col`` must tell rows apart; with repeated ids use keyed_rows and its key.
    """
    gone = removable(clusters, id_col)
    return df.join(gone, id_col, "left_anti"), df.join(gone, id_col, "left_semi")


def near_dup_overlap(
    df: DataFrame, clusters: DataFrame, id_col: str = "id", n_grams: int = N_GRAMS, text: str = "text"
) -> DataFrame:
    """Exact shingle Jaccard of each removed document with its survivor: linear in documents."""
    hashes = F.array_distinct(shingle_hashes(words(F.col(text)), n_grams, 64))
    clustered = df.select(F.col(id_col).alias("id"), text).join(clusters, "id")
    sets = clustered.select("id", "cluster_id", hashes.alias("s"))
    members = sets.where("id <> cluster_id")
    heads = sets.where("id = cluster_id").select("cluster_id", F.col("s").alias("t"))
    shared = F.size(F.array_intersect("s", "t"))
    big = hot_keys(clusters.where("id <> cluster_id"), ["cluster_id"])
    return salted_join(members, heads, ["cluster_id"], ["id"], hot=big).select(
        "id", "cluster_id", (shared / (F.size("s") + F.size("t") - shared)).alias("jaccard")
    )


def inject_duplicates(df: DataFrame, id_col: str = "id", percent: int = 5, seed: int = 1) -> DataFrame:
    """Put a repeatable sample of about ``percent`` % of the rows in front of the full table.

    Numeric ids; the draw depends on the id alone, not on partitions.
    """
    draw = F.pmod((F.col(id_col) + seed) * F.lit(7919), F.lit(100))
    return df.where(draw < percent).unionByName(df)
