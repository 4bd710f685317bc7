import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import dedup
from textmill.plans.stages import deduplication


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id").select("id", "text")


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def run_components(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    return {r.id: r.cluster_id for r in dedup.cluster_components(df).collect()}


def test_components_on_chains_stars_and_random_graphs(spark):
    chain = [(i + 1, i) for i in range(60)]
    star = [(1000 + i, 1000) for i in range(1, 200)] + [(5000, 1100)]
    rng = random.Random(5)
    loose = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(260)]
    edges = [(a, b) for a, b in chain + star + loose if a != b]
    assert run_components(spark, edges) == components(edges)


def test_hot_bucket_stays_linear_and_connected(spark):
    members = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 700).alias("key"))
    edges = [(r.src, r.dst) for r in dedup.star_edges(members, ["key"]).collect()]
    assert len(edges) < 5000
    assert all(d < s for s, d in edges)
    got = components(edges)
    hot = [i for i in range(5000) if i % 3 == 0]
    assert {got[i] for i in hot} == {0}


@pytest.mark.parametrize("bits", [32, 64])
def test_clusters_find_near_copies(docs, bits):
    texts = {r.id: shingles(r.text) for r in docs.collect()}
    edges = dedup.minhash_buckets(dedup.signature(docs, bit_precision=bits).drop("text"))
    clusters = {r.id: r.cluster_id for r in dedup.cluster_components(edges).collect()}
    for a, b in combinations(sorted(texts), 2):
        x, y = texts[a], texts[b]
        if x and y and len(x & y) / len(x | y) >= 0.95:
            assert clusters.get(a) == clusters.get(b) is not None, (a, b)
    for i, c in clusters.items():
        if i != c and not texts[i] & texts[c]:
            linked = [j for j, k in clusters.items() if k == c and j != i and texts[j] & texts[i]]
            assert linked, (i, c)


def test_overlap_report_matches_python(docs):
    clusters = dedup.cluster_components(dedup.minhash_buckets(dedup.signature(docs).drop("text")))
    texts = {r.id: shingles(r.text) for r in docs.collect()}
    rows = dedup.near_dup_overlap(docs, clusters).collect()
    assert rows
    for r in rows:
        a, b = texts[r.id], texts[r.cluster_id]
        assert r.jaccard == pytest.approx(len(a & b) / len(a | b))


def test_injected_copies_go_and_a_second_run_removes_nothing(docs):
    more = dedup.inject_duplicates(docs)
    assert more.count() == docs.count() * 105 // 100
    before, done = deduplication(docs), deduplication(more)
    kept = sorted(map(tuple, done.kept.collect()))
    assert kept == sorted(map(tuple, before.kept.collect()))
    assert done.removed.count() == before.removed.count() + more.count() - docs.count()
    again = deduplication(done.kept)
    short = F.size(F.split(F.trim("text"), "\\s+")) < 5
    assert again.removed.where(~short).isEmpty()


def test_rows_with_one_id_are_told_apart(spark):
    def words(seed):
        return " ".join(f"w{seed}x{i}" for i in range(40))

    rows = [(1, 0, words(1)), (2, 0, words(2)), (2, 1, words(1)), (3, 0, words(3)), (3, 1, words(1) + " x"), (3, 2, words(3))]
    df = spark.createDataFrame(rows, "id long, part int, text string")
    done = deduplication(df)
    assert sorted((r.id, r.part) for r in done.kept.collect()) == [(1, 0), (2, 0), (3, 0)]
    assert sorted((r.id, r.part, r.filter_reason) for r in done.removed.collect()) == [
        (2, 1, "exact"), (3, 1, "minhash"), (3, 2, "exact")
    ]
    assert sorted(r.text for r in dedup.exact_dedup(df).collect()) == sorted({t for _, _, t in rows})


def test_short_texts_have_no_band_but_copies_go(spark):
    rows = [(1, "one two"), (2, "one two"), (3, "one two three"), (4, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    assert dedup.bands(dedup.signature(df)).isEmpty()
    done = deduplication(df)
    assert sorted(r.id for r in done.kept.collect()) == [1, 3, 4]
    assert [(r.id, r.filter_reason) for r in done.removed.collect()] == [(2, "exact")]


def test_components_of_hubs_and_chains(spark):
    edges = [(1000 + i, 1000) for i in range(1, 120)] + [(i + 1, i) for i in range(30)] + [(1050, 3)]
    assert run_components(spark, edges) == components(edges)


def test_md5_heads_are_those_of_md5():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 9000).astype(np.uint8)
    size = np.append(rng.integers(0, 130, 6000), [0, 55, 56, 63, 64])
    start = rng.integers(0, 8800, len(size))
    start[:50] = 9000 - size[:50]
    want = [int(hashlib.md5(data[i : i + n].tobytes()).hexdigest()[:8], 16) for i, n in zip(start, size)]
    assert dedup.md5_heads(data, start, size).tolist() == want


def test_minima_are_remainders_by_the_prime():
    """Hashes at the borders, among them those whose value is the prime or a multiple of it."""
    pairs = dedup.hash_coefficients(112, 32)
    a, b = (np.array(x, np.uint64) for x in zip(*pairs))
    p = dedup.PRIME_31
    zeros = [(-int(y) * pow(int(x), -1, p)) % p for x, y in pairs]
    for hashes in ([0, 1, p - 1, p, p + 1, 2**32 - 1, 2**32 - 2], zeros, list(range(4000, 4300)), [2**32 - 1]):
        want = [min((h * int(x) + int(y)) % p for h in hashes) for x, y in pairs]
        assert dedup._minima(np.array(hashes), a, b, 32).tolist() == want


def test_signature_of_32_bits_hashes_runs_of_words(spark, monkeypatch):
    """Texts in several slices; null, empty and short ones between them."""
    monkeypatch.setattr(dedup, "TEXT_AT_ONCE", 60)
    texts = [None, "", "a b c d", " é  b\tc d e f ", "x" * 70 + " b c d e", *[f"t{i} u v w x y{i} z" for i in range(40)], " ", "a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    a, b = (np.array(x, np.uint64) for x in zip(*dedup.hash_coefficients(112, 32)))
    for r in dedup.signature(df, bit_precision=32).collect():
        w = (r.text or "").split()
        runs = [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
        hashes = np.array([int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in runs], np.int64)
        assert r.signature == (dedup._minima(hashes, a, b, 32).tolist() if runs else [])
