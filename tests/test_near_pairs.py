"""Near pairs against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import near_pairs
from textmill.session import materialize


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows, threshold):
    first, out = {}, []
    for i, t in sorted(rows):
        if t is None:
            continue
        if t in first:
            out.append((first[t], i, 1.0, True))
        else:
            first[t] = i
    sets = [(i, shingles(t)) for t, i in first.items()]
    for x, (i, s) in enumerate(sets):
        for j, r in sets[:x]:
            both = len(s & r)
            if both and both / (len(s) + len(r) - both) >= threshold:
                out.append((min(i, j), max(i, j), both / (len(s) + len(r) - both), False))
    return sorted(out)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"x{rng.integers(10**9)}"
    return " ".join(words)


def prose(rng, n):
    return [f"w{k}" for k in rng.integers(0, 2000, n)]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_pairs_against_all_pairs(spark, threshold):
    rng = np.random.default_rng(8)
    texts = [None, None, "", "", "a b c d", "a b c d", "a b c d e", "a  b c d e", "k " * 5000, "k " * 9]
    for size, length, edits in [(25, 100, 2), (30, 200, 5), (20, 40, 1), (15, 300, 20)]:
        base = prose(rng, length)
        texts += [edited(rng, base, int(rng.integers(0, edits + 1))) for _ in range(size)]
        texts += [" ".join(base[k:]) for k in range(0, 25, 4)]
    passage = prose(rng, 50)
    texts += [" ".join([*prose(rng, int(rng.integers(1, 60))), *passage]) for _ in range(40)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    got = near_pairs.near_dup_pairs(spark.createDataFrame(rows, "id long, text string"), threshold)
    assert got.columns == ["a", "b", "jaccard", "copy"]
    assert sorted(map(tuple, got.collect())) == plain(rows, threshold)


def test_no_rows(spark):
    assert near_pairs.near_dup_pairs(spark.createDataFrame([], "id long, text string")).count() == 0


def work(spark, members):
    """Pairs that leave the join, for one group of near copies of a text, and the links among them."""
    rng = np.random.default_rng(5)
    base = prose(rng, 120)
    rows = [(i, edited(rng, base, 3)) for i in range(members - 50)]
    # Fifty of them are copied with one more word at the end: links to find among the others.
    rows += [(members + i, rows[i * 7][1] + f" end{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(8)
    nodes = materialize(near_pairs.text_nodes(df))
    sets = materialize(near_pairs.shared_shingles(df, nodes, 0.8, 5, "id", "text"))
    pairs = materialize(near_pairs.candidate_pairs(sets, 0.8))
    found = {(r["a"], r["b"]) for r in near_pairs.verified_pairs(pairs, sets, 0.8).collect()}
    return rows, pairs.count(), found


def test_a_large_group_of_near_copies_stays_below_quadratic_work(spark):
    _, few, links = work(spark, 1250)
    wasted = few - len(links)
    rows, many, found = work(spark, 5000)
    assert {(i * 7, 5000 + i) for i in range(50)} <= found
    sets = {i: shingles(t) for i, t in rows}
    assert all(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 for a, b in found)
    # Links are the result. Of 12.5 million other pairs fewer than members leave the join, and
    # their number grows far slower than sixteen times.
    assert many - len(found) < 5000 and many - len(found) <= 8 * max(wasted, 50), (few, many, len(links), len(found))


def test_only_texts_that_may_have_a_partner_are_looked_at_as_a_whole(spark, monkeypatch):
    rng = np.random.default_rng(6)
    junk = [f"junk{k}" for k in range(12)]
    texts = [" ".join([*prose(rng, int(rng.integers(60, 300))), *junk]) for _ in range(300)]
    pairs = [prose(rng, int(rng.integers(60, 300))) for _ in range(12)]
    texts += [edited(rng, p, k) for p in pairs for k in (0, 1)]
    written, write = {}, near_pairs.materialize

    def recorded(df, label):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(near_pairs, "materialize", recorded)
    rows = list(enumerate(texts))
    got = near_pairs.near_dup_pairs(spark.createDataFrame(rows, "id long, text string"))
    assert sorted(map(tuple, got.collect())) == plain(rows, 0.8)
    assert {r["id"] for r in written["sets"].select("id").collect()} == set(range(300, 324))
    whole = sum(len(shingles(t)) for t in texts)
    assert written["heads"].agg(F.sum(F.size("_h.first"))).first()[0] < 0.35 * whole


def test_pairs_that_just_reach_the_threshold(spark, tmp_path):
    """Of n shingles the other text has 0.8 n and no others; rows of a file scan, some of them copies."""
    texts = []
    for n in range(5, 205, 5):
        words = [f"a{n}b{k}" for k in range(n + 4)]
        texts += [" ".join(words), " ".join(words[: n * 4 // 5 + 4]), " ".join(words[n // 5 - 1 :] if n % 2 else words)]
    rows = [(i * 7 % len(texts), t) for i, t in enumerate(texts)]
    spark.createDataFrame([*rows, (None, texts[0]), (500, None)], "id long, text string").repartition(3).write.parquet(str(tmp_path / "t"))
    got = near_pairs.near_dup_pairs(spark.read.parquet(str(tmp_path / "t")))
    want = plain(rows, 0.8)
    assert sum(j == 0.8 for _, _, j, _ in want) >= 40 and sorted(map(tuple, got.collect())) == want


def test_a_set_travels_once_per_block_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_pairs, "BLOCK", 8)
    rng = np.random.default_rng(7)
    sets = {i: sorted(rng.choice(60, 50, replace=False).tolist()) for i in range(40)} | {i: [900, 901, i] for i in range(50, 53)}
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 40)] + [(50, 51), (51, 52)]
    held = spark.createDataFrame([(i, len(s) + i % 3, s) for i, s in sets.items()], "id long, n int, shared array<long>")
    asked = spark.createDataFrame(pairs, "a long, b long")
    blocks = near_pairs.pair_blocks(asked)
    assert sorted(tuple(r) for r in blocks.select("a", "b").collect()) == sorted(pairs)
    # 1,564 sets if every pair brought its own.
    sent = blocks.selectExpr("lead", "i", "j", "explode(array(a, b)) as id").distinct().count()
    assert sent < 600 and blocks.groupBy("lead", "i", "j").count().agg(F.max("count")).first()[0] < 400

    def jaccard(a, b):
        both = len(set(sets[a]) & set(sets[b]))
        return both / (len(sets[a]) + a % 3 + len(sets[b]) + b % 3 - both)

    for threshold in (0.4, 0.7, 2.0):
        got = near_pairs.verified_pairs(asked, held, threshold)
        assert sorted(map(tuple, got.collect())) == sorted((a, b, jaccard(a, b)) for a, b in pairs if jaccard(a, b) >= threshold)
