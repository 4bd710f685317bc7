"""The Jaccard join against all pairs."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import jaccard_trees
from textmill.llm.queries import QUERIES
from textmill.session import materialize

SCHEMA = "doc_id long, text string, hi string, lo string, n int, id int, _row int, token int, label int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain(rows):
    """(id, n, component) by comparing all pairs that share a shingle."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for members in holders.values():
        for x, i in enumerate(members):
            for j in members[:x]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                        parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def joined(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, 3, 4, 5) for r in rows], SCHEMA)
    return sorted(map(tuple, jaccard_trees.jaccard_components(df).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"x{rng.integers(10**9)}"
    return " ".join(words)


def prose(rng, n):
    return [f"w{k}" for k in rng.integers(0, 3000, n)]


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d"), (7, "A b c d"), (7, "a b c d"),
    (None, "a b c d"), (None, "q r s t u v"), (None, None), (8, "é É     z"), (9, "É É     z"), (10, "k " * 300_000), (11, "K " * 7),
    (12, "a b c d e"), (13, "a b c d e f"), (14, "a b c d e f g h i"), (15, "a b c d e f g h i j"), (16, "a b c d e f g h i j k"),
]


def test_odd_rows(spark):
    rows = ODD + [(20, " ".join(f"v{i}" for i in range(60_000))), (21, " ".join(f"v{i}" for i in range(52_000)))]
    assert joined(spark, rows) == plain(rows)
    assert joined(spark, []) == []


def near_groups():
    """Copies around the threshold, unions of passages, and texts of one passage only."""
    rng = np.random.default_rng(3)
    rows, passage = [], prose(rng, 60)
    for size, length, edits in [(30, 120, 2), (40, 120, 3), (60, 200, 5), (50, 60, 1), (25, 30, 1)]:
        base = prose(rng, length)
        rows += [edited(rng, base, int(rng.integers(1, edits + 1))) for _ in range(size)]
    rows += [" ".join([*prose(rng, int(rng.integers(1, 90))), *passage]) for _ in range(60)]
    chain = prose(rng, 400)
    rows += [" ".join(chain[i : i + 100]) for i in range(0, 300, 9)]
    return [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("leaf", [3, 128])
def test_near_groups(spark, monkeypatch, leaf):
    # Small leaves make trees of several levels.
    monkeypatch.setattr(jaccard_trees, "LEAF", leaf)
    monkeypatch.setattr(jaccard_trees, "FAN", 2)
    rows = near_groups()
    assert joined(spark, rows) == plain(rows)


def test_traversal_loses_no_link(spark, monkeypatch):
    """Without the star step every link must come out of the trees alone."""
    monkeypatch.setattr(jaccard_trees, "LEAF", 3)
    monkeypatch.setattr(jaccard_trees, "FAN", 3)
    rows = near_groups()[:120]
    texts = spark.createDataFrame(rows, "id long, text string").withColumn("at", F.lit(0))
    sets = jaccard_trees.set_rows(texts, 80, 5, True).withColumn("no", F.col("id"))
    sets = materialize(jaccard_trees.profiles(sets.select("no", "n", "tokens"), 80))
    first = F.size("tokens") - F.ceil(80 * F.col("n") / 100).cast("int") + 1
    members = sets.select("no", "n", F.explode(F.slice("tokens", F.lit(1), first)).alias("token"))
    members = members.withColumns({"single": F.lit(True), "label": F.col("no")})
    placed = jaccard_trees.ranked(members, ["token"], ["single", "label", "n", "no"], "placed")
    members = materialize(placed.join(jaccard_trees.bitmaps(sets), "no"))
    assert len(jaccard_trees.tree_levels(jaccard_trees.leaf_rows(members))) > 2
    pairs = materialize(jaccard_trees.traversed(members, 80))
    found = {tuple(sorted(r)) for r in jaccard_trees.verified(pairs, sets, 80).collect()}
    known = {i: grams(t) for i, t in rows}
    links = {
        (a, b) for a in known for b in known
        if a < b and known[a] & known[b] and 100 * len(known[a] & known[b]) >= 80 * len(known[a] | known[b])
    }
    assert found == links and len(links) > 50
    assert pairs.count() < 40 * len(links)


def test_query_against_all_pairs(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op12_jaccard_join"](spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)
