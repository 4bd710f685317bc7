"""Term lists against a scan in Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import gazetteer, pii
from textmill.operators.gazetteer import listed_entities

SCHEMA = "term string, type string, public boolean"


def plain(text, terms, longest):
    table = {}
    for term, kind, public in set(terms):
        table.setdefault(term, []).append((kind, bool(public)))
    spots, out = [m.span() for m in re.finditer(r"\w+", text or "")], []
    for i, (start, _) in enumerate(spots):
        for j in range(i, len(spots)):
            if j > i and text[spots[j - 1][1] : spots[j][0]] != " ":
                break
            end = spots[j][1]
            out += [(start, end, kind, text[start:end], public) for kind, public in table.get(text[start:end], ())]
    if not longest:
        return sorted(out)
    chosen, reach = [], 0
    while any(r[0] >= reach for r in out):
        start = min(r[0] for r in out if r[0] >= reach)
        end = max(r[1] for r in out if r[0] == start)
        chosen += [r for r in out if r[:2] == (start, end)]
        reach = end
    return sorted(chosen)


@pytest.mark.parametrize("longest", [False, True])
@pytest.mark.parametrize("shard_terms", [7, 10**6])
def test_matches_against_a_scan(spark, longest, shard_terms):
    rng = random.Random(4)
    words = ["de", "van", "Jan", "é", "漢字", "straat", "12", "x_y", "\U00010400a", "A"]
    phrase = lambda n: " ".join(rng.choice(words) for _ in range(n))
    terms = [(phrase(rng.randint(1, 8)), rng.choice(["NAME", "PLACE"]), rng.random() < 0.3) for _ in range(400)]
    terms += [("de van", "NAME", True), ("de van", "PLACE", None), ("de  van", "NAME", False), ("O'Neil", "NAME", False), ("", "NAME", False), (None, "NAME", False)]
    texts = [None, "", " ", "de van de van", "de  van", "O'Neil de", "Jan"] + [phrase(rng.randint(1, 60)) for _ in range(60)]
    texts += [re.sub(" ", lambda m: rng.choice([" ", " ", " ", "  ", "\n", ", "]), phrase(200)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    out = df.withColumn("e", listed_entities(F.col("text"), spark.createDataFrame(terms, SCHEMA), longest, shard_terms))
    for r in out.collect():
        assert sorted(map(tuple, r.e)) == plain(texts[r.id], [t for t in terms if t[0]], longest), texts[r.id]


def test_no_terms_and_no_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    df = spark.createDataFrame([(1, "a b")], "id int, text string")
    assert df.select(F.size(listed_entities(F.col("text"), none))).first()[0] == 0
    assert df.where("false").select(listed_entities(F.col("text"), none)).count() == 0


def test_two_million_terms_one_shard_at_a_time(spark):
    n = 2_000_000
    more = F.expr("transform(sequence(2, 8), i -> if(i <= 1 + id % 8, concat(' w', pmod(id * i, 997)), ''))")
    # A third of all terms begin with one word.
    head = F.when(F.col("id") % 3 == 0, F.concat(F.lit("de v"), F.col("id").cast("string"))).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
    terms = spark.range(n).select(F.concat(head, F.array_join(more, "")).alias("term"), F.lit("NAME").alias("type"), F.lit(False).alias("public"))
    rows = gazetteer.shard_rows(terms)
    sizes = rows.select(F.size("ends").alias("e"), F.size("inner").alias("i")).collect()
    # A shard is 8 bytes per inner state and 11 per term; a worker holds one.
    bound = 1.3 * gazetteer.SHARD_TERMS
    assert len(sizes) == 11 and sum(s.e for s in sizes) == n and max(s.e for s in sizes) < bound
    assert max(8 * s.i + 11 * s.e for s in sizes) < 16 << 20
    want = {r.id: r.term for r in terms.withColumn("id", F.monotonically_increasing_id()).where("xxhash64(term) % 20011 = 0").collect()}
    texts = spark.createDataFrame([(f"zz {t}, de {t} w", t) for t in want.values()], "text string, term string")
    sent, shards = gazetteer.send_shards(rows)
    assert shards == 11 and sorted(s for s, _ in sent) == list(range(11))
    out = texts.repartition(2).withColumn("e", listed_entities(F.col("text"), terms, longest=True)).collect()
    assert len(out) > 60
    for r in out:
        found = [x.entity for x in r.e]
        assert r.term in found and all(x in (r.term, f"{r.term} w") or r.term.startswith(x) for x in found)


def test_passes_do_not_grow_with_small_shards(spark):
    terms = spark.range(600).select(F.concat(F.lit("t"), F.col("id") % 300, F.lit(" w"), "id").alias("term"), F.lit("NAME").alias("type"), F.lit(False).alias("public"))
    rows = gazetteer.shard_rows(terms, 20)
    sent, shards = gazetteer.send_shards(rows)
    assert shards == 31 and rows.count() > 20 and len(sent) == 1
    n = gazetteer.SHARD_TERMS
    assert gazetteer.bundles([(0, 1, n // 2), (1, 0, n // 2), (3, 5, 1), (4, 8 * n, 1), (6, 0, n + 5)]) == [(0, 1), (3, 3), (4, 4), (6, 6)]


def test_joined_runs_are_few_and_whole(spark):
    rng = random.Random(5)
    terms = [(f"a{i} b{i}", "NAME", False) for i in range(50)] + [("c1", "NAME", None), ("d e f", "PLACE", True), (None, "NAME", False), ("g  h", "NAME", False), ("d e f g", "NAME", True)]
    texts = [None, "", "c1", "d\u0001e f g", "g  h"] + [" ".join(f"{rng.choice('abcdefg')}{rng.choice(['', rng.randint(0, 300)])}" for _ in range(400)) for _ in range(30)]
    df, listed = spark.createDataFrame(list(enumerate(texts)), "id int, text string"), spark.createDataFrame(terms, SCHEMA)
    runs = gazetteer.likely_runs(df, listed, "id", F.col("text"), 3)
    assert runs.count() < 1000
    got = {r.id: sorted((*e[:4], bool(e[4])) for e in r.entities) for r in pii.gazetteer_matches(df, listed).collect()}
    for i, text in enumerate(texts):
        assert got.get(i, []) == plain((text or "").replace("\u0001", " "), [t for t in terms if t[0] and t[0] != "d e f g"], False)
