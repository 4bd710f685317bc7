"""Perplexity against SQL that counts whole words, not buckets."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from textmill.operators import perplexity as ppl
from textmill.registry import all_queries
from textmill.registry.model_queries import BIGRAM_CTES

def exact(folder, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    return con.execute(BIGRAM_CTES + sql).fetchall()


def test_counts_are_those_of_whole_words(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("doc_id", "id")
    got = {r.id: (r.lang, r.n_bigrams, r.perplexity) for r in ppl.fold_perplexity(docs, "id", ["lang"], F.col("id") % 2).collect()}
    want = {r[0]: r[1:] for r in exact(folder, " SELECT id, lang, n_bigrams, perplexity FROM pp")}
    assert got.keys() == want.keys()
    for i, (lang, n, value) in want.items():
        assert got[i][:2] == (lang, n) and got[i][2] == pytest.approx(value, rel=1e-9)


def test_rows_of_a_fold(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "a b d"), (3, "a"), (5, None), (7, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    # The other fold is empty: the rows stay, without a value.
    alone = ppl.fold_perplexity(df, "id", ["text"], F.col("id") % 2).collect()
    assert sorted((r.text, r.n_bigrams, r.perplexity) for r in alone) == [("a b c", 2, None)] * 2 + [("a b d", 2, None)]
    more = df.unionByName(spark.createDataFrame([(2, "a b a b")], df.schema))
    got = sorted((r.id, r.text, r.perplexity) for r in ppl.fold_perplexity(more, "id", ["text"], F.col("id") % 2).collect())
    ab, bc = 2.1 / (2 + 0.2), 0.1 / (1 + 0.2)
    assert [r[:2] for r in got] == [(1, "a b c"), (1, "a b c"), (1, "a b d"), (2, "a b a b")]
    for r in got[:3]:
        assert r[2] == pytest.approx((ab * bc) ** -0.5, rel=1e-5)
    back = (3.1 / (3 + 0.4)) ** 2 * (0.1 / (3 + 0.4))
    assert got[3][2] == pytest.approx(back ** (-1 / 3), rel=1e-5)


def test_blocks_cut_long_documents(spark, monkeypatch):
    """Blocks of 16 words: documents lie in several, words of all slots return to their places."""
    monkeypatch.setattr(ppl, "WORDS_AT_ONCE", 16)
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(i * 11 % 90))) for i in range(40)] + [(4, "a b"), (4, "a b")]
    got = ppl.fold_perplexity(spark.createDataFrame(rows, "id long, text string"), "id", ["text"], F.col("id") % 2).collect()
    pairs, firsts, known = ([{}, {}] for _ in range(3))
    for i, text in rows:
        w = text.split()
        for a, b in zip(w, w[1:]):
            pairs[i % 2][a, b] = pairs[i % 2].get((a, b), 0) + 1
            firsts[i % 2][a] = firsts[i % 2].get(a, 0) + 1
            known[i % 2][a] = known[i % 2][b] = 1
    want = []
    for i, text in rows:
        w, o = text.split(), 1 - i % 2
        p = [(pairs[o].get((a, b), 0) + 0.1) / (firsts[o].get(a, 0) + 0.1 * len(known[o])) for a, b in zip(w, w[1:])]
        if p:
            want.append((i, text, len(p), pytest.approx(math.exp(-sum(map(math.log, p)) / len(p)), rel=1e-5)))
    assert sorted(tuple(r) for r in got) == sorted(want, key=lambda r: r[:3])


def test_an_ngram_travels_once_per_block(spark):
    """Not once per document: 3,000 documents with the same words are a few entries."""
    coded = spark.range(3000).selectExpr("id AS doc", "id % 2 AS fold", "array(11L, 12L, 13L, id) AS codes").coalesce(1)
    blocks = ppl.gram_blocks(coded)
    # Per fold: bigrams 11-12 and 12-13, words 11, 12 and 13; per document a bigram and a last word (2, 3 and so on share one).
    assert 3000 < blocks.where("slot >= 0").agg(F.sum("size")).first()[0] < 2 * 3000 + 20


def test_registered_query_counts_exactly(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.id: r.perplexity for r in all_queries()["perplexity"](spark, folder).collect()}
    want = dict(exact(folder, " SELECT id, perplexity FROM pp"))
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=2e-6) for i in want)


@pytest.mark.parametrize("key", ["perplexity_summary", "merge_stats", "quality_analysis"])
def test_summaries_hold_all_documents(spark, sf, key):
    got = {r.lang: r for r in all_queries()[key](spark, sf).collect()}
    want = exact(sf, " SELECT lang, count(*), avg(perplexity), max(perplexity) FROM pp GROUP BY lang")
    assert got.keys() == {r[0] for r in want}
    for lang, n, mean, top in want:
        assert got[lang].n == n and got[lang].mean == pytest.approx(mean, abs=1e-3) and got[lang].max == pytest.approx(top, abs=1e-3)


def test_histogram_holds_all_documents(spark, sf):
    got = sorted(map(tuple, all_queries()["perplexity_histogram"](spark, sf).select("lang", "value", "n").collect()))
    assert got == sorted(exact(sf, " SELECT lang, round(perplexity) AS value, count(*) AS n FROM pp GROUP BY ALL"))


def test_merged_histograms_equal_one_pass(spark):
    """Values that no shard lists at its top but that win in the sum, ties at the border, null groups."""
    rows = [(s, g, float(v), 1 + (v * 7 + s * 3) % 11) for s in range(9) for g in ("x", None) for v in range(60) if (v + s) % 4]
    rows += [(s, "x", 500.0 + s, 40) for s in range(9)] + [(s, "x", 900.0, 14) for s in range(9)] + [(0, "small", 1.0, 2)]
    partials = spark.createDataFrame(rows, "shard int, lang string, value double, n long")
    totals = {}
    for _, g, v, n in rows:
        totals.setdefault(g, {}).setdefault(v, 0)
        totals[g][v] += n
    for k in (1, 3, 10, 100):
        want = sorted(
            ((g, v, n) for g, c in totals.items() for v, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]), key=str
        )
        got = ppl.merge_histograms(partials, ["lang"], k).select("lang", "value", "n").collect()
        assert sorted(map(tuple, got), key=str) == want
    assert ppl.merge_histograms(partials.where("false"), ["lang"], 3).count() == 0
