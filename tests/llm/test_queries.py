"""The registered queries and the pipeline over the smallest tables."""

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from textmill.llm import packing, secrets, toxicity
from textmill.llm.queries import ORACLES, QUERIES
from tools.check_oracles import TABLES, compare

KEY = {"op1_token_counts": None, "op4_decontamination": None, "op7_url_filters": "pages", "op9_html_extraction": "pages", "op8_packing": None}


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, sf, key):
    ok, note = compare(spark, con, key, QUERIES[key], ORACLES.get(key), sf)
    assert ok, note
    named = KEY.get(key, "documents")
    if named:
        assert QUERIES[key](spark, sf).count() == spark.read.parquet(f"{sf}/{named}.parquet").count()


def test_leaks_are_the_passages_that_stand_in_the_texts(spark, sf, con):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontamination"](spark, sf).collect()}
    exact = con.execute("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall()
    assert set(exact) <= got


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, sf), name)
        assert docs.columns == columns
        kept = {r["doc_id"] for r in docs.collect()}
        all_ids = {r["doc_id"] for r in before.collect()}
        assert kept <= all_ids
        if name == "toxicity":
            model = toxicity.fit_model(toxicity.labelled_sample(before, spark.read.parquet(f"{sf}/labels.parquet")))
            low = toxicity.score_texts(before, model).where(f"score < {toxicity.THRESHOLD}")
            assert kept == {r["doc_id"] for r in low.collect()}
        elif name == "near_dedup":
            texts = [r["text"] for r in docs.collect()]
            assert len(set(texts)) == len(texts)
            grams = [set(map(tuple, zip(*(t.split()[k:] for k in range(5))))) or {tuple(t.split())} for t in texts]
            for i, a in enumerate(grams):
                for b in grams[:i]:
                    shared = len(a & b)
                    assert shared == 0 or shared / len(a | b) < 0.8
        elif name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            gone = [r["text"] for r in before.collect() if r["doc_id"] not in kept]
            assert not any(i in r["text"] for r in docs.collect() for i in items)
            assert all(any(i[:40] in t or i[-40:] in t for i in items) for t in gone)
        else:
            assert kept == all_ids
            left = secrets.findings(docs, secrets.update_ledger(docs))
            assert left.where("size(secret_spans) > 0").count() == 0
            changed = docs.join(before.withColumnRenamed("text", "old").drop("n_chars", "lang", "source"), "doc_id")
            assert all("[SECRET]" in r["text"] for r in changed.where("text <> old").collect())
            assert docs.where("n_chars <> length(text)").count() == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = corpus_pipeline.pack(spark, docs, sf).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    assert {r["doc_id"] for r in pieces} == set(ids)
    for r in pieces:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in pieces) == sum(map(len, ids.values()))
    run = corpus_pipeline.run(spark, sf).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in run} == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in pieces}
