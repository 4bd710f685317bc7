"""Batches of similar length, order, and a ledger that survives restarts."""

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.operators import inference

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def padding_model():
    """Answers with the padding of each text in its batch."""
    return lambda texts: [str(max(map(len, texts)) - len(t)) for t in texts]


def test_bucketed_batches_need_less_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").coalesce(1)
    total = lambda df: df.agg(F.sum(F.col("text").cast("long"))).first()[0]
    plain = total(inference.apply_model(docs, padding_model, 32))
    bucketed = inference.bucketed_model(docs, padding_model, 32)
    # Sorted by length a batch of 32 pads to its own longest.
    lengths = sorted(len(r.text) for r in docs.collect())
    want = sum(sum(max(lengths[i : i + 32]) - n for n in lengths[i : i + 32]) for i in range(0, len(lengths), 32))
    assert total(bucketed) == want < plain / 5
    assert [r.doc_id for r in bucketed.collect()] == [r.doc_id for r in docs.collect()]


def test_answers_belong_to_their_rows(spark):
    rows = [(i, None if i % 50 == 0 else "x" * (i * 7 % 90) + f"|{i}", i / 2) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, text string, score double").repartition(3)

    def shout():
        return lambda texts: [t.upper() for t in texts]

    for window in (1, 33, 10_000):
        got = inference.bucketed_model(df, shout, 8, out="loud", window=window)
        assert got.columns == ["id", "text", "score", "loud"]
        assert sorted(map(tuple, got.collect())) == sorted((i, t, s, (t or "").upper()) for i, t, s in rows)
    chunks = inference.translate(df.where("text is not null"), shout, 3, 4)
    assert {r.id: r.text for r in chunks.collect()} == {i: t.upper() for i, t, _ in rows if t is not None}
    assert inference.bucketed_model(df.where("false"), shout, 8).count() == 0


def counting(log, fail_on=None):
    """A model that logs every text it sees; it fails when it meets ``fail_on``."""

    def factory():
        def model(texts):
            if fail_on in texts:
                raise RuntimeError("lost")
            with open(log, "a") as out:
                out.writelines(f"{t}\n" for t in texts)
            return [t[::-1] for t in texts]

        return model

    return factory


def test_a_restart_repeats_nothing(spark, tmp_path):
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    df = spark.createDataFrame([(i, f"text {i % 300}") for i in range(900)], "id long, text string").repartition(4)
    with pytest.raises(Exception, match="lost"):
        inference.ledgered_model(df, counting(log, "text 7"), ledger, "m", rounds=10)
    done = {r[0] for r in inference.ledger_rows(spark, ledger).select("answer").collect()}
    assert 0 < len(done) < 300
    Path(log).write_text("")
    got = inference.ledgered_model(df, counting(log), ledger, "m", rounds=10)
    assert sorted(map(tuple, got.collect())) == sorted((i, f"text {i % 300}"[::-1]) for i in range(900))
    seen = Path(log).read_text().split("\n")[:-1]
    # Every text once, and none that a finished round had answered.
    assert len(seen) == len(set(seen)) == 300 - len(done) and not done & {t[::-1] for t in seen}
    Path(log).write_text("")
    more = spark.createDataFrame([(1, "text 5"), (2, "new"), (3, None)], "id long, text string")
    out = inference.ledgered_model(more, counting(log), ledger, "m", rounds=3, out="answer")
    assert sorted(map(tuple, out.collect())) == [(1, "text 5", "5 txet"), (2, "new", "wen"), (3, None, "")]
    assert sorted(Path(log).read_text().split("\n")) == ["", "", "new"]
    # Another model does not share answers.
    other = inference.ledgered_model(more, counting(log), ledger, "other", rounds=1)
    assert other.count() == 3 and Path(log).read_text().count("text 5\n") == 1
