import sys
import tracemalloc

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.operators import inference, language, perplexity as ppl, toxicity
from textmill.plans import stages
from textmill.session import materialize


cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id")


@pytest.fixture(scope="module")
def language_model(docs):
    return language.fit_language_model(docs)


def test_language_is_mostly_right_and_total(spark, docs, language_model):
    out = language_model.detect(docs)
    right = out.where("language = lang").count()
    assert right / docs.count() > 0.95
    edge = spark.createDataFrame([(1, ""), (2, None), (3, "ab"), (4, "\U0001f600\U0001f600\U0001f600")], "id long, text string")
    rows = {r.id: r for r in language_model.detect(edge).collect()}
    assert all(rows[i].language is None and rows[i].language_score == 0.0 for i in (1, 2, 3))
    assert rows[4].language is not None


def calibration_error(judged):
    """Mean distance of score and share of right answers over ten bins of the score."""
    rows = judged.select(F.col("_best.score").alias("s"), (F.col("_best.language") == F.col("label")).cast("int").alias("r")).where("s > 0").collect()
    bins = {}
    for r in rows:
        bins.setdefault(min(9, int(r.s * 10)), []).append(r)
    return sum(abs(sum(r.s for r in b) - sum(r.r for r in b)) for b in bins.values()) / len(rows), len(rows)


def test_language_scores_are_calibrated_on_held_out_examples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumnRenamed("doc_id", "id")
    # Copies of a document must not stand on both sides.
    docs = docs.dropDuplicates(["text"]).repartition(8)
    fold = lambda k: docs.where(F.pmod("id", F.lit(3)) == k)
    plain = language.fit_language_model(fold(0))
    model = language.calibrate(plain, language.calibration_examples(fold(1), step=3))
    held = language.calibration_examples(fold(2), step=3)
    short = held.where("kind <> 'whole'").where(F.size(F.split("text", " ")).between(5, 50))
    for name, examples in (("all", held), ("short", short), ("mixed", held.where("kind = 'mix'"))):
        error, n = calibration_error(model.evidence(examples))
        raw, _ = calibration_error(plain.evidence(examples))
        assert n > 3000 and error <= 0.05, (name, error, raw, n)
        assert name != "mixed" or error < raw / 5, (error, raw)
    # A limit of 0.65 now parts right answers from wrong ones.
    judged = model.evidence(held).where(F.col("_best.language").isNotNull())
    right = F.col("_best.language") == F.col("label")
    low, high = (judged.where(c).agg(F.avg(right.cast("int"))).first()[0] for c in (F.col("_best.score") < 0.65, F.col("_best.score") >= 0.65))
    assert low < 0.75 < 0.95 < high


def test_monotone_shares():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = rng.integers(1, 9, 12).astype(float)
        right = rng.random(12) * n
        got = language.monotone(right, n)
        # Pool adjacent violators, one at a time.
        pools = [[r, m, 1] for r, m in zip(right, n)]
        while any(a[0] / a[1] > b[0] / b[1] for a, b in zip(pools, pools[1:])):
            k = next(k for k in range(len(pools) - 1) if pools[k][0] / pools[k][1] > pools[k + 1][0] / pools[k + 1][1])
            pools[k : k + 2] = [[x + y for x, y in zip(pools[k], pools[k + 1])]]
        assert np.allclose(got, np.repeat([r / m for r, m, _ in pools], [c for _, _, c in pools]))


def test_merged_spread_keeps_its_digits(spark):
    rows = [("x", 1_000_000 + 0.03 * (-1) ** i) for i in range(1000)] + [(None, 5.0)]
    scored = spark.createDataFrame(rows, "lang string, perplexity double").repartition(7)
    merged = {r.lang: r.std for r in ppl.merge_stats(ppl.partial_stats(scored, ["lang"]), ["lang"]).collect()}
    assert merged["x"] == pytest.approx(0.03, rel=1e-4) and merged[None] == 0.0


def test_merged_stats_equal_one_pass(docs):
    scored = materialize(ppl.fold_perplexity(docs, "id", ["lang"], F.col("id") % 2))
    merged = {r.lang: r for r in ppl.merge_stats(ppl.partial_stats(scored.repartition(5), ["lang"]), ["lang"]).collect()}
    for r in ppl.perplexity_summary(scored, ["lang"]).collect():
        m = merged[r.lang]
        assert (m.n, m.min, m.max) == (r.n, r.min, r.max)
        assert m.mean == pytest.approx(r.mean) and m.std == pytest.approx(r.std, rel=1e-6)
    whole = ppl.perplexity_histogram(scored, ["lang"])
    assert whole.groupBy("lang").count().count() == ppl.top_values(whole, ["lang"], 1).count()


def test_toxic_spans_point_into_the_text(spark):
    more = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{more}/documents.parquet").withColumnRenamed("doc_id", "id")
    labels = spark.read.parquet(f"{more}/labels.parquet").withColumnRenamed("doc_id", "id")
    model = toxicity.fit_toxicity_model(docs.join(labels, "id"))
    out = toxicity.toxic_doc_flag(toxicity.toxic_spans(docs, model, threshold=0.2, max_chunk_length=80))
    hits = 0
    for r in out.select("text", "ToxicLanguage", "is_toxic", "max_toxicity").collect():
        assert r.is_toxic == bool(r.ToxicLanguage)
        for s in r.ToxicLanguage:
            hits += 1
            assert r.text[s.start_index : s.start_index + len(s.sentence)] == s.sentence
            assert 0.2 <= s.score <= r.max_toxicity and len(s.sentence) <= 80
    assert hits


def test_pieces_are_the_text(docs):
    whole = F.array_join(toxicity.pieces(F.col("text"), 60), "")
    assert docs.where(whole != F.col("text")).isEmpty()


def reverse_model():
    return lambda texts: [t[::-1] for t in texts]


def sizes_model():
    return lambda texts: [str(len(texts)) for _ in texts]


def dutch_model():
    return lambda texts: list(texts)


def test_batches_have_the_asked_size(spark):
    df = spark.range(70).select("id", F.lit("x").alias("text")).coalesce(1)
    got = inference.apply_model(df, sizes_model, 32).orderBy("id").collect()
    assert [r.text for r in got] == ["32"] * 64 + ["6"] * 6


def test_translation_by_chunks(spark):
    df = spark.createDataFrame([(1, "abcdefg"), (2, ""), (3, "één twee drie")], "id long, text string").repartition(3)
    out = {r.id: r.text for r in inference.translate(df, reverse_model, chunk_size=3).collect()}
    assert out == {1: "cbafedg", 2: "", 3: "".join(t[::-1] for t in ("één", " tw", "ee ", "dri", "e"))}
    tokens = {r.id: r.text for r in inference.translate(df, reverse_model, chunk_size=2, chunk_mode="tokens").collect()}
    assert tokens[3] == "eewt néé eird"
    stopped = {r.id: r.text for r in inference.translate(df, reverse_model, 3, 1, batch_stop_at=1).collect()}
    assert stopped[1] == "cba"


def test_translation_stage(spark, docs, language_model):
    df = docs.withColumn("extra", F.to_json(F.struct(F.col("lang").alias("original_language"))))
    done = stages.machine_translation(df, dutch_model, language_model, allowed_values=["en", "de"], languages=["en"])
    reasons = {r.filter_reason for r in done.removed.select("filter_reason").distinct().collect()}
    assert {"extra_field", "language"} <= reasons
    assert done.kept.count() + done.removed.count() == docs.count()


def test_rewriting_stage_drops_junk_lines(spark, language_model):
    df = spark.createDataFrame([(1, "The and of the thing\nsee 12345\nthe with that and")], "id long, text string")
    done = stages.llm_processing(df, dutch_model, language_model, prompt="{text}", languages=["en"], language_threshold=0.0)
    assert [r.text for r in done.kept.collect()] == ["The and of the thing\nthe with that and"]
    assert [(r.part_idx, r.filter_reason) for r in done.removed.collect()] == [(1, "regex")]


def test_llm_lines_of_rows_with_one_id_stay_apart(spark, language_model):
    df = spark.createDataFrame([(1, "a1 a\na2 a"), (1, "b1 b\nsee x.com\nb2 b"), (2, "see y.com")], "id long, text string")
    done = stages.llm_processing(df, lambda: lambda texts: list(texts), language_model, prompt="{text}", languages=["en", "de", "fr", "es"], language_threshold=0.0)
    assert sorted(r.text for r in done.kept.select("text").collect()) == ["a1 a\na2 a", "b1 b\nb2 b"]
    assert sorted((r.id, r.part_idx) for r in done.removed.collect()) == [(1, 1), (2, 0)]


def test_translation_options(spark, language_model):
    df = spark.createDataFrame([(1, 0, "".join(f"e{i:02d} " for i in range(40)), '{"original_language": "en"}'), (1, 1, "end", '{"original_language": "en"}')],
                               "id long, chunk_idx int, text string, extra string")
    options = {"allowed_values": ["en"], "languages": ["en", "de", "fr", "es"], "language_threshold": 0.0}
    def swapped():
        return lambda texts: [t.replace("e", "3") for t in texts]
    whole = stages.machine_translation(df, swapped, language_model, **options).kept.collect()
    assert len(whole) == 1 and whole[0].text == "".join(f"3{i:02d} " for i in range(40)) + "3nd"
    cut = stages.machine_translation(df, swapped, language_model, chunk_size=4, batch_size=2, batch_stop_at=1, part_col=None, **options)
    assert sorted(r.text for r in cut.kept.collect()) == ["300 301 ", "3nd"]
    dry = stages.machine_translation(df, swapped, language_model, dry_run=True, chunk_size=4, batch_size=2, **options).kept.first()
    assert (dry.n_docs, dry.n_chunks) == (2, 41)


def test_language_scores_need_memory_for_some_texts_only():
    languages, weights = ["a", "b"], np.zeros((language.BUCKETS, 2), np.int64)
    weights[::2, 0] = weights[1::2, 1] = 1000
    model = (languages, np.ones(language.BUCKETS, bool), weights, np.zeros(2, np.int64), None)
    texts = ["", *(f"text {i} " * 30_000 for i in range(40)), "ab"]
    tracemalloc.start()
    out = language.judged(texts, *model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Ten million code points at eight bytes, several times over, would be far more.
    assert peak < 150 << 20
    assert out["language"].isna().tolist() == [True, *[False] * 40, True]
    alone = [language.judged([t], *model).iloc[0].tolist() for t in texts]
    assert [r.tolist() for _, r in out.iterrows()][1:-1] == alone[1:-1]
