import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions.text import with_parts
from textmill.operators import filters as flt, repetition
from textmill.operators.repetition import with_ngram_fractions
from textmill.plans.stages import annotate_heuristics, heuristic_filtering


@pytest.fixture(scope="module")
def docs(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id")
    return df.withColumns({"language": F.col("lang"), "language_score": F.lit(0.9)})


def brute_top(words, n, size):
    grams = Counter(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    if not grams or not size:
        return 0.0
    most = max(grams.values())
    return max(len(g) for g, c in grams.items() if c == most) * most / size


def brute_dup(words, n, size):
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    seen, covered = set(), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            covered.update(range(starts[i], starts[i + n - 1] + len(words[i + n - 1])))
        seen.add(gram)
    return len(covered) / size if size else 0.0


def test_ngrams_against_brute_force(spark, docs):
    extra = spark.createDataFrame(
        [(-1, "a b " * 40), (-2, ""), (-3, "x"), (-4, "x " * 3000), (-5, "a b c d e a b c d e f a b c d e")], "id long, text string"
    )
    df, p = with_parts(docs.select("id", "text").union(extra))
    out = with_ngram_fractions(df, p, [2, 3], [5, 10]).select("id", "text", "top_2_gram", "top_3_gram", "dup_5_gram", "dup_10_gram")
    for r in out.collect():
        words = [w for w in re.split(r"[ \t\r\n]+", r.text) if w]
        size = len(r.text)
        assert r.top_2_gram == pytest.approx(brute_top(words, 2, size)), r.id
        assert r.top_3_gram == pytest.approx(brute_top(words, 3, size)), r.id
        assert r.dup_5_gram == pytest.approx(brute_dup(words, 5, size)), r.id
        assert r.dup_10_gram == pytest.approx(brute_dup(words, 10, size)), r.id


def test_kept_and_removed_are_the_input(docs):
    done = heuristic_filtering(docs, languages=["en", "de"])
    kept, removed = ({r.id for r in x.select("id").collect()} for x in (done.kept, done.removed))
    assert not kept & removed
    assert kept | removed == {r.id for r in docs.select("id").collect()}
    assert kept and removed


def test_thresholds_of_none_keep_everything(docs):
    off = dict(max_digit_fraction=None, min_n_char=None, min_mean_med_char=None, min_mean_med_word=None)
    quality = dict(max_symbol_word_ratio=None, max_bullet_lines_ratio=None, max_ellipsis_lines_ratio=None,
                   max_non_alpha_words_ratio=None, min_stop_words=None)
    repetition = dict(dup_line_frac=None, dup_para_frac=None, dup_line_char_frac=None, dup_para_char_frac=None,
                      top_n_grams=None, dup_n_grams=None)
    out = annotate_heuristics(docs, label_only=True, nordic=off, quality=quality, repetition=repetition)
    assert out.where("filter_reason is not null").isEmpty()


def test_verdict_does_not_depend_on_partitions(docs):
    one, many = (annotate_heuristics(docs.repartition(n)).select("id", "filter_reason") for n in (1, 8))
    assert one.exceptAll(many).isEmpty()


def test_first_failing_rule_is_recorded(spark):
    df = spark.createDataFrame([(1, "123456789", "xx", 0.1)], "id long, text string, language string, language_score double")
    row = annotate_heuristics(df).first()
    assert (row.filter_module, row.filter_reason) == ("LanguageFilter", "language")
    row = annotate_heuristics(df, label_only=True).first()
    assert (row.filter_module, row.filter_reason) == ("NordicPileQualityFilter", "max_digit_fraction")


def test_stop_words_need_a_list(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "el gato", "xx"), (3, "fan it lan", "fy")], "id long, text string, language string")
    df, p = with_parts(df)
    counts = {r.id: r.n for r in df.select("id", flt.stop_word_count(p, F.col("language")).alias("n")).collect()}
    assert counts == {1: 3, 2: None, 3: 2}


EXTRA = [
    (1, None), (2, ""), (3, "{}"), (4, '{"original_language":"en"}'), (5, '{"original_language":"de"}'),
    (6, '{"original_language":null}'), (7, '{"original_language":1}'), (8, '{"other":"en"}'),
]


def test_extra_field(spark):
    df = spark.createDataFrame(EXTRA, "id long, extra string")

    def kept(**options):
        out = flt.extra_field_filter(df, "original_language", ["en", "1"], raise_missing=False, **options)
        return [r.id for r in out.where("filter_reason is null").orderBy("id").collect()]

    assert kept() == [4]
    assert kept(keep_missing=True) == [1, 2, 3, 4, 8]


@pytest.mark.parametrize("extra", ["[1]", "{broken", "{}"])
def test_extra_field_raises(spark, extra):
    df = spark.createDataFrame([(1, extra)], "id long, extra string")
    with pytest.raises(Exception):
        flt.extra_field_filter(df, "original_language", ["en"]).collect()


def test_regex_filter_is_unicode_aware(spark):
    df = spark.createDataFrame([(1, "twee woorden"), (2, "zie 1234"), (3, "bestand.één"), (4, "/pad/één")], "id long, text string")
    out = flt.regex_filter(df).where("filter_reason is null")
    assert [r.id for r in out.collect()] == [1]


def test_repetition_sorts_some_documents_at_a_time():
    n = repetition.WORDS_AT_ONCE
    lists = [np.zeros(k, np.int64) for k in (n // 2, n // 2, 1, 3 * n, 0, 5)]
    assert list(repetition.slices(lists)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    rng = np.random.default_rng(3)
    hashes = [rng.integers(0, 40, k) for k in (0, 3, 200, 1, 900)]
    lens = [rng.integers(1, 9, len(h)) for h in hashes]
    together = repetition.measured(hashes, lens, [2, 3], [5, 6])
    alone = [repetition.measured([h], [x], [2, 3], [5, 6])[0].tolist() for h, x in zip(hashes, lens)]
    assert together.tolist() == alone


def test_ngrams_that_occur_once_are_not_sorted_further():
    rng = np.random.default_rng(6)
    hashes, doc = rng.integers(-(2**63), 2**63, 4000).view(np.uint64), np.repeat(np.arange(4), 1000)
    # The second document has the first one's words, the third a passage twice.
    hashes[1000:2000], hashes[2500:2520] = hashes[:1000], hashes[2100:2120]
    again = repetition._repeated(hashes, doc, [10, 2, 5])
    for n in (2, 5, 10):
        assert again[n][1].tolist() == [*range(2100, 2121 - n), *range(2500, 2521 - n)]


def test_measured_against_plain_counts():
    rng = np.random.default_rng(7)
    word = rng.integers(-(2**63), 2**63, 30)
    docs = [rng.integers(0, v, n) for v in (2, 6, 30) for n in (0, 1, 2, 4, 11, 80)] + [np.tile(np.arange(9), 5)]
    got = repetition.measured([word[d] for d in docs], [d + 1 for d in docs], [3, 2], [6, 2, 3])
    for d, row in zip(docs, got):
        want, size = [], d + 1
        ends = np.cumsum(size + 1) - 1
        for n in (3, 2):
            grams = [tuple(d[i : i + n]) for i in range(len(d) - n + 1)]
            most = max(map(grams.count, grams), default=0)
            want.append(max((most * (sum(x + 1 for x in g) + n - 1) for g in grams if grams.count(g) == most), default=0))
        for n in (6, 2, 3):
            grams, chars = [tuple(d[i : i + n]) for i in range(len(d) - n + 1)], set()
            for i, g in enumerate(grams):
                if g in grams[:i]:
                    chars |= set(range(ends[i] - size[i], ends[i + n - 1]))
            want.append(len(chars))
        assert row.tolist() == want
