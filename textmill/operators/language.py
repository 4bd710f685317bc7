"""Language detection: multinomial naive Bayes over character trigrams.

Trigrams are counted in a fixed number of hash buckets, so the model has one size
whatever the corpus. Scoring looks buckets up a whole Arrow batch at a time, so
documents are never shuffled to get a label. Weights are whole micro-nats: sums
do not depend on their order.

Summed log-odds say next to nothing about certainty: they grow with the text, so
their softmax is 1 for almost every document. calibrate therefore learns from
labelled examples, of one word to whole documents and of mixed languages, how
often the best language is right for a given length and lead per trigram. The
share, made monotone in the lead, is the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textmill.functions.text import words
from textmill.operators.gazetteer import slices

# A prime, so that all three characters of a trigram decide its bucket.
BUCKETS = 262_139
MICRO = 1_000_000
# Cells of the calibration: powers of two of trigrams (the last one is open), and 32nds of a nat of lead per trigram.
LENGTHS, LEADS, STEPS = 10, 64, 32
# Code points whose trigrams a task holds at a time.
POINTS = 1 << 20
# Examples cut from each document, and mixed from it and another one; words in them.
EXCERPTS, MIXES, EXCERPT_WORDS, MIX_WORDS = 4, 2, 50, 40


def trigram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every overlapping trigram of every text, and the index of its text.

    The bucket is the three code points side by side (21 bits each), modulo BUCKETS.
    """
    points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points], np.int64)
    flat = np.concatenate(points).astype(np.int64) if points else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(points)), sizes)
    if len(flat) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = doc[:-2] == doc[2:]
    codes = (flat[:-2] << 42) | (flat[1:-1] << 21) | flat[2:]
    return codes[inside] % BUCKETS, doc[:-2][inside]


@dataclass(frozen=True)
class LanguageModel:
    """Which buckets were seen, their weight per language, the prior per language.

    ``table`` holds the calibrated score per length and lead; without it the score is the softmax.
    """

    seen: np.ndarray
    weights: np.ndarray
    priors: np.ndarray
    languages: list[str]
    table: np.ndarray | None = None

    def detect(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add language and language_score; null and 0.0 for texts without trigrams."""
        return self.evidence(df, text).withColumns(
            {"language": F.col("_best.language"), "language_score": F.col("_best.score")}
        ).drop("_best")

    def evidence(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add _best (language, score, length, lead); the latter two name a cell of the calibration."""
        model = df.sparkSession.sparkContext.broadcast((self.seen, self.weights, self.priors, self.table))
        languages = self.languages

        @F.pandas_udf("language string, score double, length int, lead int")
        def best(texts: pd.Series) -> pd.DataFrame:
            return judged(texts.tolist(), languages, *model.value)

        return df.withColumn("_best", best.asNondeterministic()(F.lower(F.coalesce(text, F.lit("")))))


def judged(
    texts: list[str], languages: list[str], seen: np.ndarray, weights: np.ndarray, priors: np.ndarray, table: np.ndarray | None
) -> pd.DataFrame:
    """(language, score, length, lead) of every text, some texts at a time."""

    def judge(texts: list[str]) -> pd.DataFrame:
        flat, doc = trigram_buckets(texts)
        n_docs = len(texts)
        sizes = np.bincount(doc, minlength=n_docs)
        found = sizes > 0
        known = seen[flat]
        at, doc = flat[known], doc[known]
        edges = np.searchsorted(doc, np.arange(n_docs + 1))
        totals = np.tile(priors, (n_docs, 1))
        for k in range(len(languages)):
            running = np.concatenate(([0], np.cumsum(weights[at, k])))
            totals[:, k] += running[edges[1:]] - running[edges[:-1]]
        top = totals.argmax(axis=1)
        length, lead = cells(totals, sizes)
        if table is None:
            gaps = (totals - totals.max(axis=1, keepdims=True)) / MICRO
            score = 1.0 / np.exp(gaps).sum(axis=1)
        else:
            score = table[length, lead]
        return pd.DataFrame(
            {
                "language": np.where(found, np.array(languages, object)[top], None),
                "score": np.where(found, score, 0.0),
                "length": length.astype(np.int32),
                "lead": lead.astype(np.int32),
            }
        )

    parts = [judge(texts[first:last]) for first, last in slices(texts, POINTS)]
    return pd.concat(parts, ignore_index=True) if parts else judge(texts)


def cells(totals: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length and lead class of texts with the given sums per language and numbers of trigrams."""
    some = np.maximum(sizes, 1)
    length = np.minimum(np.frexp(some.astype(np.float64))[1] - 1, LENGTHS - 1)
    if totals.shape[1] == 1:
        return length, np.full(len(totals), LEADS - 1)
    ordered = np.sort(totals, axis=1)
    return length, np.minimum((ordered[:, -1] - ordered[:, -2]) * STEPS // (some * MICRO), LEADS - 1)


def calibration_examples(df: DataFrame, id_col: str = "id", step: int = 1, text: str = "text", language: str = "lang") -> DataFrame:
    """(kind, label, text): whole documents, excerpts of 1 to 50 words, and mixes of two languages.

    A mix starts with words of one document and goes on with words of the one
    whose id is larger by ``step``, if that has another language; its label is
    the language with more words. Ids are whole numbers; what is cut depends on them alone.
    """
    i = F.col("id")
    rows = df.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(language).alias("label"), F.col(text).alias("text"), words(F.col(text)).alias("w")
    )

    def numbered(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j")

    size = 1 + F.pmod(i * 31 + F.col("j") * 17, F.lit(EXCERPT_WORDS))
    cut = rows.select("id", "label", "w", numbered(EXCERPTS)).withColumn("n", size)
    start = F.pmod(i * 13 + F.col("j") * 101, F.greatest(F.lit(1), F.size("w") - F.col("n") + 1))
    excerpts = cut.select("label", F.array_join(F.slice("w", (start + 1).cast("int"), F.col("n").cast("int")), " ").alias("text"))

    head = F.slice("w", 1, MIX_WORDS)
    first = rows.select("id", "label", head.alias("w"))
    second = first.select((i - step).alias("id"), F.col("label").alias("label2"), F.col("w").alias("w2"))
    pairs = first.join(second, "id").where("label <> label2").select("*", numbered(MIXES))
    own = F.least(F.size("w"), 1 + F.pmod(i * 7 + F.col("j") * 29, F.lit(MIX_WORDS))).cast("int")
    other = F.least(F.size("w2"), 1 + F.pmod(i * 11 + F.col("j") * 23, F.lit(MIX_WORDS))).cast("int")
    mixed = F.array_join(F.concat(F.slice("w", F.lit(1), own), F.slice("w2", F.lit(1), other)), " ")
    mixes = pairs.select(F.when(own >= other, F.col("label")).otherwise(F.col("label2")).alias("label"), mixed.alias("text"))
    kinds = {"whole": rows.select("label", "text"), "excerpt": excerpts, "mix": mixes}
    named = [part.select(F.lit(kind).alias("kind"), "label", "text") for kind, part in kinds.items()]
    return reduce(DataFrame.unionByName, named)


def monotone(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Least-squares shares that never fall: the largest over starts of the smallest mean over ends."""
    r, m = np.append(0, np.cumsum(right)), np.append(0, np.cumsum(n))
    out = np.empty(len(n))
    for i in range(len(n)):
        means = (r[i + 1 :][None, :] - r[: i + 1][:, None]) / (m[i + 1 :][None, :] - m[: i + 1][:, None])
        out[i] = means.min(axis=1).max()
    return out


def calibrate(model: LanguageModel, examples: DataFrame) -> LanguageModel:
    """The model with scores that are shares of right answers among ``examples`` (label, text).

    They must not be among the documents the model was counted on. Only one
    number of right answers per cell comes to the driver. Each cell starts with one
    example that is half right, so an empty cell takes the share of its neighbours.
    """
    judged = model.evidence(examples).where(F.col("_best.language").isNotNull())
    counted = (
        judged.groupBy("_best.length", "_best.lead")
        .agg(F.count_if(F.col("_best.language") == F.col("label")).alias("right"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    right, n = np.full((LENGTHS, LEADS), 0.5), np.ones((LENGTHS, LEADS))
    for r in counted:
        right[r["length"], r["lead"]] += r["right"]
        n[r["length"], r["lead"]] += r["n"]
    return replace(model, table=np.array([monotone(a, b) for a, b in zip(right, n)]))


def fit_language_model(labelled: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Train on documents with a known language.

    What comes to the driver and goes to tasks is one number per bucket and
    language, however large the corpus.
    """
    rows = labelled.where(F.col(language).isNotNull()).select(F.col(language).alias("language"), F.lower(text).alias("text"))
    n_docs = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}
    if not n_docs:
        raise ValueError("no document has a language")
    languages = sorted(n_docs)

    def count_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Counts per batch, so a bucket leaves a batch once per language."""
        for batch in batches:
            for name, part in batch.groupby("language"):
                texts, n = part["text"].fillna("").tolist(), np.zeros(BUCKETS, np.int64)
                for first, last in slices(texts, POINTS):
                    n += np.bincount(trigram_buckets(texts[first:last])[0], minlength=BUCKETS)
                buckets = np.flatnonzero(n)
                yield pd.DataFrame({"language": name, "bucket": buckets, "n": n[buckets]})

    partial = rows.mapInPandas(count_batch, "language string, bucket bigint, n bigint")
    counted = partial.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, len(languages)))
    counts[counted["bucket"], counted["language"].map(languages.index)] = counted["n"]
    seen = counts.sum(axis=1) > 0
    sizes = counts.sum(axis=0) + seen.sum()
    weights = np.rint((np.log(counts + 1) - np.log(sizes)) * MICRO).astype(np.int64)
    total = sum(n_docs.values()) + len(languages)
    priors = [round((math.log(n_docs[x] + 1) - math.log(total)) * MICRO) for x in languages]
    return LanguageModel(seen, weights, np.array(priors, np.int64), languages)
