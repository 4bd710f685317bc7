"""Toxic passages: a linear model over hashed words, applied to pieces of a text.

Texts are cut into pieces in the JVM; the words of all pieces of an Arrow batch
are then hashed and weighed together with numpy. Every document is scored where
it lies, with one fixed-size table of weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import let, prefix_sums
from textmill.session import materialize

BUCKETS = 4096
SPAN_TYPE = "array<struct<label:string,score:double,sentence:string,start_index:bigint>>"
# Bytes hashed at a time, which bounds the numpy arrays of a batch.
SLICE_BYTES = 4 << 20

# Words are runs of ASCII letters and of characters beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_VALUE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[~_LETTER] = 0
_STEP = np.uint64(0x5851F42D4C957F2D)


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every word in a slice of a string buffer."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    solid = _LETTER[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    begins[borders] |= solid[borders]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.arange(start[0], len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _STEP, np.uint64))
    code = np.add.reduceat(_VALUE[data[start[0] :]] * powers[place], start - start[0])
    code ^= code >> np.uint64(32)
    code = (code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    return (code % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(offsets, start, "right") - 1


def word_buckets(texts: pa.Array):
    """(first text, buckets, text numbers) for slices of a string array; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, starts, raw = texts.buffers()
    offsets = np.frombuffer(starts, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(len(texts), max(last, first + 1))
        part = data[offsets[first] : offsets[last]]
        bucket, owner = _hashed(part, offsets[first : last + 1] - offsets[first])
        yield first, bucket, owner + first
        first = last


def bucket_sets(text: Column) -> Column:
    """The distinct buckets of a text's words, as strings."""

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        lists: list[list[str]] = [[] for _ in range(len(texts))]
        for _, bucket, owner in word_buckets(texts):
            pair = np.unique(owner * BUCKETS + bucket)
            for o, b in zip((pair // BUCKETS).tolist(), (pair % BUCKETS).tolist()):
                lists[o].append(str(b))
        return pa.array(lists, pa.list_(pa.string()))

    return found(text)


def pieces(text: Column, max_chars: int) -> Column:
    """Sentences with their end marks and trailing blanks, none longer than ``max_chars``.

    Together the pieces are the whole text.
    """
    pattern = "(?s)(?:[^.!?\\n]{1,%d}[.!?\\n]*[ ]*|[.!?\\n]+[ ]*)" % max_chars
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    cut = "(?s).{1,%d}" % max_chars
    return F.flatten(F.transform(found, lambda s: F.regexp_extract_all(s, F.lit(cut), F.lit(0))))


@dataclass(frozen=True)
class ToxicityModel:
    weights: list[float]
    intercept: float

    def scores(self, lists: Column) -> Column:
        """The score of every string of an array column."""
        weights, intercept = np.array(self.weights), self.intercept

        @F.arrow_udf("array<double>")
        def scored(column: pa.Array) -> pa.Array:
            flat = column.flatten()
            logit = np.full(len(flat), intercept)
            for _, bucket, owner in word_buckets(flat):
                logit += np.bincount(owner, weights[bucket], len(flat))
            sizes = column.value_lengths().fill_null(0).to_numpy()
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            return pa.ListArray.from_arrays(offsets, pa.array(1.0 / (1.0 + np.exp(-logit))))

        # Marked so that the plan never copies the call.
        return scored.asNondeterministic()(lists)


def fit_toxicity_model(labelled: DataFrame, text: str = "text", label: str = "toxic", reg: float = 0.001, max_iter: int = 30) -> ToxicityModel:
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(BUCKETS)], inputCol="_b", outputCol="_tf"
    )
    # Word presence, not counts: long texts must not dominate.
    rows = labelled.select(bucket_sets(F.col(text)).alias("_b"), F.col(label).cast("double").alias("label"))
    # Written once: every pass of the solver would otherwise split the texts again.
    tf = counter.transform(materialize(rows, "words"))
    idf = IDF(inputCol="_tf", outputCol="features", minDocFreq=2).fit(tf)
    model = LogisticRegression(regParam=reg, elasticNetParam=1.0, maxIter=max_iter).fit(idf.transform(tf))
    weights = [float(w * i) for w, i in zip(model.coefficients.toArray(), idf.idf.toArray())]
    return ToxicityModel(weights, float(model.intercept))


def toxic_spans(
    df: DataFrame,
    model: ToxicityModel,
    threshold: float = 0.995,
    max_chunk_length: int = 256,
    text: str = "text",
) -> DataFrame:
    """Add ToxicLanguage: the pieces scored at or above the threshold, in text order."""

    def spans(parts: Column, scores: Column) -> Column:
        placed = let(
            prefix_sums(F.transform(parts, lambda s: F.length(s))),
            lambda starts: F.transform(
                scores, lambda p, i: F.struct(F.get(parts, i).alias("s"), F.get(starts, i).alias("at"), p.alias("p"))
            ),
        )
        return F.transform(
            F.filter(placed, lambda x: x["p"] >= threshold),
            lambda x: F.struct(
                F.lit("toxic").alias("label"),
                x["p"].alias("score"),
                x["s"].alias("sentence"),
                x["at"].cast("long").alias("start_index"),
            ),
        )

    cut = df.withColumn("_pieces", pieces(F.col(text), max_chunk_length))
    scored = cut.withColumn("_scores", model.scores(F.col("_pieces")))
    # Most texts have no span; only those that have one are placed.
    hit = F.exists("_scores", lambda p: p >= threshold)
    found = F.when(hit, spans(F.col("_pieces"), F.col("_scores")).cast(SPAN_TYPE))
    some = F.when(F.col(text).isNotNull(), F.array().cast(SPAN_TYPE))
    return scored.withColumn("ToxicLanguage", F.coalesce(found, some)).drop("_pieces", "_scores")


def toxic_doc_flag(df: DataFrame) -> DataFrame:
    """Document level: any span at all, and the highest score."""
    spans = F.col("ToxicLanguage")
    return df.withColumns(
        {
            "is_toxic": F.size(spans) > 0,
            "max_toxicity": F.array_max(F.transform(spans, lambda s: s["score"])),
        }
    )
