"""Stupid-backoff scores of documents, as joins with n-gram count tables.

    score(v | u) = c(u v) / c(u)           if the bigram u v was counted,
                   ALPHA * c(v) / N        otherwise; the first word has c(v) / N.

A document's score is the sum of the logarithms. For counted bigrams it is a
sum over its distinct n-grams of coefficient * log c(n-gram): + for a bigram,
- for each use of a word as context, + for the first word. So documents are
exploded into (document, n-gram, uses, coefficient), with one row per distinct
n-gram of a document, joined to the count table on the n-gram's hash and summed
per document.

N-grams that hold at least one HOT-th of all uses in a hash sample of documents
(so at most HOT of them) are counted and joined by broadcast: they never
travel, and no partition gathers the rows of a frequent one. All others are
dealt by hash once; counts and join use that same exchange. The sample decides
only the route: all counts are exact and cover all documents.

Defined results
    null, empty and wordless texts: no words, score 0, no score per word.
    Words are runs of characters other than ASCII white space.
    An n-gram is a 64-bit hash. Repeated rows count as often as they occur and
    get equal scores. Words never counted are taken as counted once.
    Very long texts are scored whole. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import buffers, grouped, mix, slices, word_hashes, words
from textmill.session import materialize

ALPHA = 0.4
HOT = 2_000_000
SAMPLE = 16

_LEFT, _RIGHT = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)
_ONE = np.uint64(0x9E3779B97F4A7C15)


def word_grams(texts: pa.Array):
    """Per word: its hash as a unigram, the bigram it begins, whether there is one, and its text number."""
    data, offsets = buffers(texts)
    start, end, doc = words(data, offsets)
    hashes = word_hashes(data, start, end)
    unigram = mix(hashes ^ _ONE)
    more = np.zeros(len(doc), bool)
    more[:-1] = doc[1:] == doc[:-1]
    bigram = np.zeros(len(doc), np.uint64)
    bigram[:-1] = mix(hashes[:-1] * _LEFT + hashes[1:] * _RIGHT)
    return unigram, bigram, more, doc


def document_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text: hash, text number, uses, coefficient of log c in the score."""
    unigram, bigram, more, doc = word_grams(texts)
    if not len(doc):
        return unigram, doc, doc, doc
    key, owner = np.concatenate([unigram, bigram[more]]), np.concatenate([doc, doc[more]])
    # A bigram counts for itself; a word for a text's beginning, and against wherever it is a context.
    first = np.append(True, doc[1:] != doc[:-1]).astype(np.int64)
    value = np.concatenate([first - more, np.ones(int(more.sum()), np.int64)])
    order, head = grouped(key, owner)
    at = order[head]
    return key[at], owner[at], np.diff(np.append(head, len(key))), np.add.reduceat(value[order], head)


def uses_of() -> Column:
    """The uses in ``both``; a coefficient is below 2^31 in size, so rounding gives them back."""
    return F.shiftright(F.col("both") + F.lit(1 << 31), 32)


def coefficient_of() -> Column:
    return F.col("both") - F.shiftleft(uses_of(), 32)


def document_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, doc, n_words): doc is a hash of id and text that names the document in the joins."""

    @F.arrow_udf("long")
    def counted(column: pa.Array) -> pa.Array:
        counts = []
        for a, b in slices(column):
            _, _, doc = words(*buffers(column.slice(a, b - a)))
            counts.append(np.bincount(doc, minlength=b - a))
        return pa.array(np.concatenate(counts) if counts else np.empty(0, np.int64), pa.int64())

    whole = df.select(F.col(id_col).alias("id"), whole_text(text).alias("_text"))
    return whole.select("id", F.xxhash64("id", "_text").alias("doc"), counted("_text").alias("n_words"))


def gram_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text", share: int = 1) -> DataFrame:
    """(doc, gram, both), one row per distinct n-gram of each document.

    ``both`` holds uses and coefficient side by side (see uses_of and coefficient_of),
    so that counts and scores read the very same columns of one exchange.
    ``share`` above 1 takes only the documents whose hash it divides.
    """

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for a, b in slices(batch.column(1), 1 << 20):
                key, owner, uses, coefficient = document_grams(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[a:b][owner], pa.int64()),
                        pa.array(key.view(np.int64)),
                        pa.array((uses << 32) + coefficient),
                    ],
                    ["doc", "gram", "both"],
                )

    named = df.select(F.xxhash64(F.col(id_col), whole_text(text)).alias("doc"), whole_text(text).alias("_text"))
    if share > 1:
        named = named.where(F.pmod("doc", F.lit(share)) == 0)
    return named.mapInArrow(exploded, "doc long, gram long, both long")


def count_table(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(gram, c): how often every unigram and bigram is used in all documents."""
    return gram_rows(df, id_col, text).groupBy("gram").agg(F.sum(uses_of()).alias("c"))


def hot_counts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact counts of the n-grams that a sample shows to be frequent; at most HOT rows."""
    sampled = materialize(
        gram_rows(df, id_col, text, SAMPLE).groupBy("gram").agg(F.sum(uses_of()).alias("c")).where("c > 1"), "sampled"
    )
    uses = sampled.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    # No more than HOT n-grams can each hold a HOT-th of the uses.
    hot = materialize(sampled.where(F.col("c") * HOT >= uses).select("gram"), "hot")
    counts = gram_rows(df, id_col, text).join(F.broadcast(hot), "gram").groupBy("gram").agg(F.sum(uses_of()).alias("c"))
    return materialize(counts, "hot_counts")


def score_corpus(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, score, per_word) of every document, counted over these same documents.

    Every n-gram is then counted, so no word backs off.
    """
    spark = df.sparkSession
    documents = materialize(document_rows(df, id_col, text), "documents")
    total = documents.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    hot = hot_counts(df, id_col, text)
    rows = gram_rows(df, id_col, text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = rows.join(F.broadcast(hot.select("gram")), "gram", "left_anti").repartition(parts, "gram")
    # Both sides use all columns of the exchange (df is the number of documents), so both read the same one.
    table = cold.groupBy("gram").agg(F.sum(uses_of()).alias("c"), F.count("doc").alias("df"))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("doc").agg(F.sum(coefficient_of() * F.log("c")).alias("part"))

    frequent = summed(rows.join(F.broadcast(hot), "gram"))
    # Not broadcast: a small table would be, and the rows counted twice.
    rare = summed(cold.join(table.where("df > 0").hint("merge"), "gram"))
    parts_of = materialize(rare, "rare").unionByName(materialize(frequent, "frequent"))
    sums = parts_of.groupBy("doc").agg(F.sum("part").alias("sum"))
    return _finished(documents, sums, total)


def _finished(documents: DataFrame, sums: DataFrame, total: int) -> DataFrame:
    """Scores of the rows of ``documents``; equal rows share one sum."""
    copies = documents.groupBy("doc").agg(F.count("*").alias("copies"))
    per_doc = sums.join(copies, "doc").select("doc", (F.col("sum") / F.col("copies")).alias("one"))
    some = F.col("n_words") > 0
    score = F.when(some, F.col("one") - F.log(F.lit(float(max(total, 1))))).otherwise(0.0)
    joined = documents.join(per_doc, "doc", "left").withColumn("score", score)
    return joined.select("id", "n_words", "score", F.when(some, F.col("score") / F.col("n_words")).alias("per_word"))


def score_new(
    df: DataFrame, counts: DataFrame, total: int, id_col: str = "doc_id", text: str = "text", alpha: float = ALPHA
) -> DataFrame:
    """(id, n_words, score, per_word) of documents under a count table made from others.

    Bigrams that were not counted back off: their rows, which carry both words,
    are joined to the word counts instead. ``total`` is the table's number of words.
    """

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for a, b in slices(batch.column(1), 1 << 20):
                unigram, bigram, more, doc = word_grams(batch.column(1).slice(a, b - a))
                at = np.flatnonzero(more)
                first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else at
                # A first word is a row without bigram and context.
                null = np.append(np.ones(len(first), bool), np.zeros(len(at), bool))
                columns = [
                    pa.array(docs[a:b][np.append(doc[first], doc[at])], pa.int64()),
                    pa.array(np.append(bigram[first], bigram[at]).view(np.int64), mask=null),
                    pa.array(np.append(unigram[first], unigram[at]).view(np.int64), mask=null),
                    pa.array(np.append(unigram[first], unigram[at + 1]).view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "bigram", "u", "v"])

    documents = materialize(document_rows(df, id_col, text), "documents")
    named = df.select(F.xxhash64(F.col(id_col), whole_text(text)).alias("doc"), whole_text(text).alias("_text"))
    rows = named.mapInArrow(bigrams, "doc long, bigram long, u long, v long")
    rows = rows.groupBy("doc", "bigram", "u", "v").agg(F.count("*").alias("uses"))

    def looked_up(df: DataFrame, key: str, out: str) -> DataFrame:
        return df.join(counts.select(F.col("gram").alias(key), F.col("c").alias(out)), key, "left")

    found = looked_up(looked_up(looked_up(rows, "bigram", "c_uv"), "u", "c_u"), "v", "c_v")
    backed_off = F.log(F.coalesce("c_v", F.lit(1)))
    value = (
        F.when(F.col("bigram").isNull(), backed_off)
        .when(F.col("c_uv").isNotNull(), F.log("c_uv") - F.log("c_u"))
        .otherwise(F.log(F.lit(alpha)) + backed_off - F.log(F.lit(float(max(total, 1)))))
    )
    sums = found.groupBy("doc").agg(F.sum(value * F.col("uses")).alias("sum"))
    return _finished(documents, sums, total)
