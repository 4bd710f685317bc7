"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once: some bits choose one of BINS bins, the rest
compete for the bin's minimum. Empty bins copy the value of a filled bin found
by optimal densification (a fixed hash of the empty bin's number and the
attempt, so equal sets agree). Of every minimum only the low BITS bits are
stored, packed; the likeness of two fingerprints takes out the matches that
such short values show by chance.

Shingles are runs of five words. The first one to four words of a text are
shingles too, so that texts shorter than a shingle can still be compared.

Defined results
    null text: the empty text. A text without words has the fingerprint "".
    Likeness of two wordless texts is 1, of one with any other text 0.
    Equal texts have equal fingerprints; very long texts are read whole, in
    slices that bound the working memory.
    Empty table: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import mix, slices, text_shingles
from textmill.session import materialize

BINS = 128
BITS = 8
_EMPTY = np.uint64(2**64 - 1)


def _densify(minima: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row from its filled ones."""
    n, bins = minima.shape
    row, slot = np.nonzero(minima == _EMPTY)
    filled = minima.copy()
    attempt = 0
    while len(row):
        attempt += 1
        probe = mix(slot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        pick = (probe % np.uint64(bins)).astype(np.int64)
        value = minima[row, pick]
        hit = value != _EMPTY
        filled[row[hit], slot[hit]] = value[hit]
        row, slot = row[~hit], slot[~hit]
    return filled


def sketch(key: np.ndarray, doc: np.ndarray, n_docs: int, bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Packed fingerprints (n_docs rows of bytes) and which rows have any shingle."""
    minima = np.full((n_docs, bins), _EMPTY, np.uint64)
    slot = doc * bins + (key % np.uint64(bins)).astype(np.int64)
    np.minimum.at(minima.reshape(-1), slot, key // np.uint64(bins))
    some = np.zeros(n_docs, bool)
    some[doc] = True
    low = np.zeros((n_docs, bins), np.uint64)
    # The low bits of a minimum are mixed first: the smallest of many is no fair draw of them.
    low[some] = mix(_densify(minima[some])) & np.uint64((1 << bits) - 1)
    plane = (low[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(plane.astype(np.uint8).reshape(n_docs, -1), axis=1), some


def fingerprint_texts(texts: pa.Array, bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    packed = np.zeros((len(texts), (bins * bits + 7) // 8), np.uint8)
    some = np.zeros(len(texts), bool)
    for first, last in slices(texts):
        key, doc = text_shingles(texts.slice(first, last - first), prefixes=True)
        packed[first:last], some[first:last] = sketch(key, doc, last - first, bins, bits)
    return packed, some


def as_hex(packed: np.ndarray, some: np.ndarray) -> list[str]:
    return [row.tobytes().hex() if there else "" for row, there in zip(packed, some)]


def likeness(
    a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bins: int = BINS, bits: int = BITS
) -> np.ndarray:
    """Estimated Jaccard likeness: the share of equal bins, less what chance gives."""
    if bits == 8:
        equal = (a == b).sum(axis=1)
    else:
        planes = [np.unpackbits(x, axis=1)[:, : bins * bits].reshape(-1, bins, bits) for x in (a, b)]
        equal = (planes[0] == planes[1]).all(axis=2).sum(axis=1)
    chance = 2.0**-bits
    corrected = np.clip((equal / bins - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, corrected, (some_a == some_b).astype(float))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Add the fingerprint of every text as lowercase hex. No row moves."""

    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        return pa.array(as_hex(*fingerprint_texts(texts, bins, bits)), pa.string())

    return df.withColumn(out, printed(whole_text(text)))


# Fingerprints beside an edited text -----------------------------------------

_PAIR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ENDS = f"kind string, part int, {_PAIR}, text string, next_text string"


def _edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _pairs(ids: pa.Array, texts: pa.Array, following: pa.Array, prints: tuple | None = None) -> dict[str, pa.Array]:
    """The output columns for rows of (id, text, next text).

    ``prints`` may bring the fingerprints of a chain of rows: each row's next
    is the row behind it.
    """
    plain, after = texts.to_pylist(), following.to_pylist()
    changed = [_edited(a, b) for a, b in zip(plain, after)]
    edited, has_edited = fingerprint_texts(pa.array(changed, pa.string()))
    if prints is None:
        (own, has), (nearest, has_next) = fingerprint_texts(texts), fingerprint_texts(following)
    else:
        (own, has), (nearest, has_next) = (x[:-1] for x in prints), (x[1:] for x in prints)
    return {
        "doc_id": ids.cast(pa.int64()),
        "n_chars": pa.array([len(t) for t in plain], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array(as_hex(own, has), pa.string()),
        "edited_fingerprint": pa.array(as_hex(edited, has_edited), pa.string()),
        "near_edited": pa.array(likeness(own, edited, has, has_edited)),
        "near_next": pa.array(likeness(own, nearest, has, has_next)),
    }


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range, each with the next; the range's two ends go out open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = [f.split()[0] for f in _ENDS.split(", ")]

    def shaped(kind: str, columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        types = {"part": pa.int32(), "doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
        columns = {"kind": pa.array([kind] * n), "part": pa.array([part] * n, pa.int32())} | columns
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(n, types.get(c, pa.string())) for c in names], names
        )

    held_id = held_text = None
    started = False
    for batch in batches:
        for first, last in slices(batch.column("text")):
            ids = batch.column("doc_id").slice(first, last - first)
            texts = batch.column("text").slice(first, last - first).cast(pa.string())
            if not started:
                yield shaped("head", {"doc_id": ids.slice(0, 1), "text": texts.slice(0, 1)}, 1)
            else:
                ids = pa.concat_arrays([held_id, ids])
                texts = pa.concat_arrays([held_text, texts])
            started = True
            held_id, held_text = ids.slice(len(ids) - 1), texts.slice(len(texts) - 1)
            if len(ids) > 1:
                done = _pairs(ids.slice(0, len(ids) - 1), texts.slice(0, len(texts) - 1), texts.slice(1), fingerprint_texts(texts))
                yield shaped("row", done, len(ids) - 1)
    if started:
        yield shaped("open", {"doc_id": held_id, "text": held_text}, 1)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = _pairs(batch.column("doc_id"), batch.column("text").cast(pa.string()), batch.column("next_text").cast(pa.string()))
        yield pa.RecordBatch.from_arrays(list(done.values()), list(done))


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text, its edited text, and their likeness and that of the next text.

    The next document is the one with the next smaller id; after the last
    comes the first. The edited text has its last third of code points
    replaced by as many first ones of the next text. Rows with equal ids
    follow each other by a hash of their texts; a null id comes last. A single
    row is its own next.

    Texts move once, into ranges of ids. A range hands on only its first and
    last row; those, two per range, are paired afterwards by range number.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("_tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    walked = materialize(ranged.drop("_tie").mapInArrow(_walk, _ENDS), "fingerprints")
    names = [f.split()[0] for f in _PAIR.split(", ")]
    # Range numbers only, at most as many as there are shuffle partitions.
    ends = walked.where("kind <> 'row'")
    ring = sorted(r[0] for r in ends.where("kind = 'head'").select("part").collect())
    following = spark.createDataFrame(list(zip(ring, ring[1:] + ring[:1])), "part int, _after int")
    opened = ends.where("kind = 'open'").select("doc_id", "part", "text").join(following, "part")
    heads = ends.where("kind = 'head'").select(F.col("part").alias("_after"), F.col("text").alias("next_text"))
    closed = opened.join(heads, "_after").select("doc_id", "text", "next_text").mapInArrow(_close, _PAIR)
    return walked.where("kind = 'row'").select(*names).unionByName(closed)
