"""Cost-balanced packing of tokenised documents into fixed-length sequences.

The cost of a piece of n tokens is LINEAR * n + n * n: the layers' work per
token plus its attention to the piece itself. A task tokenises the documents of
its partition, cuts whole sequences from long ones, and takes groups of a
bounded number of tokens. In each group the documents, longest first, go to the
cheapest sequence with room for them; the ones that fit nowhere are cut over
the room that is left. There are as many sequences as the group's tokens fill,
so each is full, and what remains (less than one sequence) joins the next group.
The remainders of all partitions meet in a second, small packing.

Defined results
    null or empty text: its end token alone. Repeated rows are packed each.
    A null id stays null. An empty table gives no pieces.
    Sequences are full but for the last of each second-level group.
    Very long texts are cut over several sequences. Equally long documents are placed in
    the order they come. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import buffers, give_back, slices, words
from textmill.session import materialize

LENGTH = 2048
END_ID = 1
LINEAR = 4096.0
GROUP_TOKENS = 1 << 21
CACHED_WORDS = 400_000
# Text encoded at a time; a task's arrays are some forty times as large.
ENCODED_BYTES = 2 << 20
SECOND_LEVEL = 1 << 60

# Byte classes: 0 white space, 1 letter, 2 digit, 3 other printable ASCII, 4 all
# that the short way does not know (non-ASCII, control characters, apostrophe).
_CLASS = np.full(256, 4, np.uint8)
_CLASS[33:127] = 3
_CLASS[ord("'")] = 4
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SHORT_WAY = re.compile("[!-&(-~]+")


class WordTokenizer:
    """Ids of texts under a tokenizer that drops white space and splits letters, digits and signs.

    A batch's distinct words are encoded once and remembered, up to a bound.
    Lower-cased ASCII words go straight to the merges; any other word is given
    to the whole tokenizer between two spaces, where it is cut the same way.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True
        # One tokenizer serves both ways: its own rules, or blanks alone.
        self.rules = self.tool.normalizer, self.tool.pre_tokenizer
        self.blanks = None, pre_tokenizers.WhitespaceSplit()
        # The ids of a word as bytes, which are joined without making numbers of them.
        self.cached, self.memo = cached, {}

    def _learn(self, unknown: list[str]) -> None:
        plain, odd, short = [], [], _SHORT_WAY.fullmatch
        for w in unknown:
            (plain if short(w) else odd).append(w)
        self.tool.normalizer, self.tool.pre_tokenizer = self.blanks
        for i in range(0, len(plain), 4096):
            part = plain[i : i + 4096]
            coded = self.tool.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(coded.ids, "<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(coded.word_ids, minlength=len(part)))).tolist()
            self.memo.update(zip(part, [ids[a:b] for a, b in zip([0, *ends], ends)]))
        if odd:
            self.tool.normalizer, self.tool.pre_tokenizer = self.rules
            for word, coded in zip(odd, self.tool.encode_batch_fast(odd, add_special_tokens=False)):
                self.memo[word] = array("I", coded.ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order and the number of ids of each text."""
        data, offsets = buffers(texts)
        start, _, doc = words(data, offsets)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        first = start[0]
        data = data[first:]
        kind = _CLASS[data]
        odd = np.repeat(np.maximum.reduceat(kind == 4, start - first), np.diff(np.append(start - first, len(data))))
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut &= ~odd
        cut[start - first] = True
        solid = kind > 0
        cut &= solid
        at = np.flatnonzero(cut)
        packed = np.where(odd, data, _LOWER[data])[solid]
        begin = (np.cumsum(solid) - 1)[at]
        bounds = np.append(begin, len(packed)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(packed)).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self.memo) > self.cached:
            self.memo.clear()
        memo = self.memo
        unknown = [w for w in distinct if w not in memo]
        if unknown:
            self._learn(unknown)
        lists = [memo[w] for w in distinct]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.uint32)
        code = pieces.indices.to_numpy()
        count = sizes[code]
        ends = np.cumsum(count)
        where = np.arange(int(ends[-1])) + np.repeat((np.cumsum(sizes) - sizes)[code] - (ends - count), count)
        owner = np.searchsorted(offsets, at + first, "right") - 1
        return flat[where], np.bincount(owner, count, len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded_documents(texts: pa.Array, path: str, end_id: int = END_ID) -> Iterator[np.ndarray]:
    """The ids of each text with the end id, as unsigned 32-bit numbers."""
    tokenizer = word_tokenizer(path)
    for first, last in slices(texts, ENCODED_BYTES):
        ids, count = tokenizer.encode(texts.slice(first, last - first))
        ends = np.cumsum(count)
        out = np.full(len(ids) + len(count), end_id, np.uint32)
        body = np.ones(len(out), bool)
        body[ends + np.arange(len(count))] = False
        out[body] = ids
        at = 0
        for n in count.tolist():
            yield out[at : at + n + 1]
            at += n + 1


# Packing ---------------------------------------------------------------------

# An item is (id, start, ids, tokens of its document): a document or a part of one.
Item = tuple


def pack(items: list[Item], length: int = LENGTH, linear: float = LINEAR, final: bool = False):
    """Place items into sequences of ``length`` tokens.

    Returns (placed, left): placed rows are (item, start in item, size, sequence,
    offset); ``left`` are items that would fill less than one sequence. When
    ``final`` they get a last sequence of their own.
    """
    placed, parts, sequence = [], [], 0
    for item in items:
        size, start = len(item[2]), 0
        while size - start >= length:
            placed.append((item, start, length, sequence, 0))
            sequence, start = sequence + 1, start + length
        if size > start:
            parts.append((item, start, size - start))
    total = sum(p[2] for p in parts)
    bins = total // length
    left = []
    if bins:
        cost, room = np.zeros(bins), np.full(bins, length)
        for item, start, size in sorted(parts, key=lambda p: -p[2]):
            while size:
                open_cost = np.where(room >= size, cost, np.inf)
                best = int(open_cost.argmin())
                if open_cost[best] == np.inf:
                    # It fits nowhere whole: the largest room takes what it can.
                    best = int(room.argmax())
                    if not room[best]:
                        left.append((item, start, size))
                        break
                put = min(size, int(room[best]))
                placed.append((item, start, put, sequence + best, length - int(room[best])))
                cost[best] += linear * put + float(put) * put
                room[best] -= put
                start, size = start + put, size - put
    else:
        left = parts
    used = sequence + bins
    if final and left:
        at = 0
        for item, start, size in left:
            placed.append((item, start, size, used, at))
            at += size
        left, used = [], used + 1
    return placed, [(i[0], i[1] + s, i[2][s : s + n], i[3]) for i, s, n in left], used


def _rows(placed, base: int, schema: pa.Schema, keep_ids: bool) -> pa.RecordBatch:
    pieces = [i[2][s : s + n] for i, s, n, _, _ in placed]
    columns = [
        pa.array([p[0][0] for p in placed], schema.field(0).type),
        pa.array([p[0][1] + p[1] for p in placed], pa.int64()),
        pa.array([p[2] for p in placed], pa.int64()),
        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in pieces], pa.int64()),
        pa.array([p[0][3] for p in placed], pa.int64()),
        pa.array([base + p[3] for p in placed], pa.int64()),
        pa.array([p[4] for p in placed], pa.int64()),
        pa.array([x.astype("<u4").tobytes() if keep_ids else None for x in pieces], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _left_rows(left: list[Item], schema: pa.Schema) -> pa.RecordBatch:
    """Items still to place: no sequence, but their ids."""
    none = pa.nulls(len(left), pa.int64())
    columns = [
        pa.array([i[0] for i in left], schema.field(0).type),
        pa.array([i[1] for i in left], pa.int64()),
        pa.array([len(i[2]) for i in left], pa.int64()),
        none,
        pa.array([i[3] for i in left], pa.int64()),
        none,
        none,
        pa.array([i[2].astype("<u4").tobytes() for i in left], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _packer(items_of, schema: pa.Schema, length: int, linear: float, final: bool, first_id: int, keep_ids: bool):
    """A function over Arrow batches that packs group after group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = first_id + (TaskContext.get().partitionId() << 32)
        held, tokens = [], 0
        for batch in batches:
            for item in items_of(batch):
                held.append(item)
                tokens += len(item[2])
                if tokens >= GROUP_TOKENS:
                    placed, held, used = pack(held, length, linear)
                    yield _rows(placed, base, schema, keep_ids)
                    base, tokens = base + used, sum(len(i[2]) for i in held)
        placed, held, _ = pack(held, length, linear, final)
        yield _rows(placed, base, schema, keep_ids)
        if held:
            yield _left_rows(held, schema)
        give_back()

    return run


def pack_documents(
    df: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    linear: float = LINEAR,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit binary.
    The text never moves; of the tokens, only each partition's remainder does.
    """
    path = path or tokenizer_path()
    rows = df.select(F.col(id_col), whole_text(text).alias("_text"))
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    schema = StructType([rows.schema[0], *StructType.fromDDL(numbers)])
    arrow = to_arrow_schema(schema)

    def documents(batch: pa.RecordBatch) -> Iterator[Item]:
        for key, ids in zip(batch.column(0).to_pylist(), encoded_documents(batch.column(1), path, end_id)):
            # A copy, so that no item keeps the slice's whole array alive.
            yield key, 0, ids.copy(), len(ids)

    def remainders(batch: pa.RecordBatch) -> Iterator[Item]:
        for key, start, ids, n in zip(*(batch.column(c).to_pylist() for c in (0, "start", "ids", "doc_tokens"))):
            yield key, start, np.frombuffer(ids, "<u4"), n

    first = rows.mapInArrow(_packer(documents, arrow, length, linear, False, 0, with_ids), schema)
    packed = materialize(first, "packed")
    rest = packed.where("sequence_id is null")
    tokens = rest.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = 1 + tokens // GROUP_TOKENS
    second = rest.repartition(groups, F.xxhash64(id_col, "start")).sortWithinPartitions(id_col, "start")
    closed = second.mapInArrow(_packer(remainders, arrow, length, linear, True, SECOND_LEVEL, with_ids), schema)
    out = packed.where("sequence_id is not null").unionByName(closed)
    return out if with_ids else out.drop("ids")
