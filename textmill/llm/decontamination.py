"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A benchmark item of m words contaminates a document when some stretch of the
document is within floor((1 - threshold) * m) word edits of it. Windows of the
item's size are embedded by random walks (CGK): reading a word, the walk repeats
it or goes on to the next, by a coin that depends on the step and the word, so
two close sequences fall back into step after an edit and edit distance becomes
Hamming distance. Each LSH table samples a few positions of one walk; window and
item that agree in any table are compared by exact edit distance.

Windows are laid where a text shares a run of q words with an item, at the
place that run has in the item and at the SHIFTS around it. With k edits allowed
an item of m words falls into k + 1 parts of which one is untouched, so
q = floor(m / (k + 1)) loses nothing.

Words are runs of letters and digits, lower-cased (ASCII).

Defined results
    null and empty texts match nothing; items without words are ignored.
    An item found at several places of a text counts once, at its best place
    (fewest edits, then first). Repeated documents are each reported.
    Items are taken in blocks of bounded size, whatever their number; the texts
    are read once per block and never move.
    Very long texts are searched whole. Empty table: no rows; empty benchmark: no leaks.
    Other columns stay; one named like the output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import buffers, give_back, mix, slices, word_hashes

THRESHOLD = 0.8
WALKS = 6
TABLES = 8
SAMPLED = 2
SHIFTS = (0, -1, 1, -2, 2)
BLOCK_BYTES = 8 << 20
SEARCHED_BYTES = 1 << 20
WINDOWS_AT_ONCE = 1 << 14

_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_NOTHING = np.uint64(0)


def plain_words(texts: pa.Array):
    """Hash, first and last byte, and text number of every word; the bytes; where texts begin."""
    data, offsets = buffers(texts)
    if not len(data):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none, data, offsets
    solid = _SOLID[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] |= solid[inner]
    stops[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    # Signs between words must not count into a word's hash: they become blanks.
    quiet = np.where(solid, _LOWER[data], np.uint8(32))
    hashes = word_hashes(quiet, start, end) | np.uint64(1)
    return hashes, start, end, np.searchsorted(offsets, start, "right") - 1, data, offsets


def grams(hashes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every run of q words."""
    code = np.zeros(max(0, len(hashes) - q + 1), np.uint64)
    for k in range(q):
        code += hashes[k : len(code) + k] * _PLACE[k % len(_PLACE)]
    return mix(code)


def allowed_edits(words: int, threshold: float) -> int:
    return int(np.floor((1 - threshold) * words + 1e-9))


# Embedding -------------------------------------------------------------------


def _positions(m: int, walk: int) -> np.ndarray:
    """Sampled positions (TABLES x SAMPLED) of a walk over m words, fixed for m and walk.

    A walk has read its m words after about 2 m steps; positions lie before
    that, where few walks have ended.
    """
    draw = mix(np.arange(TABLES * SAMPLED, dtype=np.uint64) + np.uint64((walk * 4099 + m) * 1000003))
    return (draw % np.uint64(max(1, m + m // 2))).astype(np.int64).reshape(TABLES, SAMPLED)


def cgk_codes(rows: np.ndarray, walk: int) -> np.ndarray:
    """LSH codes (n x TABLES) of n word sequences of equal length m."""
    n, m = rows.shape
    padded = np.concatenate([rows, np.full((n, 1), _NOTHING)], axis=1)
    positions = _positions(m, walk)
    codes = np.zeros((n, TABLES), np.uint64)
    at, line = np.zeros(n, np.int64), np.arange(n)
    for step in range(int(positions.max()) + 1):
        word = padded[line, at]
        for table, slot in zip(*np.nonzero(positions == step)):
            codes[:, table] += word * _PLACE[slot + 1]
        coin = mix(word ^ np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64) ^ np.uint64(walk + 1)) & np.uint64(1)
        at = np.minimum(at + coin.astype(np.int64), m)
    return codes


def edit_distance(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits between the item and any part of the stretch, and that part's first and end word."""
    width = len(stretch) + 1
    index = np.arange(width)
    cost, origin = np.zeros(width, np.int64), index.copy()
    for k, word in enumerate(item):
        change = np.append(k + 1, cost[:-1] + (stretch != word))
        drop = cost + 1
        best = np.minimum(change, drop)
        begun = np.where(change <= drop, np.append(0, origin[:-1]), origin)
        # A word only the stretch has: carried along from the left.
        low = np.minimum.accumulate(best - index)
        final = low + index
        source = np.maximum.accumulate(np.where(best - index == low, index, 0))
        cost, origin = final, begun[np.where(final < best, source, index)]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


# Index of one block of items -------------------------------------------------


@dataclass
class Items:
    """What a task needs to find one block of items."""

    ids: list
    words: list[np.ndarray]
    threshold: float

    def __post_init__(self):
        self.by_size: dict[int, list[int]] = {}
        runs: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, w in enumerate(self.words):
            m = len(w)
            self.by_size.setdefault(m, []).append(i)
            q = m // (allowed_edits(m, self.threshold) + 1)
            code = grams(w, q)
            runs.setdefault(q, []).append((code, np.arange(len(code)), np.full(len(code), m)))
        self.anchors = {}
        for q, parts in runs.items():
            code, at, size = (np.concatenate(x) for x in zip(*parts))
            # Items with one run at one place need its windows once.
            table = np.unique(np.rec.fromarrays([code, at, size], names="code,at,size"))
            bits = int(np.ceil(np.log2(64 * len(table) + 1)))
            seen = np.zeros(1 << bits, bool)
            seen[(table["code"] >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.anchors[q] = (table["code"], table["at"], table["size"], seen, np.uint64(64 - bits))
        self.codes = {
            m: [cgk_codes(np.stack([self.words[i] for i in group]), walk) for walk in range(WALKS)]
            for m, group in self.by_size.items()
        }

    def windows(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Item sizes, and where windows of that size begin; some may overhang a text."""
        begun: dict[int, list[np.ndarray]] = {}
        for q, (code, at, size, seen, shift) in self.anchors.items():
            here = grams(hashes, q)
            place = np.flatnonzero(seen[(here >> shift).astype(np.int64)])
            low = np.searchsorted(code, here[place], "left")
            count = np.searchsorted(code, here[place], "right") - low
            place, low, count = place[count > 0], low[count > 0], count[count > 0]
            if not len(place):
                continue
            entry = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            start = np.repeat(place, count) - at[entry]
            for m in np.unique(size[entry]).tolist():
                begun.setdefault(m, []).append(np.unique(start[size[entry] == m]))
        for m, starts in begun.items():
            yield m, np.unique(np.add.outer(np.unique(np.concatenate(starts)), SHIFTS))

    def candidates(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window start, item) that agree in an LSH table.

        ``first`` and ``last`` bound the words of the text that each word is in.
        """
        n = len(hashes)
        for m, starts in self.windows(hashes):
            # An overhanging window is read as far as its text goes.
            middle = np.clip(starts + m // 2, 0, n - 1)
            for i in range(0, len(starts), WINDOWS_AT_ONCE):
                begin, inside = starts[i : i + WINDOWS_AT_ONCE], middle[i : i + WINDOWS_AT_ONCE]
                index = begin[:, None] + np.arange(m)
                there = (index >= first[inside][:, None]) & (index < last[inside][:, None])
                rows = np.where(there, hashes[np.clip(index, 0, n - 1)], _NOTHING)
                met: set[tuple[int, int]] = set()
                for walk in range(WALKS):
                    codes, known = cgk_codes(rows, walk), self.codes[m][walk]
                    for table in range(TABLES):
                        order = np.argsort(known[:, table], kind="stable")
                        listed = known[order, table]
                        low = np.searchsorted(listed, codes[:, table], "left")
                        high = np.searchsorted(listed, codes[:, table], "right")
                        for w in np.flatnonzero(high > low).tolist():
                            met |= {(w, int(order[j])) for j in range(low[w], high[w])}
                for w, j in met:
                    yield int(begin[w]), self.by_size[m][j]


def find_items(items: Items, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item number, edits, first and end code point) of each item found in each text."""
    hashes, start, end, doc, data, offsets = plain_words(texts)
    if not len(hashes):
        return
    borders = np.searchsorted(doc, np.arange(len(texts) + 1))
    first, last = borders[doc], borders[doc + 1]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    tried: set[tuple[int, int]] = set()
    for begin, item in items.candidates(hashes, first, last):
        if (begin, item) in tried:
            continue
        words = items.words[item]
        m, k = len(words), allowed_edits(len(words), items.threshold)
        inside = min(max(begin + m // 2, 0), len(hashes) - 1)
        tried |= {(begin, item)}
        low, high = max(begin - k, int(first[inside])), min(begin + m + k, int(last[inside]))
        edits, at, stop = edit_distance(words, hashes[low:high])
        if edits <= k and stop > at:
            key, found = (int(doc[inside]), item), (edits, low + at, low + stop)
            best[key] = min(best.get(key, found), found)
    for (text, item), (edits, at, stop) in sorted(best.items()):
        raw = data[offsets[text] :]

        def points(byte: int) -> int:
            """Code points of the text before a byte."""
            return int(np.count_nonzero((raw[: byte - offsets[text]] & 0xC0) != 0x80))

        yield text, item, edits, points(int(start[at])), points(int(end[stop - 1]))


LEAKS = "array<struct<item_id:{0},edits:int,similarity:double,start:long,end:long>>"


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", out: str = "leaks",
) -> DataFrame:
    """Add the items found in every text: id, edits, similarity, and the stretch in code points."""
    listed = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    size = listed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    kind = LEAKS.format(listed.schema["item_id"].dataType.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(f"leaks {kind}")).field(0).type

    def search(ids: list, texts: list[str]):
        index = []

        @F.arrow_udf(kind)
        def leaks(column: pa.Array) -> pa.Array:
            if not index:
                words, _, _, owner, _, _ = plain_words(pa.array(texts, pa.string()))
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                some = [i for i in range(len(texts)) if cut[i + 1] > cut[i]]
                index.append(Items([ids[i] for i in some], [words[cut[i] : cut[i + 1]] for i in some], threshold))
            items, lists = index[0], [[] for _ in range(len(column))]
            for a, b in slices(column, SEARCHED_BYTES):
                for at, item, edits, start, end in find_items(items, column.slice(a, b - a)):
                    share = 1 - edits / len(items.words[item])
                    lists[a + at].append(
                        {"item_id": items.ids[item], "edits": edits, "similarity": share, "start": start, "end": end}
                    )
            give_back()
            return pa.array(lists, arrow)

        return leaks(whole_text(text))

    # A block is bounded in bytes on average, by a hash of the item's text.
    found = []
    for block in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        found.append(search([r["item_id"] for r in part], [r["text"] for r in part]))
    return docs.withColumn(out, found[0] if len(found) == 1 else F.concat(*found))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it."""
    rows = docs.select(id_col, F.col(text).alias("_text"))
    marked = with_leaks(rows, benchmark, threshold, "_text", item_id, item_text, "_leaks")
    return marked.select(id_col, F.explode("_leaks").alias("_l")).select(id_col, "_l.*")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """Documents in which no item was found."""
    return with_leaks(docs, benchmark, threshold, text, out="_leaks").where(F.size("_leaks") == 0).drop("_leaks")
