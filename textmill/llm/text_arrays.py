"""Words and word shingles of a whole Arrow batch as numpy arrays.

A batch's texts lie in one UTF-8 buffer, so words are found, hashed and put
together into shingles without making a Python string. Words are runs of
characters other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# One random value per byte; white space counts nothing.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[_SPACE] = 0
_STEP = np.uint64(0x5851F42D4C957F2D)
_PLACE = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, starts, data = texts.buffers()
    if not len(texts) or starts is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(starts, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    _, offsets = buffers(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def give_back() -> None:
    """Return freed memory to the system: workers live on, and an executor's are counted together."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has no such call


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] |= solid[inner]
    ends[inner - 1] |= solid[inner - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(start):
        return np.empty(0, np.uint64)
    first = start[0]
    span = np.diff(np.append(start, len(data)))
    place = np.arange(first, len(data)) - np.repeat(start, span)
    powers = np.cumprod(np.full(int(place.max()) + 1, _STEP, np.uint64))
    value = _BYTE[data[first:]] * powers[place]
    total = np.add.reduceat(value, start - first)
    return mix(total + (end - start).astype(np.uint64))


def shingles(
    hashes: np.ndarray, doc: np.ndarray, size: int = SHINGLE, prefixes: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words inside a text, ordered by text.

    A shorter text has one shingle, all its words. With ``prefixes`` every
    text also has the runs of its first 1 to ``size`` - 1 words.
    """
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key, owner = [], []
    if n >= size:
        code = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            code += hashes[k : n - size + 1 + k] * _PLACE[k]
        inside = doc[: n - size + 1] == doc[size - 1 :]
        key.append(code[inside])
        owner.append(doc[: n - size + 1][inside])
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    count = np.diff(np.append(head, n))
    for m in range(1, size):
        some = head[count >= m] if prefixes else head[count == m]
        code = np.full(len(some), m * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for k in range(m):
            code += hashes[some + k] * _PLACE[k]
        key.append(code)
        owner.append(doc[some])
    key, owner = mix(np.concatenate(key)), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order]


def grouped(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by text and hash, and where each run of equal (text, hash) begins in it."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = None
    if doc.max() < 4096:
        # Text number and the upper 52 bits of the hash in one word sort several times faster.
        packed = (doc.astype(np.uint64) << np.uint64(52)) | (key >> np.uint64(12))
        order = np.argsort(packed)
        k, p = key[order], packed[order]
        if ((p[1:] == p[:-1]) & (k[1:] != k[:-1])).any():
            order = None
    if order is None:
        order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    return order, np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])))


def text_shingles(texts: pa.Array, size: int = SHINGLE, prefixes: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a string array and the row each belongs to."""
    data, offsets = buffers(texts)
    start, end, doc = words(data, offsets)
    return shingles(word_hashes(data, start, end), doc, size, prefixes)
