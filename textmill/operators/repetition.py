"""n-gram repetition inside one document.

Documents are independent, so nothing is shuffled: words become 64-bit hashes in
the JVM and the hashes of some documents at a time are sorted together with numpy.
Only n-grams that a document has twice are looked at longer than by one sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from textmill.functions.text import Parts, lengths, ratio

TOP_N_GRAMS = [(2, 0.25), (3, 0.23), (4, 0.21)]
DUP_N_GRAMS = [(5, 0.20), (6, 0.19), (7, 0.18), (8, 0.17), (9, 0.16), (10, 0.15)]
# Words sorted together: few enough for a processor's cache.
WORDS_AT_ONCE = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(hashes: np.ndarray, doc: np.ndarray, n: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start index of the n-grams at ``start`` that stay within one document."""
    start = start[: np.searchsorted(start, len(hashes) - n, "right")]
    start = start[doc[start] == doc[start + n - 1]]
    key = np.zeros(len(start), np.uint64)
    for k in range(n):
        key = (key ^ hashes[start + k]) * _MIX
        key ^= key >> np.uint64(29)
    return key, start


def _repeated(hashes: np.ndarray, doc: np.ndarray, sizes: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per n, hash and start of all n-grams that their document has twice or more; by a hash, so others may be among them.

    Where an n-gram occurs again, so do the shorter ones that begin there.
    """
    out, start = {}, np.arange(len(hashes))
    for n in sorted(set(sizes)):
        key, start = _grams(hashes, doc, n, start)
        mixed = key ^ (doc[start].astype(np.uint64) * _MIX)
        order = np.argsort(mixed)
        mixed = mixed[order]
        same = mixed[1:] == mixed[:-1]
        again = np.zeros(len(start), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        out[n] = key, start = key[again], start[again]
    return out


def _sorted_runs(key: np.ndarray, doc: np.ndarray):
    """Order by document, then gram, then position; flag the first of each run."""
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    first = np.ones(len(order), bool)
    first[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return order, first


def _top_chars(key, start, lens, doc, ends, n_docs: int, n: int) -> np.ndarray:
    """Length times count of the most frequent gram per document, the longest on a tie."""
    out = np.zeros(n_docs, np.int64)
    # The longest one, for documents in which all occur once.
    at = np.flatnonzero(doc[: max(len(doc) - n + 1, 0)] == doc[n - 1 :])
    if not len(at):
        return out
    heads = np.flatnonzero(np.append(True, np.diff(doc[at])))
    out[doc[at[heads]]] = np.maximum.reduceat(ends[at + n - 1] - (ends[at] - lens[at]), heads)
    order, first = _sorted_runs(key, doc[start])
    heads = np.flatnonzero(first)
    count = np.diff(np.append(heads, len(order)))
    heads, count = heads[count > 1], count[count > 1]
    if not len(heads):
        return out
    at = start[order[heads]]
    length = ends[at + n - 1] - (ends[at] - lens[at])
    owner = doc[at]
    best = np.lexsort((length, count, owner))
    last = np.append(np.flatnonzero(np.diff(owner[best])), len(best) - 1)
    pick = best[last]
    out[owner[pick]] = length[pick] * count[pick]
    return out


def _dup_chars(key, start, lens, doc, ends, n_docs: int, n: int) -> np.ndarray:
    """Characters inside second and later occurrences of a gram, overlaps counted once."""
    order, first = _sorted_runs(key, doc[start])
    again = np.sort(start[order[~first]])
    if not len(again):
        return np.zeros(n_docs, np.int64)
    begin = ends[again] - lens[again]
    end = ends[again + n - 1]
    stop = end.copy()
    same_doc = doc[again[1:]] == doc[again[:-1]]
    stop[:-1] = np.where(same_doc, np.minimum(end[:-1], begin[1:]), end[:-1])
    return np.bincount(doc[again], stop - begin, n_docs).astype(np.int64)


def measured(hash_lists: list[np.ndarray], length_lists: list[np.ndarray], top: list[int], dup: list[int]) -> np.ndarray:
    """One row of character counts per document."""
    n_docs = len(hash_lists)
    sizes = np.fromiter((len(h) for h in hash_lists), np.int64, n_docs)
    if not sizes.sum():
        return np.zeros((n_docs, len(top) + len(dup)), np.int64)
    hashes = np.concatenate(hash_lists).astype(np.int64).view(np.uint64)
    lens = np.concatenate(length_lists).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), sizes)
    # Offsets in the words joined by single blanks; only differences inside a document count.
    ends = np.cumsum(lens + 1) - 1
    again = _repeated(hashes, doc, [*top, *dup])
    columns = [_top_chars(*again[n], lens, doc, ends, n_docs, n) for n in top]
    columns += [_dup_chars(*again[n], lens, doc, ends, n_docs, n) for n in dup]
    return np.stack(columns, axis=1)


def slices(lists: list) -> Iterator[tuple[int, int]]:
    """First and end of runs of whole documents of about WORDS_AT_ONCE words."""
    size = np.cumsum([0, *(len(x) for x in lists)])
    first = 0
    while first < len(lists):
        last = int(np.searchsorted(size, size[first] + WORDS_AT_ONCE, "right")) - 1
        last = min(max(first + 1, last), len(lists))
        yield first, last
        first = last


def ngram_chars(words: Column, top: list[int], dup: list[int]) -> Column:
    """Array of character counts: one per n in ``top``, then one per n in ``dup``."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def measure(hash_lists: pd.Series, length_lists: pd.Series) -> pd.Series:
        hashes, lens, out = hash_lists.tolist(), length_lists.tolist(), []
        for first, last in slices(hashes):
            out += list(measured(hashes[first:last], lens[first:last], top, dup))
        return pd.Series(out, dtype=object)

    # Marked so that the plan never copies the call into each of the fractions.
    measure = measure.asNondeterministic()
    return measure(F.transform(words, lambda w: F.xxhash64(w)), lengths(words))


def with_ngram_fractions(
    df: DataFrame, p: Parts, top: list[int], dup: list[int], only_if: Column | None = None
) -> DataFrame:
    """Add top_<n>_gram and dup_<n>_gram character fractions.

    ``only_if`` spares rows that are already rejected; they get null.
    """
    words = p.words if only_if is None else F.when(only_if, p.words).otherwise(
        F.array().cast("array<string>")
    )
    df = df.withColumn("_chars", ngram_chars(words, top, dup))
    names = [f"top_{n}_gram" for n in top] + [f"dup_{n}_gram" for n in dup]
    fractions = {name: ratio(F.get("_chars", F.lit(i)), p.n_char) for i, name in enumerate(names)}
    if only_if is not None:
        fractions = {k: F.when(only_if, v) for k, v in fractions.items()}
    return df.withColumns(fractions).drop("_chars")


def ngram_rules(top=TOP_N_GRAMS, dup=DUP_N_GRAMS) -> list:
    rules = [(f"top_{n}_gram", F.col(f"top_{n}_gram") > t) for n, t in top or [] if t is not None]
    rules += [(f"duplicated_{n}_gram", F.col(f"dup_{n}_gram") > t) for n, t in dup or [] if t is not None]
    return rules
