"""Term lists of any length, with terms of any number of words, matched in the row.

The list becomes a trie over words, kept as flat sorted arrays: a state is the
64-bit hash of the words that lead to it, so following a word is one binary
search, and all places of a batch of texts advance together. Starting at every
place at once needs no failure links. States are dealt to shards by the first two
words of their terms, built in tasks and written as one row each; a worker holds
one bundle at a time, a shard or as many small ones as SHARD_TERMS allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from textmill.session import materialize

SHARD_TERMS = 200_000
# Beyond four million terms a filter of this size lets more runs pass; the join decides.
MAX_BITS = 1 << 27
# Code points looked at together.
POINTS_AT_ONCE = 4 << 20
_ENTITY = "struct<start:int,end:int,type:string,entity:string,public:boolean>"


def spread(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def follow(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return spread(state * np.uint64(0x9E3779B97F4A7C15) + word)


class Words:
    """The words of some texts: place, hash, and whether one blank alone leads to the next word."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        letter = np.zeros(int(points.max()) + 1 if len(points) else 1, bool)
        present = np.flatnonzero(np.bincount(points)) if len(points) else np.empty(0, np.int64)
        letter[present] = [chr(c).isalnum() or c == 95 for c in present]
        inside = np.concatenate(([False], letter[points], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        if len(self.start):
            # A polynomial of the code points of each word.
            size = self.end - self.start
            word = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
            powers = np.cumprod(np.full(int(size.max()), 0x5851F42D4C957F2D, np.uint64))
            value = spread(points[self.start[word] + place].astype(np.uint64) + np.uint64(1)) * powers[place]
            total = np.add.reduceat(value, np.cumsum(size) - size)
            self.hash = spread(total + size.astype(np.uint64))
        else:
            self.hash = np.empty(0, np.uint64)
        self.tight = np.zeros(len(self.start), bool)
        close = np.flatnonzero(self.start[1:] - self.end[:-1] == 1)
        self.tight[close] = points[self.end[close]] == 32


# Shards ------------------------------------------------------------------------


def term_states(terms: DataFrame, shards: int) -> DataFrame:
    """(shard, state, type, public, final) of every term and of every place inside it where it goes on."""

    def stated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("term").to_pylist()]
            found = Words(texts)
            n = np.bincount(found.doc, minlength=len(texts))
            first = np.searchsorted(found.doc, np.arange(len(texts)))
            # A term is words with one blank between them and nothing else.
            size = np.diff(found.offsets) - 1
            whole = np.bincount(found.doc, found.end - found.start, len(texts)) + np.maximum(n - 1, 0) == size
            loose = np.bincount(found.doc, ~found.tight, len(texts)) > 1
            term = np.flatnonzero((n > 0) & whole & ~loose)
            state, depth, rows = np.zeros(len(term), np.uint64), 0, []
            route = np.zeros(len(term), np.uint64)
            while len(term):
                state = follow(state, found.hash[first[term] + depth])
                depth += 1
                if depth <= 2:
                    route = state
                final = n[term] == depth
                # From two words on a state is looked for when the words before it were found.
                kept = final | (depth >= 2)
                rows.append((route[kept] % np.uint64(shards), state[kept], term[kept], final[kept]))
                term, state, route = term[~final], state[~final], route[~final]
            if rows:
                shard, state, term, final = (np.concatenate(c) for c in zip(*rows))
                columns = [pa.array(shard.astype(np.int32)), pa.array(state.view(np.int64))]
                columns += [batch.column(c).take(pa.array(term)) for c in ("type", "public")] + [pa.array(final)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "state", "type", "public", "final"])

    schema = "shard int, state long, type string, public boolean, final boolean"
    return terms.select("term", "type", "public").mapInArrow(stated, schema)


def shard_rows(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard: (shard, shards, inner, ends); inner are states to go on from, ends the terms."""
    shards = 1 + terms.count() // shard_terms
    states = term_states(terms, shards)
    end = F.struct("state", "type", "public")
    rows = states.groupBy("shard").agg(
        F.collect_set(F.when(~F.col("final"), F.col("state"))).alias("inner"),
        F.collect_set(F.when(F.col("final"), end)).alias("ends"),
    )
    return materialize(rows.withColumn("shards", F.lit(shards)), "gazetteer")


def bundles(sizes: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """First and last shard of runs of neighbours, from sorted (shard, inner states, terms).

    Small shards share a bundle, so the passes over a text do not grow with their number.
    """
    out, inner, ends = [], 0, 0
    for shard, i, e in sizes:
        inner, ends = inner + i, ends + e
        if out and ends <= SHARD_TERMS and inner <= 8 * SHARD_TERMS:
            out[-1] = (out[-1][0], shard)
        else:
            out.append((shard, shard))
            inner, ends = i, e
    return out


def send_shards(rows: DataFrame) -> tuple[list[tuple[int, Broadcast]], int]:
    """(first shard, arrays) of every bundle for the tasks, one at a time through the driver, and the number of shards."""
    sent, shards = [], 1
    sizes = rows.select("shard", F.size("inner"), F.size("ends")).collect()
    for shard, last in bundles(sorted(map(tuple, sizes))):
        row = rows.where(F.col("shard").between(shard, last)).toArrow()
        shards = row["shards"][0].as_py()
        inner, ends = (pc.list_flatten(row[c]).combine_chunks() for c in ("inner", "ends"))
        state = ends.field("state").to_numpy().view(np.uint64)
        order = np.argsort(state, kind="stable")
        named = ends.field("type").dictionary_encode()
        public = ends.field("public").fill_null(False).to_numpy(zero_copy_only=False)
        arrays = (
            last, np.sort(inner.to_numpy().view(np.uint64)), state[order],
            named.indices.to_numpy()[order], named.dictionary.to_pylist(), public[order],
        )
        sent.append((shard, rows.sparkSession.sparkContext.broadcast(arrays)))
    return sent, shards


# Matching ------------------------------------------------------------------------


def among(states: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(states), bool)
    return known[np.minimum(np.searchsorted(known, states), len(known) - 1)] == states


def dealt(state: np.ndarray, shards: int, first: int, last: int) -> np.ndarray:
    shard = state % np.uint64(shards)
    return (shard >= np.uint64(first)) & (shard <= np.uint64(last))


def run_shards(
    words: Words, first: int, last: int, shards: int, inner: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """(first word, last word, index in ``ends``) of all terms of some neighbouring shards, level by level."""
    state = follow(np.zeros(len(words.hash), np.uint64), words.hash)
    at, depth = np.arange(len(state)), 1
    here = dealt(state, shards, first, last)
    while len(at):
        low, high = np.searchsorted(ends, state, "left"), np.searchsorted(ends, state, "right")
        hits = high - low if depth > 1 else np.where(here, high - low, 0)
        which = np.repeat(np.arange(len(at)), hits)
        if len(which):
            nth = np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits)
            yield at[which], at[which] + depth - 1, low[which] + nth
        # The first two words decide the shard; from the third on the way so far must be known.
        goes = words.tight[at + depth - 1]
        if depth >= 2:
            goes &= among(state, inner)
        at = at[goes]
        state = follow(state[goes], words.hash[at + depth])
        depth += 1
        if depth == 2:
            mine = dealt(state, shards, first, last)
            at, state = at[mine], state[mine]


def slices(texts: list[str], points: int = POINTS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """First and end of runs of whole texts that are looked at together."""
    size = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(size, size[first] + points, "right")) - 1)
        last = min(last, len(texts))
        yield first, last
        first = last


def leftmost_longest(rows: list[tuple]) -> list[tuple]:
    """Of matches sorted by start and then by falling end those that start behind the one before, in every type."""
    out, reach, last = [], -1, None
    for r in rows:
        if r[0] >= reach:
            out.append(r)
            reach, last = r[1], r[:2]
        elif r[:2] == last:
            out.append(r)
    return out


def listed_entities(text: Column, terms: DataFrame, longest: bool = False, shard_terms: int = SHARD_TERMS) -> Column:
    """Matches of the term table (term, type, public) in the row's text.

    All of them, sorted; or the leftmost longest ones. A term is words (runs of
    letters, digits and underscores) with one blank between them; it matches
    whole words in the same form.
    """
    sent, shards = send_shards(shard_rows(terms, shard_terms))

    @F.arrow_udf(f"array<{_ENTITY}>")
    def matches(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        found: list[list[tuple]] = [[] for _ in values]
        for first, last in slices(values):
            words = Words(values[first:last])
            for shard, variable in sent:
                last_shard, inner, ends, code, types, public = variable.value
                for begin, end, term in run_shards(words, shard, last_shard, shards, inner, ends):
                    doc = words.doc[begin]
                    starts, stops = words.start[begin] - words.offsets[doc], words.end[end] - words.offsets[doc]
                    for d, s, e, t in zip(doc.tolist(), starts.tolist(), stops.tolist(), term.tolist()):
                        found[first + d].append((s, e, types[code[t]], values[first + d][s:e], bool(public[t])))
                if len(sent) > 1:
                    # Read again from the worker's disk when its turn comes; one bundle is held at a time.
                    vars(variable).pop("_value", None)
        for rows in found:
            rows.sort(key=lambda r: (r[0], -r[1] if longest else r[1], r[2]))
        if longest:
            found = [leftmost_longest(rows) for rows in found]
        names = ["start", "end", "type", "entity", "public"]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("entity", pa.string()), ("public", pa.bool_())]))
        return pa.array([[dict(zip(names, r)) for r in rows] for rows in found], kind)

    return matches.asNondeterministic()(F.coalesce(text, F.lit("")))


# Runs for a join ---------------------------------------------------------------------


def run_states(words: Words, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, first word, state) of all runs of up to ``max_words`` words with one blank between them."""
    state, at = follow(np.zeros(len(words.hash), np.uint64), words.hash), np.arange(len(words.hash))
    for n in range(1, max_words + 1):
        yield n, at, state
        goes = words.tight[at + n - 1]
        at = at[goes]
        state = follow(state[goes], words.hash[at + n])


def marks(state: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a state among ``size`` bits."""
    mask = np.uint64(size - 1)
    return state & mask, (state >> np.uint64(32)) & mask


def is_set(bits: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def term_bits(terms: DataFrame, max_words: int) -> np.ndarray:
    """A Bloom filter of all runs that are terms: 32 bits a term and more, MAX_BITS at most."""
    size = min(MAX_BITS, max(1 << 16, 1 << (32 * terms.count()).bit_length()))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(["" if t is None else t for t in batch.column(0).to_pylist()])
            found = []
            for n, at, state in run_states(words, max_words):
                doc = words.doc[at]
                whole = (words.start[at] == words.offsets[doc]) & (words.end[at + n - 1] == words.offsets[doc + 1] - 1)
                found += marks(state[whole], size)
            bit = np.concatenate(found)
            block, at = np.unique(bit >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(block), np.uint64)
            np.bitwise_or.at(value, at, np.uint64(1) << (bit & np.uint64(63)))
            columns = [pa.array(block.astype(np.int32)), pa.array(value.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "value"])

    found = terms.select("term").mapInArrow(marked, "block int, value long").groupBy("block").agg(F.bit_or("value").alias("value")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["block"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return bits


def likely_runs(df: DataFrame, terms: DataFrame, id_col: str, text: Column, max_words: int) -> DataFrame:
    """(id, start, end, term) of runs of words, of which those that cannot be a term are left out where they are."""
    bits = df.sparkSession.sparkContext.broadcast(term_bits(terms, max_words))

    def spotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in slices(texts):
                words = Words(texts[first:last])
                for n, at, state in run_states(words, max_words):
                    bit, other = marks(state, 64 * len(known))
                    at = at[is_set(known, bit) & is_set(known, other)]
                    doc = words.doc[at]
                    start, end = words.start[at] - words.offsets[doc], words.end[at + n - 1] - words.offsets[doc]
                    run = [texts[first + d][a:b] for d, a, b in zip(doc.tolist(), start.tolist(), end.tolist())]
                    columns = [batch.column(0).take(pa.array(first + doc)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(run, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, [id_col, "start", "end", "term"])

    schema = StructType([df.schema[id_col], *StructType.fromDDL("start int, end int, term string")])
    return df.select(id_col, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(spotted, schema)
