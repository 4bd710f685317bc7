"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other.
Small transducers (how far a negation reaches, whether a clause reports speech,
whether an insult or threat is aimed at someone) are composed into one, which
runs over every clause that holds an insult or threat and gives each match a
kind. A document's score is a logistic function of the matched weights per kind
and of their density. The insult lexicon is a short list of fixed words and of
word stems learned from labelled rows; the weights of the kinds start from fixed
values and are fitted to the same rows.

Learning uses a hash sample of about LABELLED_ROWS labelled rows at most.

Defined results
    null or empty text: no match, the score of the intercept.
    Rows labelled more than once count as toxic when any label is 1; null ids
    and labels teach nothing. No labels at all: the fixed words and weights.
    Texts are read whole, a clause of any length included.
    Empty table: no rows; equal rows get equal scores. Other columns stay; one named
    like the output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.llm.rows import whole_text
from textmill.llm.text_arrays import buffers, give_back, slices
from textmill.session import materialize

LABELLED_ROWS = 20_000
STEM_BYTES = (4, 5, 6, 7, 8)
LEAST_G = 24.0
# A stem that toxic texts use again and again needs fewer of them.
LEAST_G_REPEATED = 12.0
REPEATED = 3
LEAST_PRECISION = 0.4
# How much heavier a longer stem must be than a chosen stem it begins with.
HEAVIER = 0.15
THRESHOLD = 0.3

# Fixed words of the grammar.
INSULTS = "idiot moron stupid loser trash scum pathetic worthless disgusting clown imbecile dumb".split()
THREATS = "kill hurt murder stab shoot strangle töten tuer matar".split()
TARGETS = "you your yourself he she they him her them du dich dein ihr sie tu toi vous ton il ils tú usted él".split()
NEGATIONS = "not no never nobody isn't aren't don't nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = "said says say wrote writes called quoted quote reported sagte schrieb dit écrit dijo escribió".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
KINDS = (
    "insult", "aimed insult", "negated insult", "reported insult",
    "threat", "aimed threat", "discounted threat", "late aim",
)
START_WEIGHTS = np.array([2.0, 3.0, 0.5, 0.5, 1.0, 3.0, 0.3, 0.5, 1.0])
START_BIAS = -4.0

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LETTER[ord("'")] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n()"]] = True


def code_of(word: str) -> int:
    """The first eight bytes of a word as a number, ASCII letters lower-cased."""
    return int.from_bytes(word.lower().encode()[:8], "little")


def _mask(size: int) -> int:
    return (1 << 8 * size) - 1


# The transducers -------------------------------------------------------------


def _negation(state: int, symbol: int) -> tuple[int, bool]:
    """Reaches over the next three words."""
    return (3 if symbol == NEGATION else max(0, state - 1)), state > 0


def _report(state: int, symbol: int) -> tuple[int, bool]:
    """From its verb to the end of the clause."""
    return (1 if symbol == REPORT else state), state > 0


def _aim(state: int, symbol: int) -> tuple[int, bool]:
    """A target up to four words before the match."""
    return (4 if symbol == TARGET else max(0, state - 1)), state > 0


def _late(state: int, symbol: int) -> tuple[int, bool]:
    """A target up to three words behind the match."""
    return (3 if symbol in (INSULT, THREAT) else max(0, state - 1)), state > 0 and symbol == TARGET


_PARTS = (_negation, _report, _aim, _late)
_COMPOSED: dict = {}


def step(state: tuple, symbol: int) -> tuple[tuple, int | None]:
    """One move of the composed transducer: the next state, and the kind of match it emits."""
    known = _COMPOSED.get((state, symbol))
    if known is None:
        moves = [part(s, symbol) for part, s in zip(_PARTS, state)]
        negated, reported, aimed, late = (m[1] for m in moves)
        kind = None
        if symbol == INSULT:
            kind = 3 if reported else 2 if negated else 1 if aimed else 0
        elif symbol == THREAT:
            kind = 6 if reported or negated else 5 if aimed else 4
        elif late and not (negated or reported):
            kind = 7
        known = _COMPOSED[(state, symbol)] = (tuple(m[0] for m in moves), kind)
    return known


START = (0, 0, 0, 0)


@dataclass
class ToxicityModel:
    """Stem codes with weights, and the weights of the kinds."""

    stems: dict[int, float]
    weights: np.ndarray = field(default_factory=lambda: START_WEIGHTS.copy())
    bias: float = START_BIAS

    def __post_init__(self):
        self.fixed = {}
        for symbol, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            self.fixed |= {code_of(w): symbol for w in listed}
        self.by_size = {}
        for code in self.stems:
            self.by_size.setdefault((code.bit_length() + 7) // 8, []).append(code)
        self.sorted = {k: np.array(sorted(v), np.uint64) for k, v in self.by_size.items()}
        self.threats = np.array(sorted(code_of(w) for w in THREATS), np.uint64)
        self.pairs = np.zeros(1 << 16, bool)
        for code in [*self.stems, *map(int, self.threats)]:
            self.pairs[code & 0xFFFF] = True

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are insults or threats, and the weight of each."""
        weight = np.zeros(len(codes))
        near = np.flatnonzero(self.pairs[(codes & np.uint64(0xFFFF)).astype(np.int64)])
        some = codes[near]
        for size, listed in self.sorted.items():
            key = some & np.uint64(_mask(size))
            at = np.minimum(np.searchsorted(listed, key), len(listed) - 1)
            for i in np.flatnonzero(listed[at] == key).tolist():
                weight[near[i]] = max(weight[near[i]], self.stems[int(key[i])])
        threat = near[np.isin(some, self.threats)]
        insult = np.flatnonzero(weight > 0)
        weight[threat] = np.maximum(weight[threat], 1.0)
        return np.union1d(insult, threat), weight

    def symbol(self, code: int, weight: float) -> int:
        known = self.fixed.get(code)
        if known is not None:
            return known
        return INSULT if weight > 0 else OTHER


def letter_words(data: np.ndarray, offsets: np.ndarray):
    """Start, end, text number, eight-byte code and clause number of every run of letters."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), np.empty(0, np.int64))
    solid = _LETTER[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] |= solid[inner]
    stops[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    code = np.zeros(len(start), np.uint64)
    for k in range(8):
        there = end - start > k
        code[there] |= _LOWER[data[start[there] + k]] << np.uint64(8 * k)
    breaks = _BREAK[data]
    breaks[inner] = True
    clause = np.cumsum(breaks)[start]
    # A text's own border counts as a break, whatever its first byte is.
    return start, end, doc, code, clause + doc


def clauses(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray):
    """Per clause with a match: text number, first and last byte, and its matches (kind, weight)."""
    start, end, doc, code, clause = letter_words(data, offsets)
    hit, weight = model.matches(code)
    if not len(hit):
        return
    for number in np.unique(clause[hit]).tolist():
        first, last = np.searchsorted(clause, [number, number + 1])
        state, found, carried = START, [], 0.0
        for c, w in zip(code[first:last].tolist(), weight[first:last].tolist()):
            state, kind = step(state, model.symbol(c, w))
            if kind is not None:
                carried = w or carried
                found.append((kind, carried))
        if found:
            yield int(doc[first]), int(start[first]), int(end[last - 1]), found


def features(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    """Per text: log of one plus the matched weight of each kind, then the matches' density."""
    data, offsets = buffers(texts)
    total = np.zeros((len(texts), len(KINDS)))
    for doc, _, _, found in clauses(model, data, offsets):
        for kind, weight in found:
            total[doc, kind] += weight
    size = np.diff(offsets)
    # About six bytes to a word; one match in twenty words is as dense as it gets.
    density = np.minimum(1.0, 120.0 * total[:, :7].sum(axis=1) / np.maximum(size, 1))
    return np.column_stack([np.log1p(total), density])


def scores(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    out = np.empty(len(texts))
    for first, last in slices(texts, 1 << 20):
        x = features(model, texts.slice(first, last - first))
        out[first:last] = 1.0 / (1.0 + np.exp(-(x @ model.weights + model.bias)))
    return out


# Learning --------------------------------------------------------------------


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per stem, summed over a slice: documents, toxic documents, and uses in toxic documents."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last in slices(batch.column("text"), 1 << 20):
            data, offsets = buffers(batch.column("text").slice(first, last - first))
            start, end, doc, code, _ = letter_words(data, offsets)
            keys, owners = [], []
            for size in STEM_BYTES:
                long = end - start >= size
                keys.append(code[long] & np.uint64(_mask(size)))
                owners.append(doc[long])
            pair = np.zeros(sum(map(len, keys)), [("key", np.uint64), ("doc", np.int64)])
            pair["key"], pair["doc"] = np.concatenate(keys), np.concatenate(owners)
            if not len(pair):
                continue
            order = np.lexsort((pair["doc"], pair["key"]))
            pair = pair[order]
            used = toxic[first:last][pair["doc"]]
            uses = np.add.reduceat(used, np.flatnonzero(np.append(True, pair["key"][1:] != pair["key"][:-1])))
            new = np.append(True, (pair["key"][1:] != pair["key"][:-1]) | (pair["doc"][1:] != pair["doc"][:-1]))
            pair = pair[new]
            head = np.flatnonzero(np.append(True, pair["key"][1:] != pair["key"][:-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pair["key"][head].view(np.int64)),
                    pa.array(np.diff(np.append(head, len(pair)))),
                    pa.array(np.add.reduceat(toxic[first:last][pair["doc"]], head)),
                    pa.array(uses),
                ],
                ["stem", "n", "k", "uses"],
            )


def _fit(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression pulled towards the fixed weights, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    prior = np.append(START_WEIGHTS, START_BIAS)
    w = prior.copy()
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        move = np.linalg.solve(curve, gradient)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def held_out(id_col: str | Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, id_col: str = "doc_id",
    text: str = "text", label: str = "toxic",
) -> DataFrame:
    """About ``rows`` labelled texts outside the held-out quarter, drawn by a hash of the id."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
        .groupBy(id_col).agg(F.max(label).alias("toxic"))
    )
    share = min(1.0, rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The sample is bounded by ``rows``, so its ids are small enough to broadcast.
    picked = documents.select(id_col, text).join(F.broadcast(drawn), id_col)
    return materialize(picked.select(whole_text(text).alias("text"), F.col("toxic").cast("int").alias("toxic")), "labelled")


def fit_model(sample: DataFrame) -> ToxicityModel:
    """Learn stems and weights from rows of text and toxic (0 or 1)."""
    base = {code_of(w): 1.0 for w in INSULTS}
    n_all, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic or n_toxic == n_all:
        return ToxicityModel(base)
    share = n_toxic / n_all
    counted = (
        sample.mapInArrow(_stem_counts, "stem long, n long, k long, uses long")
        .groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("n", "k", "uses")])
    )

    def term(part: Column, expected: Column) -> Column:
        return F.when(part > 0, part * F.log(part / expected)).otherwise(0.0)

    clean = F.col("n") - F.col("k")
    g = 2 * (term(F.col("k"), F.col("n") * share) + term(clean, F.col("n") * (1 - share)))
    enough = (g >= LEAST_G) | ((g >= LEAST_G_REPEATED) & (F.col("uses") >= REPEATED * F.col("k")))
    strong = counted.where((F.col("k") / F.col("n") >= LEAST_PRECISION) & enough).collect()
    chosen: dict[int, float] = {}
    for row in sorted(strong, key=lambda r: (int(r["stem"]) % (1 << 64)).bit_length()):
        code = int(row["stem"]) % (1 << 64)
        size = (code.bit_length() + 7) // 8
        odds = np.log((row["k"] + 0.5) / (row["n"] - row["k"] + 0.5)) - np.log(share / (1 - share))
        weight = float(np.clip(odds / 6.0, 0.1, 1.0))
        if weight >= max((chosen.get(code & _mask(s), 0.0) for s in STEM_BYTES if s < size), default=0.0) + HEAVIER * (size > 4):
            chosen[code] = weight
    model = ToxicityModel(base | chosen)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column("text"), 1 << 20):
                x = features(model, batch.column("text").slice(first, last - first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), pa.list_(pa.float64())), batch.column("toxic").slice(first, last - first)], ["x", "toxic"]
                )

    rows = sample.mapInArrow(measured, "x array<double>, toxic int").groupBy("x", "toxic").count().collect()
    x = np.array([r["x"] for r in rows])
    n = np.array([r["count"] for r in rows])
    model.weights, model.bias = _fit(np.repeat(x, n, axis=0), np.repeat([float(r["toxic"]) for r in rows], n))
    return model


def score_texts(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of every text; no row moves."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = pa.array(scores(model, texts))
        give_back()
        return out

    return df.withColumn(out, scored(whole_text(text)))


def matched_clauses(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "clauses") -> DataFrame:
    """Add the clauses with matches: their text, and the kind and weight of each match."""
    shape = "array<struct<clause:string,kinds:array<string>,weight:double>>"

    @F.arrow_udf(shape)
    def found(texts: pa.Array) -> pa.Array:
        lists: list[list] = [[] for _ in range(len(texts))]
        data, offsets = buffers(texts)
        for doc, first, last, kinds in clauses(model, data, offsets):
            lists[doc].append(
                {
                    "clause": data[first:last].tobytes().decode(),
                    "kinds": [KINDS[k] for k, _ in kinds],
                    "weight": float(sum(w for _, w in kinds)),
                }
            )
        kind = pa.struct([("clause", pa.string()), ("kinds", pa.list_(pa.string())), ("weight", pa.float64())])
        return pa.array(lists, pa.list_(kind))

    return df.withColumn(out, found(whole_text(text)))
