"""Detection and masking of personal data.

Every step works on an array of entities inside the row: array of
(start, end, type, entity, public), 0-based, end exclusive. Text therefore
never shuffles; only gazetteer matches travel, without the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import char_blocks, explode_once, let, prefix_scan, prefix_sums, runs, total
from textmill.functions.fixed_values import LOCALE_TERMS, PII_PRECEDENCE
from textmill.operators.gazetteer import likely_runs, listed_entities
from textmill.operators.skew import salted_join
from textmill.session import materialize

ENTITY = "struct<start:int,end:int,type:string,entity:string,public:boolean>"
ENTITIES = f"array<{ENTITY}>"
GROUPED = "array<struct<start:int,end:int,type:string,entity:string,public:boolean,no:int>>"
BLOCK_CHARS = 1024
MAX_FIGURES = 10_000


# Check digits --------------------------------------------------------------


def _digits(token: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(token, "[^0-9]", ""), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))


def luhn(token: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""

    def check(d: Column) -> Column:
        doubled = F.transform(
            F.reverse(d), lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)
        )
        return F.size(d).between(13, 19) & (total(doubled) % 10 == 0)

    return let(_digits(token), check)


def eleven_test(token: Column) -> Column:
    """Weights 9 down to 2, the last digit counting as -1; the sum divides by 11."""

    def check(d: Column) -> Column:
        weighted = F.transform(d, lambda x, i: F.when(i == 8, -x).otherwise(x * (9 - i)))
        return let(total(weighted), lambda s: (s % 11 == 0) & (s != 0))

    return let(_digits(token), check)


def mod_97(token: Column) -> Column:
    moved = F.concat(F.substring(token, 5, 40), F.substring(token, 1, 4))
    values = F.transform(F.split(moved, ""), lambda c: F.ascii(c) - F.when(c.rlike("[0-9]"), 48).otherwise(55))
    rest = F.aggregate(
        values, F.lit(0), lambda r, v: (F.when(v > 9, r * 100 + v).otherwise(r * 10 + v)) % 97
    )
    return rest == 1


def octets(token: Column) -> Column:
    return F.forall(F.split(token, "\\."), lambda x: (F.length(x) <= 3) & (x.try_cast("int") <= 255))


def coordinate(token: Column) -> Column:
    pair = F.transform(F.split(token, ", ?"), lambda x: F.abs(x.try_cast("double")))
    return (F.get(pair, F.lit(0)) <= 90) & (F.get(pair, F.lit(1)) <= 180)


# Detectors -----------------------------------------------------------------


@dataclass(frozen=True)
class Detector:
    """``pattern`` finds a place, ``core`` is the entity at its end, ``valid`` confirms it.

    ``gate`` is a cheap test that spares most texts the search. Patterns use no
    look-around, and possessive quantifiers only where they cannot change a match.
    """

    type: str
    pattern: str
    gate: str
    core: str | None = None
    valid: Callable[[Column], Column] | None = None


def _shape(regex: str, check: Callable[[Column], Column] | None = None):
    if check is None:
        return lambda t: t.rlike(regex)
    return lambda t: F.when(t.rlike(regex), check(t)).otherwise(F.lit(False))


# Patterns (fixed values). An alphanumeric token with at least one digit:
TOKEN = "[A-Za-z]*+[0-9][0-9A-Za-z]*+"
EMAIL = "[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
IP = "[0-9]+(?:\\.[0-9]+){3}"
PHONE = "\\+[0-9]{1,3}[ -]?(?:\\([0-9]{1,4}\\)[ -]?)?[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,4}"
URL = "https?://[^ \\t\\r\\n<>\"']+"
CARD = "[0-9](?:[ -]?[0-9]){12,18}"
EXPIRATION = "[0-9]+(?:/[0-9]++)++"
CVV = "(?i)(?:cvv2?|cvc2?)[^0-9\\n]{0,5}[0-9]+"
LICENSE = "(?i)(?:driver'?s? licen[cs]e|rijbewijs)[^0-9\\n]{0,20}[0-9]+"
HEALTH = "(?i)(?:healthcare|health|polis|policy|zorg)[^0-9\\n]{0,20}[0-9]+"
ZIP = "[0-9]+ ?[A-Za-z]+"
COORDINATE = "-?[0-9]{1,3}\\.[0-9]{3,}, ?-?[0-9]{1,3}\\.[0-9]{3,}"
DASHED = "[0-9A-Za-z]++(?:-[0-9A-Za-z]++)++"
PLATE_SHAPE = "^([0-9]{1,3}|[B-DF-HJ-NP-TV-XZ]{1,3})(-([0-9]{1,3}|[B-DF-HJ-NP-TV-XZ]{1,3})){2}$"
TAIL_DIGITS = "[0-9]+$"

DETECTORS = [
    Detector("EMAIL_ADDRESS", EMAIL, "@"),
    Detector("IP_ADDRESS", IP, "[0-9]\\.[0-9]", valid=octets),
    Detector("PHONE_NUMBER", PHONE, "\\+[0-9]"),
    Detector("PHONE_NUMBER", DASHED, "0[0-9]{1,3}-[0-9]{6}", valid=_shape("^0[0-9]{1,3}-[0-9]{6,8}$")),
    Detector("URL", URL, "://"),
    Detector("BANK_ACCOUNT", TOKEN, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11}", valid=_shape("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$", mod_97)),
    Detector("CREDIT_CARD", CARD, "[0-9][ -]?[0-9]{3}", valid=luhn),
    Detector("CREDIT_CARD_EXPIRATION", EXPIRATION, "[0-9]/[0-9]", valid=_shape("^(0[1-9]|1[0-2])/[0-9]{2}$")),
    Detector("CVV", CVV, "(?i)cv[vc]", core=TAIL_DIGITS, valid=_shape("^[0-9]{3}$")),
    Detector("SSN", TOKEN, "[0-9]{9}", valid=_shape("^[0-9]{9}$", eleven_test)),
    Detector("PASSPORT_NUMBER", TOKEN, "[A-NP-Z]{2}[A-NP-Z0-9]{5}[0-9]", valid=_shape("^[A-NP-Z]{2}[A-NP-Z0-9]{5}[0-9]$")),
    Detector("DRIVER_LICENSE", LICENSE, "[0-9]{10}", core=TAIL_DIGITS, valid=_shape("^[0-9]{10}$")),
    Detector("HEALTHCARE_NUMBER", HEALTH, "[0-9]{9}", core=TAIL_DIGITS, valid=_shape("^[0-9]{9}$")),
    Detector("NUMERICAL_PII", TOKEN, "[0-9]{8}", valid=_shape("^[0-9]{8}$")),
    Detector("LOCATION_ZIP", ZIP, "[0-9]{4} ?[A-Z]{2}", valid=_shape("^[1-9][0-9]{3} ?[A-Z]{2}$")),
    Detector("LOCATION_COORDINATE", COORDINATE, "\\.[0-9]{3,}, ?-?[0-9]", valid=coordinate),
    Detector("VEHICLE_ID", DASHED, "-[0-9A-Z]{1,3}-",
             valid=lambda t: t.rlike(PLATE_SHAPE) & t.rlike("[A-Z]") & t.rlike("[0-9]") & (F.length(t) == 8)),
]


def _none() -> Column:
    return F.array().cast(ENTITIES)


SENTINEL = "\u0001"


def _cut(text: Column, pattern: str) -> Column:
    """Gaps at even and matches at odd places: one search brackets every match with a sentinel."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{SENTINEL}$1{SENTINEL}"), SENTINEL)


def _placed(pieces: Column) -> Column:
    """(start, match) of the odd pieces; running lengths give the starts."""

    def place(starts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
            lambda k: F.struct(F.get(starts, k).alias("start"), F.get(pieces, k).alias("match")),
        )

    empty = F.array().cast("array<struct<start:int,match:string>>")
    return F.when(F.size(pieces) < 3, empty).otherwise(
        let(prefix_sums(F.transform(pieces, lambda x: F.length(x))), place)
    )


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their start. The text must not hold the sentinel."""
    return let(_cut(text, pattern), _placed)


def without_sentinel(text: Column) -> Column:
    """Same length, no sentinel."""
    return F.when(F.contains(text, F.lit(SENTINEL)), F.translate(text, SENTINEL, " ")).otherwise(text)


def _entities(found: Column, d: Detector) -> Column:
    def entity(x: Column) -> Column:
        whole = x["match"]
        core = whole if d.core is None else F.regexp_extract(whole, d.core, 0)
        shift = F.lit(0) if d.core is None else F.length(whole) - F.length(core)
        start = x["start"] + shift
        return F.struct(
            start.alias("start"), (start + F.length(core)).alias("end"), F.lit(d.type).alias("type"),
            core.alias("entity"), F.lit(False).alias("public"),
        )

    out = F.transform(found, entity)
    return out if d.valid is None else F.filter(out, lambda e: d.valid(e["entity"]))


# Every entity holds a digit, an at sign or a colon. A match goes on from one for the rest of
# its word and, after one blank, the next word at most, and begins in its word or, with a
# keyword, fewer than REACH characters before it. No pattern crosses a line. Between two such
# places everything but those surroundings can be a line break.
LIVE, BLANK, REACH = "0-9@:", " \\t\\r\\n", 40
DULL = (
    f"(?<![^{LIVE}])([^{BLANK}{LIVE}]*+(?: [^{BLANK}{LIVE}]*+)?+)"
    f"([{BLANK}][^{LIVE}]*)(?=[{BLANK}][^{LIVE}]{{{REACH}}})"
)
# Searches for which shortening the text pays.
MANY = 4


def _shortened(clean: Column) -> Column:
    """What stays of the text at even places and the dull passages between at odd ones."""
    return F.split(F.regexp_replace(clean, DULL, f"$1{SENTINEL}$2{SENTINEL}"), SENTINEL)


def _moved_back(found: Column, pieces: Column) -> Column:
    """Entities of the shortened text, at their places in the whole one."""
    kept, dull = F.filter(pieces, lambda _, i: i % 2 == 0), F.filter(pieces, lambda _, i: i % 2 == 1)

    def move(starts: Column, shifts: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << i) for i in reversed(range(30))]), lambda s: s < F.size(starts))

        def back(e: Column) -> Column:
            piece = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(starts, at + s) <= e["start"], at + s).otherwise(at))
            return let(
                F.get(shifts, piece),
                lambda n: F.struct(
                    (e["start"] + n).alias("start"), (e["end"] + n).alias("end"), e["type"].alias("type"),
                    e["entity"].alias("entity"), e["public"].alias("public"),
                ),
            )

        return F.transform(found, back)

    return let(
        F.struct(
            prefix_sums(F.transform(kept, lambda x: F.length(x) + 1)).alias("starts"),
            prefix_sums(F.concat(F.transform(dull, lambda x: F.length(x) - 1), F.array(F.lit(0)))).alias("shifts"),
        ),
        lambda m: move(m["starts"], m["shifts"]),
    ).cast(ENTITIES)


def detect(text: Column, types: list[str] | None = None) -> Column:
    """All candidate entities of the wanted types; they may overlap.

    Detectors with one pattern share one search. Many of them search a text from
    which the passages are left out that cannot hold an entity.
    """
    wanted = [d for d in DETECTORS if types is None or d.type in types]
    if not wanted:
        return _none()
    clean = without_sentinel(text)
    if len({d.pattern for d in wanted}) < MANY:
        return _found(clean, wanted)

    def search(pieces: Column) -> Column:
        short = F.array_join(F.filter(pieces, lambda _, i: i % 2 == 0), "\n")
        return let(
            let(short, lambda s: _found(s, wanted)),
            lambda found: F.when((F.size(pieces) < 3) | (F.size(found) == 0), found).otherwise(_moved_back(found, pieces)),
        )

    return let(_shortened(clean), search)


def _found(clean: Column, wanted: list[Detector]) -> Column:
    patterns = list(dict.fromkeys(d.pattern for d in wanted))
    cuts = []
    for pattern in patterns:
        gate = clean.rlike("|".join(f"(?:{d.gate})" for d in wanted if d.pattern == pattern))
        cuts.append(F.when(gate, _cut(clean, pattern)).otherwise(F.array().cast("array<string>")))
    # One expression places the matches of all patterns.
    return let(
        F.transform(F.array(*cuts), _placed),
        lambda found: F.array_sort(
            F.concat(*[_entities(F.get(found, F.lit(patterns.index(d.pattern))), d) for d in wanted]).cast(ENTITIES)
        ),
    )


def gazetteer_matches(
    df: DataFrame, terms: DataFrame, id_col: str = "id", text: str = "text", max_words: int = 3
) -> DataFrame:
    """(id, entities) for token runs found in a term table (term, type, public), as a join.

    The shuffled way, for terms of up to ``max_words`` words and lists too long for the
    disks of workers. ``id_col`` must tell rows apart. Runs that cannot be a term, by a
    filter of bounded size, stay where they are; hot runs are salted; only matches are
    regrouped by id.
    """
    spotted = likely_runs(df, terms, id_col, without_sentinel(F.col(text)), max_words)
    # Counted and joined, so written.
    runs_ = materialize(spotted, "runs")
    found = salted_join(runs_, terms, ["term"], [id_col, "start"])
    entity = F.struct("start", "end", "type", F.col("term").alias("entity"), "public").cast(ENTITY)
    return found.groupBy(id_col).agg(F.array_sort(F.collect_list(entity)).alias("entities"))


def with_entities(
    df: DataFrame, text: str = "text", types: list[str] | None = None,
    terms: DataFrame | None = None, id_col: str = "id",
) -> DataFrame:
    """Add ``entities``: resolved, non-overlapping."""
    found = detect(F.col(text), types)
    if terms is not None:
        if "public" not in terms.columns:
            terms = terms.withColumn("public", F.lit(False))
        df = df.withColumn("_listed", listed_entities(F.col(text), terms))
        found = F.concat(found, F.coalesce("_listed", _none()))
    return (
        df.withColumn("_found", found)
        .withColumn("entities", resolve_overlaps(F.col("_found"), F.col(text)))
        .drop("_listed", "_found")
    )


# Entities ------------------------------------------------------------------


def _rank(type_: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in PII_PRECEDENCE]), type_).cast("int")


def resolve_overlaps(candidates: Column, text: Column) -> Column:
    """One entity per character span.

    Overlapping candidates are fused into the span that covers them all, so
    nothing found stays visible. The type is that of the longest candidate,
    then by precedence, then by position.
    """

    def fuse(group: Column) -> Column:
        best = F.array_min(
            F.transform(
                group,
                lambda e: F.struct(
                    (e["start"] - e["end"]).alias("n"), _rank(e["type"]).alias("r"), e["start"].alias("s"),
                    e["type"].alias("type"), e["public"].alias("public"), e["entity"].alias("entity"),
                ),
            )
        )
        start = F.array_min(F.transform(group, lambda e: e["start"]))
        end = F.array_max(F.transform(group, lambda e: e["end"]))

        def build(b: Column) -> Column:
            whole = end - start == -b["n"]
            return F.struct(
                start.alias("start"), end.alias("end"), b["type"].alias("type"),
                F.when(whole, b["entity"]).otherwise(F.substring(text, start + 1, end - start)).alias("entity"),
                (b["public"] & whole).alias("public"),
            )

        return let(best, build)

    def islands(c: Column) -> Column:
        reach = prefix_scan(F.transform(c, lambda e: e["end"]), F.lit(0), lambda a, x: F.greatest(a, x))
        tagged = F.zip_with(c, reach, lambda e, r: F.struct(e.alias("e"), r.alias("reach")))
        groups = runs(tagged, lambda _, x: x["e"]["start"] < x["reach"])
        return F.transform(groups, lambda g: fuse(F.transform(g, lambda x: x["e"])))

    return let(
        candidates, lambda c: F.when(F.size(c) < 2, c).otherwise(islands(F.array_sort(c)))
    ).cast(ENTITIES)


def flag_public(entities: Column, figures: list[str]) -> Column:
    """Mark entities that name a public figure; the list must stay short."""
    if len(figures) > MAX_FIGURES:
        raise ValueError("a long list of figures belongs in the term table (column public)")
    names = F.from_json(F.lit(json.dumps(figures)), "array<string>")
    return F.transform(
        entities,
        lambda e: F.struct(
            e["start"].alias("start"), e["end"].alias("end"), e["type"].alias("type"), e["entity"].alias("entity"),
            (e["public"] | (e["type"].startswith("NAME") & F.array_contains(names, e["entity"]))).alias("public"),
        ),
    )


def group_entities(entities: Column, window: int = 4500) -> Column:
    """Number the distinct entities of each type in a document by first mention.

    Mentions of the same text farther apart than ``window`` characters are
    different entities.
    """

    def near(a: Column, b: Column) -> Column:
        return (a["type"] == b["type"]) & (a["entity"] == b["entity"]) & (b["start"] - a["end"] <= window)

    by_text = F.array_sort(
        F.transform(
            entities,
            lambda e: F.struct(
                e["type"].alias("type"), e["entity"].alias("entity"), e["start"].alias("start"),
                e["end"].alias("end"), e["public"].alias("public"),
            ),
        )
    )
    heads = F.array_sort(
        F.transform(
            runs(by_text, near),
            lambda g: F.struct(
                F.get(g, F.lit(0))["type"].alias("type"), F.get(g, F.lit(0))["start"].alias("first"), g.alias("members")
            ),
        )
    )
    numbered = F.flatten(
        F.transform(
            runs(heads, lambda a, b: a["type"] == b["type"]),
            lambda t: F.flatten(
                F.transform(
                    t,
                    lambda h, k: F.transform(
                        h["members"],
                        lambda m: F.struct(
                            m["start"].alias("start"), m["end"].alias("end"), m["type"].alias("type"),
                            m["entity"].alias("entity"), m["public"].alias("public"), (k + 1).alias("no"),
                        ),
                    ),
                )
            ),
        )
    )
    empty = F.array().cast(GROUPED)
    return F.when(F.size(entities) > 0, F.array_sort(numbered)).otherwise(empty).cast(GROUPED)


# Replacement ---------------------------------------------------------------


def replace_entities(text: Column, entities: Column, replacement: Callable[[Column], Column]) -> Column:
    """Rebuild the text around sorted, non-overlapping entities; public ones stay.

    Pieces are cut from fixed blocks, so the cost grows with the text and not
    with text length times entities.
    """

    def rebuild(blocks: Column, e: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK_CHARS).cast("int")
            last = F.floor((end - 1) / BLOCK_CHARS).cast("int")
            around = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            cut = F.substring(around, start % BLOCK_CHARS + 1, end - start)
            return F.when(end > start, cut).otherwise(F.lit(""))

        before = F.transform(
            e,
            lambda x, i: F.concat(
                piece(F.when(i == 0, 0).otherwise(F.get(e, i - 1)["end"]), x["start"]), replacement(x)
            ),
        )
        last_end = F.element_at(e, -1)["end"]
        return F.concat(F.array_join(before, ""), piece(last_end, F.length(text)))

    masked = let(
        F.filter(entities, lambda e: ~e["public"]),
        lambda e: F.when(F.size(e) == 0, text).otherwise(
            let(char_blocks(text, BLOCK_CHARS), lambda blocks: rebuild(blocks, e))
        ),
    )
    return masked


def mask_markers(text: Column, grouped: Column) -> Column:
    """[TYPE_k], the same k for every mention of an entity in the document."""
    return replace_entities(
        text, grouped, lambda e: F.concat(F.lit("["), e["type"], F.lit("_"), e["no"].cast("string"), F.lit("]"))
    )


def synthetic_value(seed: Column, type_: Column, locale: str) -> Column:
    """A value in the shape of the type, drawn by the seed (a bigint) alone."""
    terms = LOCALE_TERMS[locale]

    def draw(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(n))

    def pick(salt: int, items: list[str]) -> Column:
        return F.get(F.array(*[F.lit(x) for x in items]), draw(salt, len(items)).cast("int"))

    def digits(salt: int, n: int) -> Column:
        return F.lpad(draw(salt, 10**n).cast("string"), n, "0")

    def letters(salt: int, n: int, alphabet: str) -> Column:
        return F.concat(*[pick(salt + 100 * k, list(alphabet)) for k in range(n)])

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def decimal(salt: int, low: float, span: float) -> Column:
        return F.format_string("%.4f", F.lit(low) + draw(salt, 10_000) / 10_000.0 * span)

    given, family, word = (lambda s: pick(s, terms["given"])), (lambda s: pick(s, terms["family"])), (lambda s: pick(s, terms["word"]))
    street = text(pick(1, terms["street"]), " ", (draw(2, 199) + 1).cast("string"))
    zip_code = text((draw(3, 9000) + 1000).cast("string"), " ", letters(4, 2, "BCDFGHJKLMNPRSTVWXZ"))
    name = text(given(5), " ", family(6))
    shapes = {
        "DRIVER_LICENSE": digits(1, 10),
        "EMAIL_ADDRESS": text(F.lower(given(1)), ".", F.lower(F.replace(family(2), F.lit(" "), F.lit(""))), "@example.", pick(3, ["com", "net", "org"])),
        "HEALTHCARE_NUMBER": digits(1, 9),
        "IP_ADDRESS": text("10.", draw(1, 256).cast("string"), ".", draw(2, 256).cast("string"), ".", draw(3, 256).cast("string")),
        "LOCATION_ADDRESS": text(street, ", ", zip_code, " ", pick(7, terms["town"])),
        "LOCATION_ADDRESS_STREET": street,
        "LOCATION_COORDINATE": text(decimal(1, 50.75, 2.75), ", ", decimal(2, 3.36, 3.85)),
        "LOCATION_ZIP": zip_code,
        "NAME": name,
        "NAME_FAMILY": family(6),
        "NAME_GIVEN": given(5),
        "NAME_MEDICAL_PROFESSIONAL": text("Dr. ", name),
        "PASSPORT_NUMBER": text(letters(1, 2, "ABCDEFGHJKLMNPRSTUVWXYZ"), letters(2, 5, "ABCDEFGHJKLMNPRSTUVWXYZ123456789"), digits(3, 1)),
        "PHONE_NUMBER": text("+31 6 ", digits(1, 8)),
        "SSN": digits(1, 9),
        "VEHICLE_ID": text(letters(1, 2, "BDFGHJKLNPRSTVXZ"), "-", digits(2, 3), "-", letters(3, 1, "BDFGHJKLNPRSTVXZ")),
        "BANK_ACCOUNT": text("NL", digits(1, 2), "BANK", digits(2, 10)),
        "CREDIT_CARD": text("4", digits(1, 15)),
        "CREDIT_CARD_EXPIRATION": text(F.lpad((draw(1, 12) + 1).cast("string"), 2, "0"), "/", digits(2, 2)),
        "CVV": digits(1, 3),
        "NUMERICAL_PII": digits(1, 8),
        "URL": text("https://", word(1), "-", word(2), "-", word(3), ".", pick(4, ["nl", "com", "net", "org"]), "/", word(5), "/", word(6)),
        "USERNAME": text(word(1), "_", word(2), digits(3, 4)),
    }
    out = F.lit(None).cast("string")
    for name_, value in shapes.items():
        out = F.when(type_ == name_, value).otherwise(out)
    return F.coalesce(out, F.concat(F.lit("["), type_, F.lit("]")))


def mask_synthetic(
    text: Column, grouped: Column, id_: Column, chance: float = 1.0, locale: str = "nl-NL"
) -> Column:
    """Replace entities by type-shaped values; beyond ``chance`` a plain marker is left.

    The draw depends on document id, type and entity, so re-runs agree.
    """

    def replacement(e: Column) -> Column:
        seed = F.xxhash64(id_, e["type"], e["entity"], e["no"])
        drawn = F.pmod(F.xxhash64(seed, F.lit("chance")), F.lit(1_000_000)) < int(chance * 1_000_000)
        marker = F.concat(F.lit("["), e["type"], F.lit("_"), e["no"].cast("string"), F.lit("]"))
        return let(seed, lambda s: F.when(drawn, synthetic_value(s, e["type"], locale)).otherwise(marker))

    return replace_entities(text, grouped, replacement)


def pii_summary(entities: Column, record_processed: bool = True) -> Column:
    """Struct of six sorted lists: types, entities left in place, entities processed, with counts."""

    def counted(values: Column, name: str, counts: str) -> list[Column]:
        groups = runs(F.array_sort(values), lambda a, b: a == b)
        return [
            F.transform(groups, lambda g: F.get(g, F.lit(0))).cast("array<string>").alias(name),
            F.transform(groups, lambda g: F.size(g).cast("long")).cast("array<bigint>").alias(counts),
        ]

    def texts(public: bool) -> Column:
        kept = F.filter(entities, lambda e: e["public"] if public else ~e["public"])
        return F.transform(kept, lambda e: e["entity"])

    types = F.transform(F.filter(entities, lambda e: ~e["public"]), lambda e: e["type"])
    processed = texts(False) if record_processed else F.array().cast("array<string>")
    return F.struct(
        *counted(types, "entity_types", "entity_type_counts"),
        *counted(texts(True), "not_removed_entities", "not_removed_entity_counts"),
        *counted(processed, "processed_entities", "processed_entity_counts"),
    )


def mask_documents(
    df: DataFrame,
    text: str = "text",
    id_col: str = "id",
    replacement_type: str = "SYNTHETIC",
    entity_grouping_window: int = 4500,
    check_public_figure: bool = True,
    record_processed_entities: bool = True,
    synthetic_replacement_chance: float = 1.0,
    synthetic_replacement_locale: str = "nl-NL",
    types: list[str] | None = None,
    terms: DataFrame | None = None,
    figures: list[str] | None = None,
) -> DataFrame:
    """Detect, resolve, group, replace and summarise; adds the column PII."""
    df = with_entities(df, text, types, terms, id_col)
    entities = F.col("entities")
    if not check_public_figure:
        entities = F.transform(
            entities,
            lambda e: F.struct(
                e["start"].alias("start"), e["end"].alias("end"), e["type"].alias("type"),
                e["entity"].alias("entity"), F.lit(False).alias("public"),
            ),
        )
    elif figures:
        entities = flag_public(entities, figures)
    df = df.withColumn("_grouped", group_entities(entities, entity_grouping_window))
    if replacement_type == "MARKER":
        masked = mask_markers(F.col(text), F.col("_grouped"))
    elif replacement_type == "SYNTHETIC":
        masked = mask_synthetic(
            F.col(text), F.col("_grouped"), F.col(id_col), synthetic_replacement_chance, synthetic_replacement_locale
        )
    else:
        raise ValueError("replacement_type is MARKER or SYNTHETIC")
    return (
        df.withColumn("_masked", masked)
        .withColumn("PII", pii_summary(F.col("_grouped"), record_processed_entities))
        .withColumn(text, F.col("_masked"))
        .drop("_masked", "_grouped", "entities")
    )
