"""Unicode, punctuation and white-space normalisation and regex clean-up."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from textmill.functions.arrays import let
from textmill.functions.fixed_values import PUNCTUATION_ONE_TO_ONE, PUNCTUATION_SPELLED_OUT

FORMS = ("NFC", "NFKC", "NFD", "NFKD")
# Three or more copies of a word. The repeated part is possessive, with its own word
# boundary: the engine then loops instead of recursing, whatever the number of copies.
REPEATED_WORDS = r"(?U)\b(\w+)\s+\1\s+\1\b(?:\s+\1\b)*+"
BRACKET_TAG = r"(?U)\s?\[[a-zA-Z&;_à-üÀ-Ü\s]{0,15}\]"
# What Windows-1252 shows for the bytes 0x80 to 0x9F, and those of its signs that stand behind words in right text.
WINDOWS_1252 = {bytes([b]).decode("cp1252"): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
TYPOGRAPHIC = "\u2018\u2019\u201a\u201c\u201d\u201e\u2013\u2014\u2026\u2022\u2039\u203a"
# Nothing below U+0300 and no general punctuation from U+2002 to U+20CF changes under NFC.
BEYOND_NFC = "[\\x{0300}-\\x{2001}\\x{20D0}-\\x{10FFFF}]"
SPACE_SIGNS = "[\\t\\r\\f\\x0B\\u00A0\\u1680\\u2000-\\u200A\\u202F\\u205F\\u3000]"


@lru_cache(maxsize=None)
def composing_signs() -> str:
    """A character class of everything NFC can change: by itself or as the second part of a composition."""
    points = set()
    for c in range(sys.maxunicode + 1):
        sign = chr(c)
        parts = unicodedata.decomposition(sign).split()
        if unicodedata.combining(sign) or not unicodedata.is_normalized("NFC", sign):
            points.add(c)
        if len(parts) == 2 and not parts[0].startswith("<"):
            points.add(int(parts[1], 16))
    # Hangul vowels and finals compose by rule, not by table.
    points |= {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    points -= {*range(0xD800, 0xE000)}
    out, ordered = "", sorted(points)
    for c in ordered:
        if c - 1 not in points:
            last = c
            while last + 1 in points:
                last += 1
            out += f"\\x{{{c:X}}}-\\x{{{last:X}}}"
    return f"[{out}]"


def unicode_normalize(text: Column, form: str = "NFC") -> Column:
    """Unicode normal form. Texts without any sign the form can change stay in the JVM."""
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, got {form}")

    # Arrow's own utf8_normalize leaves NFC and NFKC decomposed, so the standard library does the work.
    @F.pandas_udf(StringType())
    def normalized(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    # The UDF runs for every row of a batch, so untouched rows pass a null instead. The long class
    # is tried only on texts with a sign beyond those NFC never touches.
    may_change = text.rlike(BEYOND_NFC) & text.rlike(composing_signs()) if form == "NFC" else text.rlike("[^\\x00-\\x7F]")
    wide = F.when(may_change, text)
    return F.coalesce(normalized.asNondeterministic()(wide), text)


def _wrong_runs() -> str:
    """A pattern of maximal runs of characters that are UTF-8 bytes read as Latin-1 or Windows-1252.

    A run starts with a unit of three or four bytes, or with one for U+0080 to
    U+00FF that does not end in quotes, dashes or dots, or it has two units at
    least, not all of which end so. So a capital with an accent before real
    punctuation is no run.
    """
    follows = "".join(WINDOWS_1252)
    plain = "".join(c for c in WINDOWS_1252 if c not in TYPOGRAPHIC)
    cont, safe = f"[\\x80-\\xBF{follows}]", f"[\\x80-\\xBF{plain}]"
    # Behind other letters a no-break space or an angle quote says nothing either.
    typed, clear = f"[{TYPOGRAPHIC}\\xA0\\xAB\\xBB]", f"[\\x80-\\x9F\\xA1-\\xAA\\xAC-\\xBA\\xBC-\\xBF{plain}]"
    two, more = f"[\\xC2-\\xDF]{cont}", f"[\\xE0-\\xEF]{cont}{{2}}|[\\xF0-\\xF4]{cont}{{3}}"
    return f"(?:[\\xC2\\xC3]{safe}|{more})(?:{two}|{more})*+|(?=(?:[\\xC2-\\xDF]{typed})*+(?:[\\xC2-\\xDF]{clear}|{more}))(?:{two}|{more}){{2,}}+"


def _decode_runs(text: Column) -> Column:
    """Every wrong run replaced by what its bytes say, where they are valid UTF-8."""
    pattern = _wrong_runs()

    def decoded(run: Column) -> Column:
        latin = F.translate(run, "".join(WINDOWS_1252), "".join(chr(b) for b in WINDOWS_1252.values()))
        read = F.encode(latin, "ISO-8859-1").cast("string")
        return F.when(F.is_valid_utf8(read), read).otherwise(run)

    runs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), decoded)
    between = F.split(text, pattern, -1)
    whole = F.array_join(F.zip_with(between, runs, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(text.rlike(pattern), whole).otherwise(text)


def fix_mojibake(text: Column, rounds: int = 2) -> Column:
    """Undo UTF-8 read as Latin-1 or Windows-1252, run by run, beside text that is right.

    Every byte of a run is kept in what it decodes to, or the run stays.
    ``rounds`` is how often text may have been misread.
    """
    for _ in range(rounds):
        text = let(text, _decode_runs)
    return text


def normalize_punctuation(text: Column) -> Column:
    source = "".join(PUNCTUATION_ONE_TO_ONE)
    target = "".join(PUNCTUATION_ONE_TO_ONE.values())
    out = F.translate(text, source, target)
    for sign, spelled in PUNCTUATION_SPELLED_OUT.items():
        out = F.replace(out, F.lit(sign), F.lit(spelled))
    return out


def normalize_whitespace(text: Column) -> Column:
    """Every Unicode space becomes one blank; newlines stay."""
    return F.regexp_replace(text, SPACE_SIGNS, " ")


def collapse_repeated_words(text: Column) -> Column:
    return F.regexp_replace(text, REPEATED_WORDS, "$1")


def strip_bracket_tags(text: Column) -> Column:
    return F.regexp_replace(text, BRACKET_TAG, "")


def patch_newline_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " \n +", " \n")


def apply_patches(df: DataFrame, patches, text: str = "text") -> DataFrame:
    """Chain column functions over the text column."""
    out = F.col(text)
    for patch in patches:
        out = patch(out)
    return df.withColumn(text, out)


def with_changed_flag(df: DataFrame, normalizer, text: str = "text") -> DataFrame:
    """Replace the text by its normal form and flag rows that differ."""
    return (
        df.withColumn("_before", F.col(text))
        .withColumn(text, normalizer(F.col("_before")))
        .withColumn("changed", F.col(text) != F.col("_before"))
        .drop("_before")
    )
