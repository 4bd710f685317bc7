import statistics
import unicodedata

import pytest
from pyspark.sql import functions as F

from textmill.functions import normalize as norm
from textmill.functions.arrays import char_blocks, prefix_scan, prefix_sums
from textmill.functions.text import lengths, lines, median, paragraphs, text_metrics, words

EDGE = [
    None, "", " ", "word", "\n\n", "a \n   b", "one\n\none", "\n".join(["- item"] * 10), "so...\nand...",
    "cafÃ©", "été", "\U0001f600 smile \U0001f600", "【x】━ “q”…",
    "één één één één", "Hoor [Muziek] dit", "ja " * 3000,
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(list(enumerate(EDGE)), "id long, text string")


def values(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


def test_pieces(edge):
    assert values(edge, words(F.col("text")))[5] == ["a", "b"]
    assert values(edge, F.size(lines(F.col("text"))))[7] == 10
    assert values(edge, paragraphs(F.col("text")))[6] == ["one", "one"]


def test_metrics_match_python(edge):
    for row in text_metrics(edge.where("text is not null")).collect():
        plain = [w for w in row.text.split() if any(c.isalnum() for c in w)]
        assert row.n_char == len(row.text)
        assert row.n_non_symbol_words == len(plain)
        assert row.avg_word_length == pytest.approx(statistics.mean(map(len, plain)) if plain else 0.0)


def test_median(spark):
    df = spark.createDataFrame([(0, [1]), (1, [3, 1]), (2, [5, 1, 9]), (3, [])], "id long, v array<int>")
    assert values(df, median(F.col("v"))) == [1.0, 2.0, 5.0, 0.0]


@pytest.mark.parametrize("form", ["NFC", "NFKC", "NFD", "NFKD"])
def test_unicode_forms(edge, form):
    got = values(edge, norm.unicode_normalize(F.col("text"), form))
    assert got == [None if t is None else unicodedata.normalize(form, t) for t in EDGE]


def misread(text, code):
    """UTF-8 bytes read in another code; Windows-1252 leaves five bytes as they are."""
    raw = text.encode()
    return "".join(bytes([b]).decode(code) if code == "latin-1" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in raw)


def test_mojibake(spark):
    right = ["caf\u00e9", "plain", "a \u2014 b", "\u201cna\u00efve\u201d \u2026", "\u00df\u00c9\u00c8", "\u6f22\u5b57 \U0001f600", "\u043f\u0440\u0438\u0432\u0435\u0442", ""]
    once = [(misread(t, code), t) for t in right for code in ("latin-1", "cp1252")]
    twice = [(misread(misread(t, "latin-1"), "latin-1"), t) for t in right[:5]]
    # Right text, with accents before quotes and dashes, and signs that are no valid bytes.
    stays = [(t, t) for t in [*right, "MANH\u00c3\u2014\u00c9\u201d S\u00c3O \u00c9\u2026", "\u00ab CAF\u00c9\u00bb", "\u00e9\u00e9\u00e9 \u00e0 l\u2019\u00c9t\u00e9", "\u00c3", "\u00c3 \u00a9"]]
    mixed = [(f"{a} caf\u00e9 \u2014 {m} \u00c9\u2026 {m}", f"{a} caf\u00e9 \u2014 {t} \u00c9\u2026 {t}") for a, (m, t) in zip(["\u00e9", "\u6f22", "x"] * 6, once)]
    long = [(misread("\u00e9" * 50_000, "latin-1"), "\u00e9" * 50_000)]
    cases = once + twice + stays + mixed + long
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate([*cases, (None, None)])], "id long, text string")
    assert values(df, norm.fix_mojibake(F.col("text"))) == [t for _, t in cases] + [None]


def test_formatting(edge):
    text = F.col("text")
    assert values(edge, norm.normalize_punctuation(text))[12] == '[x]- "q"...'
    assert values(edge, norm.collapse_repeated_words(text))[13] == "één"
    assert values(edge, norm.strip_bracket_tags(text))[14] == "Hoor dit"
    assert values(edge, norm.patch_newline_spaces(text))[5] == "a \nb"


@pytest.mark.parametrize(
    "step", [norm.unicode_normalize, norm.normalize_punctuation, norm.normalize_whitespace, norm.patch_newline_spaces,
             norm.collapse_repeated_words],
)
def test_idempotent(edge, step):
    once = edge.withColumn("text", step(F.col("text")))
    assert values(once, "text") == values(once.withColumn("text", step(F.col("text"))), "text")


def test_changed_flag(edge):
    flags = values(norm.with_changed_flag(edge.where("id > 8"), norm.unicode_normalize), "changed")
    assert flags[1] is True and flags[0] is False


def test_prefix_sums_across_blocks(spark):
    n = 100
    df = spark.createDataFrame([(0, list(range(n))), (1, []), (2, [7])], "id long, v array<int>")
    assert values(df, prefix_sums(F.col("v"))) == [[sum(range(i)) for i in range(n)], [], [0]]
    highest = prefix_scan(F.col("v"), F.lit(0), lambda a, x: F.greatest(a, x))
    assert values(df, highest)[0] == [max([0, *range(i)]) for i in range(n)]


def test_char_blocks_count_code_points(edge):
    blocks = values(edge.where("text is not null"), char_blocks(F.col("text"), 4))
    for text, got in zip([t for t in EDGE if t is not None], blocks):
        assert got == [text[i : i + 4] for i in range(0, len(text), 4)]
    assert values(edge.where("id = 11"), lengths(char_blocks(F.col("text"), 4)))[0] == [4, 4, 1]
