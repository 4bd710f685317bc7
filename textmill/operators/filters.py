"""Row filters. Every filter annotates first: filter_module and filter_reason, null = kept.

Cheap in-row metrics only; no filter needs a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import count_where, let, total
from textmill.functions.fixed_values import STOP_WORDS
from textmill.functions.text import Parts, lengths, mean, median, ratio, words

REASONS = "reasons"
BULLET_LINE = "^[ \\t]*[•*-]"
ELLIPSIS_LINE = "(\\.\\.\\.|…)[ \\t\\r]*$"
SENTENCE_JUNK = r"(?U)([\d°]{3,})|(\.(\w{2,4}))|(\/\w+\/\w+)|(WorldCat)|(Wikikids)"


@dataclass(frozen=True)
class Outcome:
    """Both outputs of a filtering step."""

    kept: DataFrame
    removed: DataFrame
    # The rows with their verdict, where both outputs are cut from one table.
    annotated: DataFrame | None = None


def open_verdict(df: DataFrame) -> DataFrame:
    """Add empty filter columns unless an earlier filter already did."""
    missing = [c for c in ("filter_module", "filter_reason") if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing})


def annotate(df: DataFrame, module: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Record the first failing rule of a module on rows no earlier module rejected."""
    df = open_verdict(df)
    if not rules:
        return df
    known = df.schema["filter_reason"].metadata.get(REASONS, [])
    reason = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules])
    fresh = F.col("filter_reason").isNull()
    # when() keeps the reason lazy: rejected rows skip the rule bodies.
    df = df.withColumn("filter_reason", F.when(fresh, reason).otherwise(F.col("filter_reason")))
    df = df.withColumn(
        "filter_module",
        F.when(F.col("filter_module").isNull() & F.col("filter_reason").isNotNull(), F.lit(module))
        .otherwise(F.col("filter_module")),
    )
    # The column itself says which reasons it can hold, for counters in the pass that writes it.
    return df.withMetadata("filter_reason", {REASONS: [*known, *(f"{module}:{name}" for name, _ in rules)]})


def outcome(df: DataFrame) -> Outcome:
    return Outcome(
        df.where(F.col("filter_reason").isNull()).drop("filter_module", "filter_reason"),
        df.where(F.col("filter_reason").isNotNull()),
        df,
    )


# Metrics -----------------------------------------------------------------


def digit_fraction(text: Column) -> Column:
    return ratio(F.length(F.regexp_replace(text, "[^0-9]+", "")), F.length(text))


def line_char_mean(p: Parts) -> Column:
    return mean(lengths(p.lines))


def line_char_median(p: Parts) -> Column:
    return median(lengths(p.lines))


def _line_words(p: Parts) -> Column:
    return F.transform(p.lines, lambda x: F.size(words(x)))


def line_word_mean(p: Parts) -> Column:
    return mean(_line_words(p))


def line_word_median(p: Parts) -> Column:
    return median(_line_words(p))


def word_count(p: Parts) -> Column:
    return F.size(p.words)


def mean_word_length(p: Parts) -> Column:
    return mean(lengths(p.words))


def hash_ratio(p: Parts) -> Column:
    return ratio(F.regexp_count(p.text, F.lit("#")), F.size(p.words))


def ellipsis_ratio(p: Parts) -> Column:
    return ratio(F.regexp_count(p.text, F.lit("\\.\\.\\.|…")), F.size(p.words))


def bullet_line_ratio(p: Parts) -> Column:
    return ratio(count_where(p.lines, lambda x: x.rlike(BULLET_LINE)), F.size(p.lines))


def ellipsis_line_ratio(p: Parts) -> Column:
    return ratio(count_where(p.lines, lambda x: x.rlike(ELLIPSIS_LINE)), F.size(p.lines))


def alpha_word_ratio(p: Parts) -> Column:
    return ratio(count_where(p.words, lambda w: w.rlike("\\p{L}")), F.size(p.words))


def stop_word_count(p: Parts, language: Column) -> Column:
    """Occurrences of the language's stop words; null for a language without a list."""
    lists = F.create_map(
        *[x for k, v in STOP_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    )
    # Looked up once, not for every word.
    count = let(F.try_element_at(lists, language), lambda wanted: count_where(p.words, lambda w: F.array_contains(wanted, F.lower(w))))
    return F.when(F.array_contains(F.array(*map(F.lit, STOP_WORDS)), language), count)


def dup_fraction(items: Column) -> Column:
    return ratio(F.size(items) - F.size(F.array_distinct(items)), F.size(items))


def dup_char_fraction(items: Column, text: Column) -> Column:
    repeated = total(lengths(items)) - total(lengths(F.array_distinct(items)))
    return ratio(repeated, F.length(text))


# Rule lists --------------------------------------------------------------


def _rule(rules: list, name: str, limit, failed) -> None:
    """A threshold of None switches a rule off."""
    if limit is not None:
        rules.append((name, failed(limit)))


def language_rules(languages: list[str], threshold: float | None = 0.65) -> list:
    col = F.coalesce(F.col("language"), F.lit(""))
    rules = [("language", ~col.isin(languages))]
    _rule(rules, "language_score", threshold, lambda t: F.coalesce(F.col("language_score"), F.lit(0.0)) < t)
    return rules


def language_filter(
    df: DataFrame, languages: list[str], threshold: float | None = 0.65, label_only: bool = False
) -> DataFrame:
    """Needs the columns language and language_score of the detector."""
    return annotate(df, "LanguageFilter", [] if label_only else language_rules(languages, threshold))


def nordic_rules(
    p: Parts,
    max_digit_fraction: float | None = 0.2,
    min_n_char: int | None = 50,
    min_mean_med_char: float | None = 9,
    min_mean_med_word: float | None = 2.1,
) -> list:
    rules: list = []
    _rule(rules, "max_digit_fraction", max_digit_fraction, lambda t: digit_fraction(p.text) > t)
    _rule(rules, "min_n_char", min_n_char, lambda t: p.n_char < t)
    _rule(rules, "min_mean_med_char", min_mean_med_char,
          lambda t: (line_char_mean(p) < t) | (line_char_median(p) < t))
    _rule(rules, "min_mean_med_word", min_mean_med_word,
          lambda t: let(_line_words(p), lambda n: (mean(n) < t) | (median(n) < t)))
    return rules


def quality_rules(
    p: Parts,
    language: Column,
    min_doc_words: int | None = None,
    max_doc_words: int | None = None,
    min_avg_word_length: float | None = None,
    max_avg_word_length: float | None = None,
    max_symbol_word_ratio: float | None = 0.1,
    max_bullet_lines_ratio: float | None = 0.9,
    max_ellipsis_lines_ratio: float | None = 0.3,
    max_non_alpha_words_ratio: float | None = 0.8,
    min_stop_words: int | None = 2,
) -> list:
    rules: list = []
    _rule(rules, "short_doc", min_doc_words, lambda t: word_count(p) < t)
    _rule(rules, "long_doc", max_doc_words, lambda t: word_count(p) > t)
    _rule(rules, "short_words", min_avg_word_length, lambda t: mean_word_length(p) < t)
    _rule(rules, "long_words", max_avg_word_length, lambda t: mean_word_length(p) > t)
    _rule(rules, "too_many_hashes", max_symbol_word_ratio, lambda t: hash_ratio(p) > t)
    _rule(rules, "too_many_ellipses", max_symbol_word_ratio, lambda t: ellipsis_ratio(p) > t)
    _rule(rules, "bullet_lines", max_bullet_lines_ratio, lambda t: bullet_line_ratio(p) > t)
    _rule(rules, "ellipsis_lines", max_ellipsis_lines_ratio, lambda t: ellipsis_line_ratio(p) > t)
    # Despite its name the limit is the least share of words with a letter.
    _rule(rules, "alpha_words", max_non_alpha_words_ratio, lambda t: alpha_word_ratio(p) < t)
    _rule(rules, "stop_words", min_stop_words, lambda t: stop_word_count(p, language) < t)
    return rules


def line_repetition_rules(
    p: Parts,
    dup_line_frac: float | None = 0.35,
    dup_para_frac: float | None = 0.35,
    dup_line_char_frac: float | None = 0.2,
    dup_para_char_frac: float | None = 0.2,
) -> list:
    rules: list = []
    _rule(rules, "dup_line_frac", dup_line_frac, lambda t: dup_fraction(p.lines) > t)
    _rule(rules, "dup_para_frac", dup_para_frac, lambda t: dup_fraction(p.paragraphs) > t)
    _rule(rules, "dup_line_char_frac", dup_line_char_frac, lambda t: dup_char_fraction(p.lines, p.text) > t)
    _rule(rules, "dup_para_char_frac", dup_para_char_frac,
          lambda t: dup_char_fraction(p.paragraphs, p.text) > t)
    return rules


# Field and pattern filters -----------------------------------------------


def extra_field_filter(
    df: DataFrame,
    field: str,
    allowed: list[str],
    raise_missing: bool = True,
    keep_missing: bool = False,
) -> DataFrame:
    """Keep rows whose JSON column ``extra`` has an allowed value in ``field``.

    A JSON null counts as present. Invalid JSON, and a missing field when
    ``raise_missing``, fail the job.
    """
    empty = F.coalesce(F.col("extra"), F.lit("")) == ""
    parsed = F.when(empty, F.lit("{}")).otherwise(F.col("extra"))
    keys = F.json_object_keys(parsed)
    checked = F.when(
        F.try_parse_json(parsed).isNull() | keys.isNull(),
        F.raise_error(F.concat(F.lit("extra is not a JSON object: "), parsed)).cast("boolean"),
    ).otherwise(F.array_contains(keys, field))
    value = F.try_variant_get(F.parse_json(parsed), f"$['{field}']", "string")
    # Only a JSON string can equal an allowed string; 1 is not "1".
    is_text = F.schema_of_variant(F.variant_get(F.parse_json(parsed), f"$['{field}']", "variant")) == "STRING"
    if raise_missing:
        absent = F.raise_error(F.lit(f"{field} not found in extra")).cast("boolean")
    else:
        absent = F.lit(not keep_missing)
    failed = F.when(checked, ~F.coalesce(is_text & value.isin(allowed), F.lit(False))).otherwise(absent)
    return annotate(df, "ExtraFieldFilter", [("extra_field", failed)])


def regex_filter(df: DataFrame, pattern: str = SENTENCE_JUNK, text: str = "text") -> DataFrame:
    """Reject rows in which the pattern occurs."""
    return annotate(df, "RegexFilter", [("regex", F.col(text).rlike(pattern))])
