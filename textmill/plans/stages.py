"""Curation stages: functions from DataFrame to an Outcome of kept and removed rows.

Stages only add to the plan. Nothing is written unless a chain asks for it, so
Catalyst optimises across stage borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions import normalize as norm
from textmill.functions.fixed_values import PARAGRAPH_PROMPT
from textmill.functions.text import drop_parts, with_parts
from textmill.operators import dedup, inference, perplexity as ppl, pii, toxicity
from textmill.operators.filters import (
    Outcome,
    annotate,
    extra_field_filter,
    language_filter,
    line_repetition_rules,
    nordic_rules,
    outcome,
    quality_rules,
    SENTENCE_JUNK,
    regex_filter,
)
from textmill.operators.language import LanguageModel
from textmill.operators.repetition import DUP_N_GRAMS, TOP_N_GRAMS, ngram_rules, with_ngram_fractions
from textmill.operators.rows import chunk_text, combine_rows, split_rows
from textmill.sources.reader import balance, expand_metadata, null_guard, rename_id
from textmill.sources.writer import tee_write

DEFAULT_LANGUAGES = ["en", "nl", "da", "sv", "af", "fy", "de"]


def _all_kept(df: DataFrame) -> Outcome:
    nothing = df.withColumns(
        {"filter_module": F.lit(None).cast("string"), "filter_reason": F.lit(None).cast("string")}
    ).where(F.lit(False))
    return Outcome(df, nothing)


def data_splitting(df: DataFrame, id_key: str = "extraction_uid", line_chunk_size: int | None = None) -> Outcome:
    """Take the id column, flatten metadata, guard nulls and cut long texts."""
    df = null_guard(expand_metadata(rename_id(df, id_key)))
    return _all_kept(chunk_text(df, line_chunk_size) if line_chunk_size is not None else df)


def string_normalization(df: DataFrame, normalization: str = "NFC", repair: bool = True) -> Outcome:
    """Mojibake repair and Unicode form, then punctuation, then white space."""
    if repair:
        # A column of its own: the Unicode form uses it several times, and it is to be computed once.
        df = df.withColumn("text", norm.fix_mojibake(F.col("text")))
    unicode_form = norm.unicode_normalize(F.col("text"), normalization)
    return _all_kept(df.withColumn("text", norm.normalize_whitespace(norm.normalize_punctuation(unicode_form))))


def annotate_heuristics(
    df: DataFrame,
    languages: list[str] = DEFAULT_LANGUAGES,
    language_threshold: float | None = 0.65,
    label_only: bool = False,
    model: LanguageModel | None = None,
    nordic: dict | None = None,
    quality: dict | None = None,
    repetition: dict | None = None,
    do_repetition_filter: bool = True,
) -> DataFrame:
    """Language, line-shape, quality and repetition rules; the first failure is recorded.

    Without a model the columns language and language_score must be there.
    n-grams are only built for rows that no earlier rule rejected.
    """
    if model is not None:
        df = model.detect(df)
    df, p = with_parts(df)
    df = language_filter(df, languages, language_threshold, label_only)
    df = annotate(df, "NordicPileQualityFilter", nordic_rules(p, **(nordic or {})))
    df = annotate(df, "GopherQualityFilter", quality_rules(p, F.col("language"), **(quality or {})))
    if do_repetition_filter:
        settings = dict(repetition or {})
        top = settings.pop("top_n_grams", TOP_N_GRAMS) or []
        dup = settings.pop("dup_n_grams", DUP_N_GRAMS) or []
        df = annotate(df, "GopherRepetitionFilter", line_repetition_rules(p, **settings))
        if top or dup:
            fresh = F.col("filter_reason").isNull()
            df = with_ngram_fractions(df, p, [n for n, _ in top], [n for n, _ in dup], fresh)
            df = annotate(df, "GopherRepetitionFilter", ngram_rules(top, dup))
            df = df.drop(*[f"top_{n}_gram" for n, _ in top], *[f"dup_{n}_gram" for n, _ in dup])
    return drop_parts(df)


def heuristic_filtering(df: DataFrame, **params) -> Outcome:
    return outcome(annotate_heuristics(df, **params))


def pii_masking(df: DataFrame, **params) -> Outcome:
    return _all_kept(pii.mask_documents(df, **params))


def deduplication(
    df: DataFrame,
    num_buckets: int = dedup.NUM_BUCKETS,
    hashes_per_bucket: int = dedup.HASHES_PER_BUCKET,
    n_grams: int = dedup.N_GRAMS,
    bit_precision: int = 64,
    id_col: str = "id",
) -> Outcome:
    """Exact copies and MinHash clusters; the row with the smallest id of each stays.

    Rows are told apart by keys, not by ids, so repeated ids do no harm. Digests
    and bands come from one pass over the texts, and from there on only keys and
    hashes travel. The rows of a file scan are keyed by their addresses: the
    input is read again at the end and tested against bitmaps of the rows to
    drop, so no text is written or sent. Other inputs are written once.
    """
    rows = dedup.keyed_rows(df, id_col)
    key = dedup.ROW_KEY
    # Small inputs are dealt out to all cores; larger ones are signed where they are read.
    texts = balance(rows.select(key, "text"))
    signed = dedup.signature(texts, num_buckets, hashes_per_bucket, n_grams, bit_precision)
    projected = tee_write(signed.select(key, F.unhex(F.sha2("text", 256)).alias("_digest"), "signature"))
    exact = dedup.exact_duplicate_keys(projected).withColumn("_why", F.lit("exact"))
    edges = dedup.minhash_buckets(projected, key, num_buckets, hashes_per_bucket)
    near = dedup.removable(dedup.cluster_components(edges), key).withColumn("_why", F.lit("minhash"))
    # A copy inside a cluster is reported once, as exact.
    gone = tee_write(exact.unionByName(near).groupBy(key).agg(F.min("_why").alias("_why")))
    kept, dropped = dedup.split_rows_by_key(rows, gone.select(key))
    alike, equal = dedup.split_rows_by_key(dropped, gone.where("_why = 'exact'").select(key))
    removed = equal.withColumn("filter_reason", F.lit("exact")).unionByName(alike.withColumn("filter_reason", F.lit("minhash")))
    return Outcome(kept.drop(key), removed.drop(key).withColumn("filter_module", F.lit("Deduplication")))


def toxic_language_detection(
    df: DataFrame, model: toxicity.ToxicityModel, threshold: float = 0.995, max_chunk_length: int = 256
) -> Outcome:
    return _all_kept(toxicity.toxic_spans(df, model, threshold, max_chunk_length))


def machine_translation(
    df: DataFrame,
    translator: inference.ModelFactory,
    model: LanguageModel,
    extra_field_name: str = "original_language",
    allowed_values: list[str] = ("en",),
    raise_when_field_missing: bool = True,
    keep_when_field_missing: bool = False,
    chunk_size: int = inference.CHUNK_SIZE,
    batch_size: int = inference.BATCH_SIZE,
    stop_at: int | None = None,
    languages: list[str] = ("nl",),
    language_threshold: float = 0.65,
    part_col: str | None = "chunk_idx",
    formatted_rows_path: str | None = None,
    id_col: str = "id",
    dry_run: bool = False,
    batch_stop_at: int | None = None,
    chunk_mode: str = "characters",
) -> Outcome:
    """Clean up, keep the wanted source language, translate, check the result, combine parts.

    The cleaned rows are written once (mid-plan copy) and the plan goes on from
    that copy. Where ``part_col`` exists the parts of a document are combined.
    ``dry_run`` only counts what would be translated; ``batch_stop_at`` ends each
    row after so many batches; ``chunk_mode`` is that of inference.translate.
    """
    cleaned = norm.apply_patches(df, [norm.collapse_repeated_words, norm.strip_bracket_tags])
    cleaned = tee_write(cleaned, formatted_rows_path)
    selected = extra_field_filter(
        cleaned, extra_field_name, list(allowed_values), raise_when_field_missing, keep_when_field_missing
    )
    wanted = outcome(selected)
    to_do = wanted.kept if stop_at is None else wanted.kept.orderBy(id_col).limit(stop_at)
    if dry_run:
        named = to_do if "filename" in to_do.columns else to_do.withColumn("filename", F.lit("all"))
        return Outcome(inference.translate_dry_run(named, "filename", chunk_size, batch_size), wanted.removed)
    translated = tee_write(inference.translate(to_do, translator, chunk_size, batch_size, chunk_mode, batch_stop_at))
    checked = outcome(language_filter(model.detect(translated), list(languages), language_threshold))
    kept = checked.kept
    if part_col is not None and part_col in kept.columns:
        kept = combine_rows(kept, id_col, part_col, "")
    return Outcome(kept, wanted.removed.unionByName(checked.removed, allowMissingColumns=True))


def llm_processing(
    df: DataFrame,
    generator: inference.ModelFactory,
    model: LanguageModel,
    prompt: str = PARAGRAPH_PROMPT,
    regex_exp: str | None = None,
    batch_size: int = 1000,
    languages: list[str] = ("nl", "en"),
    language_threshold: float = 0.65,
) -> Outcome:
    """Drop lines with junk, prompt the model with the others, check the language.

    Lines are dropped inside their row, so no text travels and rows with equal
    ids are never mixed; rows without any other line go. Rejected lines are
    reported one by one, numbered by part_idx.
    """
    pattern = regex_exp or SENTENCE_JUNK
    clean = F.filter(F.split("text", "\n"), lambda line: ~line.rlike(pattern))
    rejected = outcome(regex_filter(split_rows(df.where(F.col("text").rlike(pattern))), pattern)).removed
    joined = df.withColumn("_lines", clean).where(F.size("_lines") > 0)
    joined = joined.withColumn("text", F.array_join("_lines", "\n")).drop("_lines")
    answered = tee_write(inference.prompt_model(joined, generator, prompt, batch_size))
    checked = outcome(language_filter(model.detect(answered), list(languages), language_threshold))
    return Outcome(checked.kept, rejected.unionByName(checked.removed, allowMissingColumns=True))


def quality_analysis(
    df: DataFrame,
    id_col: str = "id",
    group: list[str] = ("language",),
    top_k: int = ppl.TOP_VALUES,
    fold: Column | None = None,
) -> dict[str, DataFrame]:
    """Perplexity per document, then the summary and histogram groups.

    Each fold of the rows (by a hash of the id, unless given) is scored under the
    exact counts of the other one.
    """
    group = list(group)
    fold = F.pmod(F.xxhash64(id_col), F.lit(2)) if fold is None else fold
    scored = tee_write(ppl.fold_perplexity(df, id_col, group, fold))
    return {
        "documents": scored,
        "summary": ppl.merge_stats(ppl.partial_stats(scored, group), group),
        "histogram": ppl.perplexity_histogram(scored, group, 0, top_k),
    }
