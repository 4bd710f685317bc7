"""Chains of stages described by a plain dictionary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from textmill.operators.filters import Outcome, outcome
from textmill.operators.stats import observed_counts
from textmill.plans import stages as s
from textmill.sources.reader import balance, read_documents, read_paths_file, scan_skip_limit
from textmill.sources.writer import (
    REMOVED_FILE_BYTES,
    SPLIT_FILE_BYTES,
    STAGE_FILE_BYTES,
    overwrite_stage,
    tee_write,
    write_removed,
)

STAGES = {
    "data_splitting": s.data_splitting,
    "string_normalization": s.string_normalization,
    "heuristic_filtering": s.heuristic_filtering,
    "pii_masking": s.pii_masking,
    "deduplication": s.deduplication,
    "toxic_language_detection": s.toxic_language_detection,
    "machine_translation": s.machine_translation,
    "llm_processing": s.llm_processing,
}


@dataclass
class ChainResult:
    kept: DataFrame
    removed: dict[str, DataFrame] = field(default_factory=dict)
    # Per written stage: total, forwarded, and removed rows per (module, reason), counted in the pass that wrote it.
    counters: dict[str, dict] = field(default_factory=dict)


# Keys of a step that say how its input is read and its output written; all others are the stage's own.
READ_KEYS = ("glob", "recursive", "text_key", "id_key")
FILE_KEYS = ("input_folder", "paths_file", "skip", "limit", "output_folder", "max_file_bytes", "removed_file_bytes")
FILE_BYTES = {"data_splitting": SPLIT_FILE_BYTES, "deduplication": REMOVED_FILE_BYTES}


def faults(config: dict) -> list[str]:
    """Everything that keeps a configuration from running, one line per fault."""
    steps = config.get("stages") or []
    found = [] if steps else ["no stages given"]
    for at, step in enumerate(steps, 1):
        if step.get("stage") not in STAGES:
            found.append(f"step {at} asks for {step.get('stage')!r}; there are {', '.join(sorted(STAGES))}")
        own_input = step.get("input_folder") or step.get("paths_file")
        if at > 1 and not own_input and not config.get("input_from_previous_output", True):
            found.append(f"step {at} has nothing to read: previous output is off and it names no input")
    return found


def read_step(spark: SparkSession, step: dict, df: DataFrame | None) -> DataFrame | None:
    """The input of a step: its own folder or list of files, else the rows before it."""
    if step.get("paths_file"):
        df = read_paths_file(spark, step["paths_file"], step.get("input_folder", ""))
    elif step.get("input_folder"):
        df = read_documents(spark, step["input_folder"], **{k: step[k] for k in READ_KEYS if k in step})
    if df is not None and ("skip" in step or "limit" in step):
        ids = step.get("id_key") if step.get("id_key") in df.columns else "id"
        df = scan_skip_limit(df, step.get("skip", 0), step.get("limit", -1), ids)
    return df


def curation_chain(spark: SparkSession, config: dict, source: DataFrame | None = None) -> ChainResult:
    """Run the stages in order, each on the kept rows of the one before.

    A stage may name an ``input_folder`` or ``paths_file`` (it wins over the
    previous output), with skip, limit and reader options, and an
    ``output_folder``; only then is its border written, rejects included, and
    the next stage reads the files. Everything else stays one lazy plan.
    """
    wrong = faults(config)
    if wrong:
        raise ValueError("; ".join(wrong))
    result = ChainResult(source)
    for at, step in enumerate(config["stages"]):
        params = {k: v for k, v in step.items() if k != "stage" and k not in FILE_KEYS and (k not in READ_KEYS or k == "id_key")}
        if step["stage"] != "data_splitting":
            params.pop("id_key", None)
        reading = {k: v for k, v in step.items() if k != "id_key"} if step["stage"] == "data_splitting" else step
        df = read_step(spark, reading, result.kept)
        if df is None:
            raise ValueError("the first step has no input and no source was given")
        if at == 0 or step.get("input_folder") or step.get("paths_file"):
            df = balance(df)
        done: Outcome = STAGES[step["stage"]](df, **params)
        folder, name, counted = step.get("output_folder"), f"{at + 1}_{step['stage']}", None
        if folder and done.annotated is not None:
            # Both outputs are written, so the verdicts are computed once, counted and kept.
            observed, counted = observed_counts(done.annotated, name)
            done = outcome(tee_write(observed))
        elif folder:
            observed, counted = observed_counts(done.kept, name)
            done = Outcome(observed, done.removed)
        result.removed[name] = done.removed
        result.kept = done.kept
        if folder:
            size = step.get("max_file_bytes", FILE_BYTES.get(step["stage"], STAGE_FILE_BYTES))
            overwrite_stage(done.kept, folder, size)
            write_removed(done.removed, f"{folder.rstrip('/')}_removed", step.get("removed_file_bytes", REMOVED_FILE_BYTES))
            result.counters[name] = counted()
            result.kept = read_documents(spark, folder)
    return result
