"""A training corpus from documents, in stages that each write Parquet.

Toxic documents go, one document of each near-duplicate group stays, documents
with benchmark passages go, secrets are blanked out, and what is left is packed.

Defined results, for every stage
    Needed columns are doc_id and text; all others pass through all stages but the
    last, whatever their names. n_chars may be missing; if there, it follows a
    text that secrets were blanked out of.
    null and empty texts: not toxic, near copies of each other, without passages
    and secrets, packed as one end token. null ids stay null.
    Equal rows are one near-duplicate class, of which one row stays.
    Very long texts count whole. An empty table passes through, no pieces come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.llm import decontamination, near_dedup, packing, secrets, toxicity
from textmill.session import materialize


def apart(docs: DataFrame) -> DataFrame:
    """(rest, doc_id, text): other columns in one, so that an operator's own columns meet none of their names."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(F.struct(*(rest or [F.lit(0).alias("none")])).alias("rest"), "doc_id", "text")


def back(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of before, in their order."""
    named = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in columns} | changed
    return rows.select(*[named[c].alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of a model learned from the labels."""
    sample = toxicity.labelled_sample(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_texts(apart(docs), toxicity.fit_model(sample), out="score")
    return back(scored.where(F.col("score") < toxicity.THRESHOLD), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id."""
    classes = materialize(near_dedup.near_classes(docs.select("doc_id", "text")), "classes")
    return back(near_dedup.keep_one(apart(docs), classes), docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return back(decontamination.drop_contaminated(apart(docs), benchmark), docs.columns)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a marker; n_chars follows where there is one."""
    rows = apart(docs)
    found = secrets.findings(rows, secrets.update_ledger(rows.select("doc_id", "text")))
    new = F.when(F.size("secret_spans") > 0, secrets.redact(F.col("text"), F.col("secret_spans")))
    changed = {"text": F.coalesce(new, F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length(new).cast("long"), F.col("rest.n_chars"))
    return back(found, docs.columns, **changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secret_scans", blank_secrets),
    ("packing", pack),
]

# Fitted models, signatures, embeddings and tokenizers are beyond SQL; the tests
# follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
