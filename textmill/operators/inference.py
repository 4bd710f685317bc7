"""Batched inference with a user-supplied model, and the steps built on it.

A model is a factory: called once per Python worker, it returns a function from
a list of texts to a list of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from textmill.functions.arrays import char_blocks, let
from textmill.functions.text import words
from textmill.operators.skew import salted_join

Model = Callable[[list[str]], list[str]]
ModelFactory = Callable[[], Model]

CHUNK_SIZE = 1024
BATCH_SIZE = 32
WINDOW = 2048


def _run(model: Model, texts: list[str], batch_size: int, bucketed: bool = False) -> list[str]:
    """Answers in the order of the texts; bucketed batches hold texts of similar length."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i])) if bucketed else range(len(texts))
    out: list[str] = [""] * len(texts)
    for at in range(0, len(texts), batch_size):
        spots = order[at : at + batch_size]
        answers = model([texts[i] for i in spots])
        if len(answers) != len(spots):
            raise ValueError("the model must return one text per input")
        for i, answer in zip(spots, answers):
            out[i] = answer
    return out


def batched_inference(text: Column, factory: ModelFactory, batch_size: int = BATCH_SIZE) -> Column:
    """One answer per text. Only the text column crosses to Python."""

    @F.pandas_udf(StringType())
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for batch in batches:
            yield pd.Series(_run(model, batch.fillna("").tolist(), batch_size))

    return infer.asNondeterministic()(text)


def infer_chunks(chunks: str, factory: ModelFactory, batch_size: int = BATCH_SIZE) -> Column:
    """One answer per chunk of an array column; batches are filled across rows."""

    @F.pandas_udf(ArrayType(StringType()))
    def infer(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for rows, sizes in batches:
            flat = [text for row in rows for text in row]
            answers = iter(_run(model, flat, batch_size, bucketed=True))
            yield pd.Series([[next(answers) for _ in range(n)] for n in sizes])

    # Used twice, so the chunks stay a column and are not built inside the call.
    return infer.asNondeterministic()(F.col(chunks), F.size(chunks))


def apply_model(
    df: DataFrame, factory: ModelFactory, batch_size: int = BATCH_SIZE, text: str = "text", out: str | None = None
) -> DataFrame:
    return df.withColumn(out or text, batched_inference(F.col(text), factory, batch_size))


def bucketed_model(
    df: DataFrame, factory: ModelFactory, batch_size: int = BATCH_SIZE, text: str = "text", out: str | None = None,
    window: int = WINDOW, profile: ResourceProfile | None = None,
) -> DataFrame:
    """One answer per row, in batches of texts of similar length.

    Rows are looked at ``window`` at a time, in the partition's order, sorted by
    length for the model only and passed on in their order. A ``profile`` asks for
    executors with accelerators for this stage alone; all columns cross to Python then.
    """
    out = out or text
    others = [c for c in df.columns if c != out]
    schema = StructType([df.schema[c] for c in others] + [StructField(out, StringType())])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = factory(), [], 0

        def flush() -> pa.Table:
            table = pa.Table.from_batches(held)
            texts = [t or "" for t in table.column(text).to_pylist()]
            answers = pa.array(_run(model, texts, batch_size, bucketed=True), pa.string())
            return pa.table([*[table.column(c) for c in others], answers], names=[*others, out])

        for batch in batches:
            for first in range(0, batch.num_rows, window):
                held.append(batch.slice(first, window))
                size += held[-1].num_rows
                if size >= window:
                    yield from flush().to_batches()
                    held, size = [], 0
        if held:
            yield from flush().to_batches()

    return df.mapInArrow(answered, schema, profile=profile)


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame | None:
    """(key, answer) of all finished rounds, or nothing before the first one."""
    try:
        return spark.read.schema("key binary, answer string").parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ledgered_model(
    df: DataFrame, factory: ModelFactory, ledger: str, name: str, rounds: int = 8, batch_size: int = BATCH_SIZE,
    text: str = "text", out: str | None = None, profile: ResourceProfile | None = None,
) -> DataFrame:
    """One answer per row from a ledger of answers that outlives the job.

    Answers are keyed by the model's ``name`` and the text. Texts without an
    answer are inferred once each, in rounds by their keys; a round that has been
    written is never repeated, neither after a failure nor by a later job over
    other rows, so a restart loses one round at most.
    """
    spark = df.sparkSession
    key = F.unhex(F.sha2(F.concat_ws("\x00", F.lit(name), F.coalesce(F.col(text), F.lit(""))), 256))
    keyed = df.withColumn("_key", key)
    for i in range(rounds):
        todo = keyed.select(F.col("_key").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("prompt"))
        todo = todo.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == i)
        done = ledger_rows(spark, ledger)
        if done is not None:
            todo = todo.join(done.select("key"), "key", "left_anti")
        todo = todo.dropDuplicates(["key"])
        answers = bucketed_model(todo, factory, batch_size, "prompt", "answer", profile=profile)
        answers.select("key", "answer").write.mode("append").parquet(ledger)
    answers = ledger_rows(spark, ledger).dropDuplicates(["key"]).withColumnRenamed("key", "_key")
    out = out or text
    columns = df.columns if out in df.columns else [*df.columns, out]
    # Equal texts share a key; the rows of a hot one are spread by all that tells them apart.
    joined = salted_join(keyed, answers, ["_key"], df.columns)
    return joined.withColumn(out, F.col("answer")).select(*columns)


def chunks_of(text: Column, chunk_size: int = CHUNK_SIZE, chunk_mode: str = "characters") -> Column:
    """The chunks of a text: fixed numbers of characters, or of blank-separated tokens."""
    if chunk_mode == "characters":
        return char_blocks(text, chunk_size)
    if chunk_mode != "tokens":
        raise ValueError("chunk_mode is characters or tokens")
    return let(
        words(text),
        lambda w: F.when(
            F.size(w) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(w) - 1) / chunk_size).cast("int")),
                lambda i: F.array_join(F.slice(w, i * chunk_size + 1, chunk_size), " "),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def translate(
    df: DataFrame,
    factory: ModelFactory,
    chunk_size: int = CHUNK_SIZE,
    batch_size: int = BATCH_SIZE,
    chunk_mode: str = "characters",
    batch_stop_at: int | None = None,
    text: str = "text",
) -> DataFrame:
    """Chunk, infer, join. The chunks stay in their row, so nothing is regrouped.

    ``batch_stop_at`` keeps only the first chunks that fill that many batches
    per document, for trial runs.
    """
    chunks = chunks_of(F.col(text), chunk_size, chunk_mode)
    if batch_stop_at is not None:
        chunks = F.slice(chunks, 1, batch_stop_at * batch_size)
    glue = "" if chunk_mode == "characters" else " "
    return df.withColumn("_chunks", chunks).withColumn(
        text, F.array_join(infer_chunks("_chunks", factory, batch_size), glue)
    ).drop("_chunks")


def translate_dry_run(
    df: DataFrame,
    file_col: str,
    chunk_size: int = CHUNK_SIZE,
    batch_size: int = BATCH_SIZE,
    text: str = "text",
) -> DataFrame:
    """Chunks and batches a translation would take, per file; nothing is inferred."""
    n_chunks = F.ceil(F.length(text) / chunk_size)
    return (
        df.groupBy(file_col)
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(n_chunks).cast("long").alias("n_chunks"))
        .withColumn("n_batches", F.ceil(F.col("n_chunks") / batch_size).cast("long"))
    )


def fill_prompt(template: str, text: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{text}"), text)


def prompt_model(
    df: DataFrame, factory: ModelFactory, template: str, batch_size: int = BATCH_SIZE, text: str = "text"
) -> DataFrame:
    """Fill the template with the text and replace the text by the model's answer."""
    return df.withColumn(
        text, batched_inference(fill_prompt(template, F.col(text)), factory, batch_size)
    )
