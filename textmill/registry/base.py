"""Named queries over the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.sources.reader import balance

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """documents with doc_id as id."""
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "id")


def busy_docs(spark: SparkSession, sf: str) -> DataFrame:
    """documents for work that is heavy per row."""
    return balance(docs(spark, sf))


def r6(col, name: str):
    return F.round(col, 6).alias(name)


# SQL fragments -------------------------------------------------------------


def words_sql(text: str = "text") -> str:
    return rf"list_filter(string_split_regex({text}, '[ \t\r\n]+'), lambda w: w <> '')"


def lines_sql(text: str = "text") -> str:
    return rf"list_filter(string_split_regex({text}, '\n'), lambda x: regexp_matches(x, '[^ \t\r\n]'))"


def paragraphs_sql(text: str = "text") -> str:
    return rf"list_filter(string_split_regex({text}, '\n{{2,}}'), lambda x: regexp_matches(x, '[^ \t\r\n]'))"


def ratio_sql(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part})::DOUBLE / ({whole})::DOUBLE ELSE 0.0::DOUBLE END"


DOCS = "(SELECT doc_id AS id, text, lang, source, n_chars FROM documents)"

PARTS = f"""(SELECT *, length(text) AS n_char, {words_sql()} AS words, {lines_sql()} AS lines,
  {paragraphs_sql()} AS paras FROM {DOCS})"""
