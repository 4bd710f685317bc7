"""Row addresses in files, and scans that leave out addressed rows by a bitmap.

A row of a Parquet scan is named by its file and its place in it, which stay the
same however often the files are read. Steps that have to tell rows apart can
therefore work on addresses alone: nothing is written again to number rows, and
texts never travel. Rows to drop become bitmaps, 64 rows to a word; the next
scan tests its own addresses against them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.session import materialize

ADDRESS = "struct<file:bigint,row:bigint>"
# Nodes above a file relation that keep every row what it is.
_PLAIN = {"Project", "Filter", "SubqueryAlias", "View"}
# Words sent to all tasks: 16 bytes for up to 64 dropped rows of a file.
MOST_WORDS = 4_000_000


def is_scan(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of a Parquet file, read in place, and the same whenever it is read."""
    node = df._jdf.queryExecution().analyzed()
    if not node.deterministic():
        return False
    while node.nodeName() in _PLAIN:
        node = node.children().apply(0)
    if node.nodeName() != "LogicalRelation" or not node.children().isEmpty():
        return False
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except Exception as error:
        # Hidden by a column of that name, or a format without row numbers.
        if type(error).__name__ != "AnalysisException":
            raise
        return False
    return True


def address() -> Column:
    """The file (its path as a 64-bit hash) and the place of a scanned row."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def bitmap_words(gone: DataFrame, key: str) -> DataFrame:
    """(file, word, bits) of rows with an address in ``key``: bit i of word w is row 64 w + i."""
    file, row = F.col(f"{key}.file"), F.col(f"{key}.row")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (row % 64).cast("int"))
    return gone.groupBy(file.alias("_file"), F.floor(row / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def split_by_bitmap(rows: DataFrame, gone: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with an address in ``key`` that are not in ``gone`` (key), and those that are.

    The bitmaps go to every task while they have at most MOST_WORDS words. Beyond
    that the planner joins them as it sees fit, which may move the rows.
    """
    words = materialize(bitmap_words(gone, key), "bitmap")
    small = words.limit(MOST_WORDS + 1).count() <= MOST_WORDS
    side = F.broadcast(words) if small else words
    marked = rows.join(
        side, (F.col(f"{key}.file") == F.col("_file")) & (F.floor(F.col(f"{key}.row") / 64) == F.col("_word")), "left"
    )
    bit = F.call_function("shiftright", "_bits", (F.col(f"{key}.row") % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    marked = marked.withColumn("_gone", F.coalesce(bit, F.lit(0).cast("long")) == 1)
    mine = ["_file", "_word", "_bits", "_gone"]
    return marked.where("not _gone").drop(*mine), marked.where("_gone").drop(*mine)
