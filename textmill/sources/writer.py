"""Sinks: size-planned parquet, rejected rows, mid-plan copies, stage folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.session import materialize
from textmill.sources.rolling import reaches, write_rolling

STAGE_FILE_BYTES = 2**28
SPLIT_FILE_BYTES = 100_000_000
REMOVED_FILE_BYTES = 2**29


def write_sized(
    df: DataFrame,
    path: str,
    max_file_bytes: int = STAGE_FILE_BYTES,
    mode: str = "error",
    partition_by: list[str] | None = None,
) -> None:
    """Write parquet files near a target size, computing the rows once.

    Rows stay in their tasks, which begin a new file whenever one has reached the
    size. A folder that Arrow cannot open is written by Spark in files of as many
    rows as a sample suggests.
    """
    if reaches(path):
        write_rolling(df, path, max_file_bytes, mode, partition_by)
        return
    size = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).limit(1000).agg(F.avg("n")).first()[0]
    rows = max(1, int(max_file_bytes / max(1.0, (size or 1.0) / 2)))
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_removed(df: DataFrame, path: str, max_file_bytes: int = REMOVED_FILE_BYTES) -> None:
    """Rejected rows go below filter_module=/filter_reason=, ready for pruned reads.

    Rows that the language filter rejected go by their language instead of the
    reason, below language=. Rows without a reason are not rejects and are left out.
    """
    removed = df.where(F.col("filter_reason").isNotNull())
    by_language = F.col("filter_module") == "LanguageFilter"
    parts = {"removed_data": (removed.where(~by_language), ["filter_module", "filter_reason"])}
    if "language" in df.columns:
        parts["removed_languages"] = (removed.where(by_language), ["filter_module", "language"])
    else:
        parts["removed_data"] = (removed, ["filter_module", "filter_reason"])
    for name, (rows, columns) in parts.items():
        write_sized(rows, f"{path.rstrip('/')}/{name}", max_file_bytes, mode="overwrite", partition_by=columns)


def tee_write(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write all rows and go on from the written copy, so nothing is computed twice."""
    if path is None:
        return materialize(df, "tee")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _normal(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:").rstrip("/")


def input_roots(df: DataFrame) -> set[str]:
    """The folders the plan's scans were given; their files are not listed."""
    leaves, roots = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        if leaves.apply(i).nodeName() == "LogicalRelation":
            relation = leaves.apply(i).relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots |= {_normal(paths.apply(k).toString()) for k in range(paths.size())}
    return roots


def overwrite_stage(df: DataFrame, path: str, max_file_bytes: int = STAGE_FILE_BYTES) -> None:
    """Replace a stage's output folder. Refused when the plan reads from that folder, or from one around it."""
    target = _normal(path) + "/"
    for source in input_roots(df):
        if target.startswith(source + "/") or (source + "/").startswith(target):
            raise ValueError(f"{path} is an input of this plan; choose another output folder")
    write_sized(df, path, max_file_bytes, mode="overwrite")
