"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textmill", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Rows are whole documents, so Arrow batches are kept short.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local master, where driver and executors are one machine, may go
    without the setting; a temporary folder is used then.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="textmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/textmill-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Cuts lineage in a way that outlives lost executors, and gives the planner
    true sizes for its join choices.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
