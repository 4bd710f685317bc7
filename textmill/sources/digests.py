"""SHA-256 of files of any size by tasks that read one split of a file each.

A digest takes all bytes of a file in order, but what it knows after some of them
fits into 112 bytes. So the splits of a file are read one after the other, each by
a task that goes on where the one before ended, and those of different files side
by side. Spark reads the splits as lines that end at "\\n" and are else left as
they are, from any store it knows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of OpenSSL's SHA256_CTX: eight words of state, the length, a block begun.
STATE_BYTES = 112
STEP = "state binary, fed long, start long"


@dataclass
class Chain:
    """A file, and its digest after ``fed`` bytes; ``start`` is that of the last split with lines (-1: none yet)."""

    path: str
    size: int
    lines: DataFrame
    splits: int
    state: bytes
    fed: int = 0
    start: int = -1


def library_loader() -> Callable:
    """A function that gives hashlib's own library, whose digests can be carried on, or None.

    It travels by value, as tasks may not have this package.
    """

    def load():
        import ctypes
        import ctypes.util

        try:
            import _hashlib

            library = ctypes.CDLL(getattr(_hashlib, "__file__", None) or ctypes.util.find_library("crypto"))
            start, update, final = library.SHA256_Init, library.SHA256_Update, library.SHA256_Final
        except (ImportError, OSError, AttributeError, TypeError):
            return None
        start.argtypes = [ctypes.c_char_p]
        update.argtypes = [ctypes.c_char_p, ctypes.c_char_p, ctypes.c_size_t]
        final.argtypes = [ctypes.c_char_p, ctypes.c_char_p]
        return library

    return load


def literal_path(path: str) -> str:
    """A path for readers that take patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def step(chain: Chain) -> DataFrame:
    """One row per split: the digest's state if that split is the next one."""
    state, fed, start, load = chain.state, chain.fed, chain.start, library_loader()

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        library, held, n, at = load(), ctypes.create_string_buffer(state, len(state)), fed, start
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = batch.column(1).to_numpy()
            if starts[0] < at or (starts[1:] < starts[:-1]).any():
                raise RuntimeError("splits of a file are not read in order")
            data = b"\n".join(batch.column(0).to_pylist())
            # What stood between this line and the one before, but for a file's first line.
            data = data if at < 0 else b"\n" + data
            library.SHA256_Update(held, data, len(data))
            n, at = n + len(data), int(starts[-1])
        yield pa.record_batch({"state": pa.array([held.raw], pa.binary()), "fed": [n], "start": [at]})

    return chain.lines.mapInArrow(go_on, STEP)


def chained_digests(spark: SparkSession, files: list[tuple[str, int]]) -> dict[str, str]:
    """Hex SHA-256 by path of (path, size); files whose lines do not give back their size are left out."""
    import ctypes

    library = library_loader()()
    if library is None:
        return {}
    chains = []
    for path, size in files:
        lines = spark.read.option("lineSep", "\n").text(literal_path(path))
        lines = lines.select(F.col("value").cast("binary"), F.col("_metadata.file_block_start").alias("start"))
        state = ctypes.create_string_buffer(STATE_BYTES)
        library.SHA256_Init(state)
        chains.append(Chain(path, size, lines, lines.rdd.getNumPartitions(), state.raw))
    for k in range(max((c.splits for c in chains), default=0)):
        going = [c for c in chains if c.splits > k]
        firsts = [sum(c.splits for c in going[:i]) for i in range(len(going))]
        splits = spark.sparkContext.union([step(c).rdd for c in going])
        states = spark.sparkContext.runJob(splits, list, [first + k for first in firsts])
        for c, row in zip(going, states, strict=True):
            c.state, c.fed, c.start = bytes(row.state), row.fed, row.start
    found = {}
    for c in chains:
        held, digest = ctypes.create_string_buffer(c.state, STATE_BYTES), ctypes.create_string_buffer(32)
        if c.fed == c.size - 1:
            library.SHA256_Update(held, b"\n", 1)
        if c.size - c.fed in (0, 1):
            library.SHA256_Final(digest, held)
            found[c.path] = digest.raw.hex()
    return found
