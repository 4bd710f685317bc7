"""Digests of files that no task reads as a whole."""

import hashlib

import numpy as np
import pytest

from textmill.sources import files


@pytest.fixture
def limits(spark):
    """Files of more than 100 kB are large, splits have at most 64 kB."""
    new = {"spark.sql.sources.binaryFile.maxLength": "100000", "spark.sql.files.maxPartitionBytes": "65536",
           "spark.sql.files.openCostInBytes": "1024"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_files_beyond_what_one_task_may_read(spark, limits, tmp_path):
    rng = np.random.default_rng(4)
    noise = rng.integers(0, 256, 400_000, np.uint8).tobytes()
    contents = {
        "small": b"PAR1", "noise": noise, "ends": noise[:200_000] + b"\n", "ends_twice": noise[:200_001] + b"\n\n",
        "begins": b"\n\n" + noise[5:200_000], "lines": b"\n" * 150_000, "one_line": b"x" * 133_333, "returns": b"a\r\n\r" * 30_000,
        "long_line": noise[:70_000] + b"y" * 100_000 + b"\n" + noise[:70_001], "a [1]{b}*": noise[1:150_000],
        "edge": noise[:65_535] + b"\n" + noise[:65_535] + b"\n", "twin": noise,
    }
    for name, content in contents.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    got = sorted(map(tuple, files.file_inventory(spark, str(tmp_path)).collect()))
    assert got == sorted((f"{n}.parquet", len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items())


def test_a_large_file_that_begins_like_text_is_read_whole(spark, limits, tmp_path):
    """Readers of lines drop a byte order mark; such a file is no Parquet, but has its digest."""
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1))
    content = b"\xef\xbb\xbf" + b"text\n" * 50_000
    (tmp_path / "mark.parquet").write_bytes(content)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(files, "WHOLE", 100_000)
        rows = files.file_inventory(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("mark.parquet", len(content), hashlib.sha256(content).hexdigest())]
