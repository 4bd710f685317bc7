"""Row addresses: what counts as a scan, bitmaps, and plans in which no text travels."""

import pytest
from pyspark.sql import functions as F

from textmill.operators import addresses, dedup
from textmill.plans.stages import deduplication


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scan") / "rows")
    rows = [(i % 50, None if i % 97 == 0 else f"t{i % 140} " + "word " * (i % 9), i) for i in range(1000)]
    spark.createDataFrame(rows, "id long, text string, n long").repartition(5).write.parquet(path)
    return path


def test_what_is_a_scan(spark, folder):
    scan = spark.read.parquet(folder)
    assert addresses.is_scan(scan)
    assert addresses.is_scan(scan.where("n > 5").select("id", F.upper("text").alias("text")))
    assert not addresses.is_scan(scan.select("id", F.explode(F.split("text", " "))))
    assert not addresses.is_scan(scan.union(scan))
    assert not addresses.is_scan(scan.join(scan.select("id"), "id"))
    assert not addresses.is_scan(scan.withColumn("r", F.rand()))
    assert not addresses.is_scan(scan.repartition(3))
    assert not addresses.is_scan(scan.limit(3))
    assert not addresses.is_scan(spark.range(3))
    assert not addresses.is_scan(scan.withColumn("_metadata", F.lit(1)))


def test_bitmaps_split_rows_by_address(spark, folder, monkeypatch):
    rows = dedup.keyed_rows(spark.read.parquet(folder))
    gone = rows.where("n % 3 = 0").select(dedup.ROW_KEY)
    for most in (addresses.MOST_WORDS, 1):
        monkeypatch.setattr(addresses, "MOST_WORDS", most)
        kept, dropped = dedup.split_rows_by_key(rows, gone)
        assert sorted(r.n for r in kept.collect()) == [n for n in range(1000) if n % 3]
        assert sorted(r.n for r in dropped.collect()) == [n for n in range(1000) if n % 3 == 0]
    nothing = dedup.split_rows_by_key(rows, gone.where("false"))
    assert (nothing[0].count(), nothing[1].count()) == (1000, 0)


def expected(rows):
    first = {}
    for r in rows:
        first.setdefault(r.text, []).append(r.id)
    return sorted((t or "", min(ids)) for t, ids in first.items())


def test_one_row_per_text_from_scans_and_other_inputs(spark, folder):
    scan = spark.read.parquet(folder)
    want = expected(scan.collect())
    for df in (scan, scan.repartition(3), scan.union(scan)):
        got = dedup.exact_dedup(df)
        assert got.columns == scan.columns
        assert sorted((r.text or "", r.id) for r in got.collect()) == want


def test_no_text_travels_from_a_scan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id")
    for df in (dedup.exact_dedup(docs), deduplication(docs).kept, deduplication(docs).removed):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            assert "Exchange" not in line or "text#" not in line
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stage_agrees_between_scans_and_other_inputs(spark, folder):
    # Of rows that share id and cluster either may stay, so ids are made distinct here.
    scan = spark.read.parquet(folder).withColumn("id", F.col("n")).withColumn("text", F.concat_ws(" ", "text", F.lit("and five more common words"), "text"))
    outcomes = []
    for df in (scan, scan.repartition(4)):
        done = deduplication(df)
        assert done.kept.columns == scan.columns
        kept = sorted((r.id, r.text) for r in done.kept.collect())
        removed = sorted((r.id, r.text, r.filter_reason) for r in done.removed.collect())
        assert len(kept) + len(removed) == 1000
        outcomes.append((kept, removed))
    assert outcomes[0] == outcomes[1]
