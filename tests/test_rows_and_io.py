import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textmill.operators import rows
from textmill.operators.ordering import global_row_number, range_cuts, running_total
from textmill.operators.skew import hot_keys, keep_smallest, salted_join
from textmill.plans.chain import curation_chain, faults
from textmill.session import scratch_path
from textmill.sources import files, reader, writer


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id")


def test_chunks_rejoin(docs):
    chunks = rows.chunk_text(docs.select("id", "text"), 97)
    assert chunks.where(F.length("text") > 97).isEmpty()
    back = rows.combine_rows(chunks, "id", "chunk_idx", "")
    assert back.exceptAll(docs.select("id", "text")).isEmpty()
    assert back.count() == docs.count()


def test_empty_text_gives_no_chunk(spark):
    df = spark.createDataFrame([(1, ""), (2, "ab")], "id long, text string")
    assert [r.id for r in rows.chunk_text(df, 5).collect()] == [2]


def test_ordering_over_many_ranges(spark):
    ids = random.Random(3).sample(range(10**6), 5000)
    df = spark.createDataFrame([(i, i % 7) for i in ids], "id long, v long").repartition(5)
    assert len(range_cuts(df, ["id"], 100)) > 10
    expected, total = {}, 0
    for n, i in enumerate(sorted(ids), 1):
        expected[i] = (n, total)
        total += i % 7
    numbered = {r.id: r.n for r in global_row_number(df, ["id"], "n", rows_per_range=100).collect()}
    summed = {r.id: r.s for r in running_total(df, ["id"], F.col("v"), "s", 100).collect()}
    assert {i: (numbered[i], summed[i]) for i in ids} == expected


def test_ordering_by_two_columns_splits_a_hot_first_one(spark):
    df = spark.range(2000).select(F.lit("same").alias("doc"), F.col("id").alias("part"))
    out = global_row_number(df, ["doc", "part"], "n", rows_per_range=100)
    assert out.where("n <> part + 1").isEmpty()
    assert len(range_cuts(df, ["doc", "part"], 100)) > 5


def test_skip_and_limit(docs):
    ids = sorted(r.id for r in docs.select("id").collect())
    got = reader.scan_skip_limit(docs.select("id"), 5, 20)
    assert sorted(r.id for r in got.collect()) == ids[5:25]
    assert reader.scan_skip_limit(docs, 190).count() == len(ids) - 190
    assert reader.scan_skip_limit(docs, 10**6).isEmpty()


def test_skip_and_limit_leave_texts_in_place(docs):
    plan = reader.scan_skip_limit(docs, 5, 20)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_skip_takes_rows_of_one_id_together(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id long")
    assert sorted(r.id for r in reader.scan_skip_limit(df, 1, 2).collect()) == [2, 2]
    assert sorted(r.id for r in reader.scan_skip_limit(df, 2).collect()) == [2, 2, 3]


def test_salted_join_is_exact(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = big.join(table, "k", how)
        salted = salted_join(big, table, ["k"], ["id"], how, hot_rows=100)
        assert salted.exceptAll(plain.select(salted.columns)).isEmpty()
        assert salted.count() == plain.count()
    assert [r.k for r in hot_keys(big, ["k"], 100).collect()] == [0]


def test_keep_smallest(docs):
    out = keep_smallest(docs.select("id", "text"), ["text"], "id")
    assert out.count() == docs.select("text").distinct().count()


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 8.0)], "x double")
    row = rows.exact_quantiles(df, "x", {"q25": 0.25, "q50": 0.5, "q75": 0.75}).first()
    assert (row.q25, row.q50, row.q75) == (1.75, 3.0, 5.0)


def test_null_guard_and_metadata(spark):
    df = spark.createDataFrame([(1, None, ("new", "nl"))], "id long, text string, metadata struct<text:string,lang:string>")
    out = reader.null_guard(reader.expand_metadata(df)).first()
    assert (out.text, out.lang, out.extra) == ("new", "nl", "")
    maps = spark.createDataFrame([(1, {"a": "x"}), (2, {"b": "y"})], "id long, metadata map<string,string>")
    got = {r.id: (r.a, r.b) for r in reader.expand_metadata(maps).collect()}
    assert got == {1: ("x", None), 2: (None, "y")}


def test_scan_stays_in_the_root(spark, docs, tmp_path):
    docs.limit(5).write.parquet(str(tmp_path / "in"))
    docs.limit(3).write.parquet(str(tmp_path / "in" / "logs"))
    assert reader.read_documents(spark, str(tmp_path / "in")).count() == 5
    assert reader.read_documents(spark, str(tmp_path / "in"), recursive=True).count() == 8


def test_scan_of_a_table_that_is_a_folder(spark, docs, tmp_path):
    docs.limit(5).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs.limit(3).coalesce(1).write.parquet(str(tmp_path / "other.parquet"))
    assert reader.read_documents(spark, str(tmp_path), glob="documents.parquet").count() == 5
    assert reader.read_documents(spark, str(tmp_path), glob="{doc,oth}*.parquet").count() == 8


def test_audit_finds_bad_files(spark, docs, tmp_path):
    run = tmp_path / "stage1_string_normalization"
    docs.write.parquet(str(run))
    (run / "bad.parquet").write_bytes(b"junk")
    audit = files.audit_files(spark, str(tmp_path))
    verdict = files.audit_verdict(audit).first()
    assert not verdict.all_valid and len(verdict.invalid_files) == 1
    stage = files.stage_audit(audit).collect()
    assert [(r.stage, r.all_valid) for r in stage] == [("string_normalization", False)]
    assert stage[0].path.endswith("stage1_string_normalization")


def test_names_beyond_four_digits(spark):
    paths = spark.range(10_005).select(F.format_string("p%06d", "id").alias("path"))
    names = {r.path: r.new_name for r in files.delivery_names(paths, "c").collect()}
    assert names["p000000"] == "c_0001.parquet" and names["p010004"] == "c_10005.parquet"


def test_sized_files_follow_the_target(spark, docs, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    writer.write_sized(docs, one, 2**28)
    writer.write_sized(docs, many, 2**16)
    assert len(list(Path(one).glob("*.parquet"))) == 1
    assert len(list(Path(many).glob("*.parquet"))) > 2
    assert spark.read.parquet(many).count() == docs.count()


def test_overwrite_refuses_its_own_input(spark, docs):
    path = scratch_path(spark, "self")
    writer.overwrite_stage(docs, path)
    with pytest.raises(ValueError, match="input of this plan"):
        writer.overwrite_stage(spark.read.parquet(path), path)
    writer.overwrite_stage(docs.limit(4), path)
    assert spark.read.parquet(path).count() == 4


def test_delivery_columns(docs):
    assert rows.delivery_format(docs).columns == ["id", "text", "source"]
    assert list(rows.DELIVERY_COLUMNS) == rows.delivery_format(docs, fill_missing=True).columns


def test_chain_config_errors(spark):
    assert faults({}) == ["no stages given"]
    bad = {"stages": [{"stage": "nope"}, {"stage": ""}, {"stage": "pii_masking"}], "input_from_previous_output": False}
    found = faults(bad)
    assert len(found) == 4 and "'nope'" in found[0] and found[1].startswith("step 2")
    with pytest.raises(ValueError, match="step 1 asks for 'nope'.*step 3 has nothing to read"):
        curation_chain(spark, bad)


def test_chain_prefers_an_explicit_input(spark, docs):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    docs.where("id < 10").write.parquet(a)
    docs.where("id < 20").write.parquet(b)
    config = {
        "input_from_previous_output": True,
        "stages": [
            {"stage": "string_normalization", "input_folder": a},
            {"stage": "string_normalization", "input_folder": b, "output_folder": scratch_path(spark, "out")},
        ],
    }
    assert curation_chain(spark, config).kept.count() == 20


def test_chain_reads_with_the_options_of_a_step(spark, docs):
    folder, listed = scratch_path(spark, "in"), scratch_path(spark, "list")
    docs.withColumnRenamed("text", "body").coalesce(1).write.parquet(folder)
    step = {"stage": "data_splitting", "id_key": "id", "text_key": "body", "skip": 5, "limit": 20, "input_folder": folder}
    kept = curation_chain(spark, {"stages": [step]}).kept
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in docs.collect())[5:25]
    docs.coalesce(1).write.parquet(f"{folder}2")
    files = [f.rsplit("/", 1)[1] for f in spark.read.parquet(f"{folder}2").inputFiles()]
    spark.createDataFrame([(f,) for f in files], "value string").coalesce(1).write.text(listed)
    step = {"stage": "data_splitting", "id_key": "id", "paths_file": listed, "input_folder": f"{folder}2"}
    assert curation_chain(spark, {"stages": [step]}).kept.count() == docs.count()


def test_language_rejects_go_by_language(spark, docs):
    path = scratch_path(spark, "rejects")
    rows = docs.limit(6).withColumns(
        {
            "language": F.when(F.col("id") % 2 == 0, "fr").otherwise("nl"),
            "filter_module": F.when(F.col("id") < 4, "LanguageFilter").otherwise("Other"),
            "filter_reason": F.lit("language"),
        }
    )
    writer.write_removed(rows, path)
    by_language = spark.read.parquet(f"{path}/removed_languages")
    assert {r.language for r in by_language.collect()} == {r.language for r in rows.where("id < 4").collect()}
    assert spark.read.parquet(f"{path}/removed_data").count() == rows.where("id >= 4").count()


def test_metadata_as_json_and_variant(spark):
    texts = ['{"a": 1, "b": "x", "text": "m"}', '{"a": 2.5, "c d": [1, 2]}', '{"b": 7}', "[1]", "no json", None, "{}", '{"o": {"p": null}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, metadata string").withColumns({"text": F.lit("t"), "b": F.lit("old")})
    for form in (df, df.withColumn("metadata", F.try_parse_json("metadata"))):
        out = reader.expand_metadata(form)
        assert sorted(out.columns) == ["a", "b", "c d", "id", "o", "text"]
        rows = {r.id: r for r in out.collect()}
        assert [float(rows[i].a) for i in (0, 1)] == [1.0, 2.5] and (rows[0].b, rows[2].b, rows[0].text) == ("x", "7", "m")
        assert rows[1]["c d"] == [1, 2] and all(rows[i].a is None for i in (2, 3, 4, 5, 6, 7))
    assert reader.expand_metadata(df, keys=["a"]).columns == ["id", "text", "b", "a"]
    assert reader.expand_metadata(df.where("id = 4")).columns == ["id", "text", "b"]


def test_chain_counters_equal_stage_counts(spark, docs):
    judged = docs.withColumns({"language": F.when(F.col("id") % 3 == 0, "xx").otherwise("en"), "language_score": F.lit(0.9)})
    steps = [
        {"stage": "heuristic_filtering", "languages": ["en"], "output_folder": scratch_path(spark, "one")},
        {"stage": "deduplication", "output_folder": scratch_path(spark, "two")},
    ]
    result = curation_chain(spark, {"input_from_previous_output": True, "stages": steps}, judged)
    from textmill.operators.stats import stage_counts
    from textmill.plans.stages import annotate_heuristics

    want = {(r.filter_module, r.filter_reason): r.n_rows for r in stage_counts(annotate_heuristics(judged, languages=["en"])).collect()}
    got = result.counters["1_heuristic_filtering"]
    assert got["forwarded"] == want.pop((None, None), 0) and got["removed"] == want and got["total"] == docs.count()
    assert result.counters["2_deduplication"]["forwarded"] == result.kept.count()
