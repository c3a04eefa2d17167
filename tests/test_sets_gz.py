"""Sample sets as rows, named files, and long files that can't be split."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from tracelens.operators import rank
from tracelens.sources import readers as R
from tracelens.sources import sinks as K


def test_a_set_of_a_million_ids(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(K, "SET_FILE_ROWS", 60_000)
    ids = spark.range(1_000_000).select(F.lit("big").alias("name"), F.sha2(F.col("id").cast("string"), 256).alias("sample"), (F.col("id") % 2).cast("double").alias("label"))
    small = spark.range(3).select(F.lit("small").alias("name"), F.col("id").cast("string").alias("sample"), F.lit(1.0).alias("label"))
    K.write_sample_set_rows(ids.unionByName(small), tmp_dir)
    back = R.read_sample_set_rows(spark, tmp_dir, "big")
    per_file = spark.read.parquet(f"{tmp_dir}/rows").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) < 200_000 and len(per_file) > 8
    assert back.count() == 1_000_000 and back.join(ids, ["name", "sample", "label"]).count() == 1_000_000
    assert sorted(r["sample"] for r in R.read_sample_set_rows(spark, tmp_dir, "small").collect()) == ["0", "1", "2"]
    assert {(r["name"], r["label"], r["n"]) for r in spark.read.parquet(f"{tmp_dir}/manifest").collect()} == {("big", 0.0, 500_000), ("big", 1.0, 500_000), ("small", 1.0, 3)}
    with pytest.raises(ValueError, match="too large"):
        K.export_sample_set(ids, f"{tmp_dir}/doc", most=999_999)


def test_named_files_are_samples(spark, tmp_dir):
    rows = spark.createDataFrame([("abc",), ("é",), ("x" * 5000,)], "content string").withColumn("file", F.sha2("content", 256))
    K.write_named_files(rows.select("file", "content"), tmp_dir)
    K.write_named_files(rows.select("file", "content"), tmp_dir)  # again: the same files
    assert sorted(r["length"] for r in R.read_samples(spark, tmp_dir).collect()) == [2, 3, 5000]


def test_the_driver_lists_no_named_files(spark, tmp_dir):
    """Files lie in folders by a hash of their names, and tasks list these: no plan holds a file index."""
    rows = spark.range(600).select(F.sha2(F.col("id").cast("string"), 256).alias("sample"), F.lit("zoo").alias("source"), F.lit("32").alias("arch"), F.col("id").cast("string").alias("content"))
    K.write_named_files(rows.select(F.col("sample").alias("file"), "content"), f"{tmp_dir}/s")
    K.write_named_files(K.metadata_document(rows).select(F.concat("sample", F.lit(".json")).alias("file"), F.col("value").alias("content")), f"{tmp_dir}/m")
    folders = os.listdir(f"{tmp_dir}/s")
    assert len(folders) > 200 and max(len(os.listdir(f"{tmp_dir}/s/{x}")) for x in folders) < 20
    samples, meta = R.read_samples(spark, f"{tmp_dir}/s"), R.read_sample_metadata(spark, f"{tmp_dir}/m")
    assert not samples.inputFiles() and not meta.inputFiles()
    assert {(r["sample"], r["content"].decode(), r["length"]) for r in samples.collect()} == {(r["sample"], r["content"], len(r["content"])) for r in rows.collect()}
    assert samples.join(meta.where("source = 'zoo' AND arch = '32'"), "sample").count() == 600


def test_joined_files_are_not_broadcast(spark, tmp_dir):
    """The list of folders is small, the files in them need not be: they are shuffled at a join."""
    rows = spark.range(600).select(F.sha2(F.col("id").cast("string"), 256).alias("sample"), F.lit("zoo").alias("source"), F.lit("32").alias("arch"), F.col("id").cast("string").alias("content"))
    K.write_named_files(rows.select(F.col("sample").alias("file"), "content"), f"{tmp_dir}/s")
    K.write_named_files(K.metadata_document(rows).select(F.concat("sample", F.lit(".json")).alias("file"), F.col("value").alias("content")), f"{tmp_dir}/m")
    joined = R.read_samples(spark, f"{tmp_dir}/s").select("sample", "length").join(R.read_sample_metadata(spark, f"{tmp_dir}/m").select("sample", "source"), "sample")
    assert len(joined.collect()) == 600
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_metadata_documents_of_other_forms(spark, tmp_dir):
    """Arrays give a row a document, what does not parse a row of nulls, empty files none; other names are passed by."""
    for name, text in (("a" * 64 + ".json", '[{"source": "x"}, {"source": "y"}]'), ("b" * 64 + ".json", "{broken"), ("c" * 64 + ".json", ""), ("d" * 64 + "_json", "{}"), ("e.json", "{}")):
        with open(f"{tmp_dir}/{name}", "w") as out:
            out.write(text)
    got = sorted((r["sample"][0], r["source"] or "") for r in R.read_sample_metadata(spark, tmp_dir).collect())
    assert got == [("a", "x"), ("a", "y"), ("b", "")]


def test_a_gz_trace_lies_in_several_buckets(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(rank, "DEFAULT_BUCKET_ROWS", 100)
    with gzip.open(f"{tmp_dir}/t.gz", "wt") as out:
        out.writelines(f"line {i}\n" if i % 10 else f"# {i}\n" for i in range(1000))
    lines = R.read_trace_lines(spark, f"{tmp_dir}/t.gz", dense_seq=False).withColumns({"rw": F.when(F.col("split_row") % 3 == 0, "R").otherwise("W"), "tgt": F.col("split_row")})
    base = rank._with_buckets(lines.withColumn("_k", F.struct("path")), ["split_start", "split_row"], 1, False)
    assert max(r["count"] for r in base.groupBy("_b").count().collect()) <= 100
    got = rank.access_positions(lines, ["path"], ["split_start", "split_row"], bucket_rows=1)
    order = [i for i in range(1000) if i % 10]
    assert {r["tgt"]: r["pos"] for r in got.where("access = 'RW'").collect()} == {i: k + 1 for k, i in enumerate(order)}
    reads = [i for i in order if i % 3 == 0]
    assert {r["tgt"]: r["pos"] for r in got.where("access = 'R'").collect()} == {i: k + 1 for k, i in enumerate(reads)}
