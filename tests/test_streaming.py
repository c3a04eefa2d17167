"""Streaming forms equal their batch forms."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tracelens.operators.rank import _with_buckets
from tracelens.plans import stream_queries as SQ
from tracelens.plans.registry import QUERIES
from tracelens.sources import readers as R
from tracelens.sources import sinks as K
from tracelens.streaming import state as ST
from tracelens.streaming.uploads import process_uploads, read_uploads_output

from .conftest import SF_SMALL


def test_stream_run_counter_equals_batch(spark):
    s = QUERIES["stream_run_counter"](spark, SF_SMALL)
    b = QUERIES["run_counter"](spark, SF_SMALL)
    assert s.count() == b.count()
    assert s.exceptAll(b.select(*s.columns)).count() == 0


def test_stream_uploads_equals_backfill(spark):
    s = QUERIES["stream_uploads"](spark, SF_SMALL)
    b = QUERIES["backfill_features"](spark, SF_SMALL)
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0


def _beats(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame([(n, s * 1_000_000) for n, s in rows], "node long, ts_us long").coalesce(1).write.parquet(f"{path}/b{i}")
    return spark.readStream.schema("node long, ts_us long").option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


BEATS = [[(1, 0), (2, 0)], [(1, 200), (2, 100), (3, 190)], [(1, 1000)], [(1, 1001), (1, 1500), (2, 1500), (None, 9)], [(1, 1600)]]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_liveness_reports_every_silence_once(spark, tmp_dir, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = ST.liveness_stream(_beats(spark, f"{tmp_dir}/in", BEATS), f"{tmp_dir}/live", f"{tmp_dir}/ck").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted((r.node, r.last_seen_us // 10**6) for r in got) == [(1, 200), (1, 1001), (2, 100), (3, 190)]
    assert all(r.expired_at_us - r.last_seen_us == 300 * 10**6 for r in got)


def test_liveness_does_not_depend_on_batches(spark, tmp_dir):
    whole = spark.createDataFrame([(n, s * 1_000_000) for b in BEATS for n, s in b], "node long, ts_us long")
    ST.expire_nodes(whole, 0, f"{tmp_dir}/one")
    ST.expire_nodes(whole, 0, f"{tmp_dir}/one")  # a replay
    got = spark.read.parquet(f"{tmp_dir}/one/out").collect()
    assert sorted((r.node, r.last_seen_us // 10**6) for r in got) == [(1, 200), (1, 1001), (2, 100), (3, 190)]


def test_run_counter_goes_on_over_batches_and_replays(spark, tmp_dir):
    rows = spark.range(4000).selectExpr("7 as uuid", "id as event_id", "timestamp_micros(id) as ts")
    ST.count_runs(rows.where("event_id < 3000").withColumn("ts", F.when(F.col("event_id") > 0, F.col("ts"))), 0, tmp_dir)
    ST.count_runs(rows.where("event_id >= 3000"), 1, tmp_dir)
    ST.count_runs(rows.where("event_id >= 3000"), 1, tmp_dir)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.where("run_id = event_id").count() == out.count() == 4000


def test_range_buckets_are_even_whatever_the_spread(spark):
    """A hot key with one far outlier, ordered by time: no bucket is much larger than asked for."""
    rows = spark.range(20_000).selectExpr("named_struct('uuid', 7) as _k", "id as event_id", "if(id = 5, timestamp'2200-01-01', timestamp_micros(id)) as ts")
    buckets = _with_buckets(rows, ["ts", "event_id"], 1000, True).groupBy("_b").count().collect()
    assert len(buckets) > 10 and max(r["count"] for r in buckets) < 3000 and sum(r["count"] for r in buckets) == 20_000


def _process(spark, rows, epoch, out, run="r", force=False, log=None):
    batch = spark.createDataFrame(rows, "sample string, uuid string, run_id int, status string")

    def extract(todo):
        if log is not None:
            log.append(sorted(r["sample"] for r in todo.collect()))
        return todo.where("sample <> 'short'").select("sample", "uuid", "run_id", F.lit(1).alias("feature"))

    process_uploads(batch, epoch, out, extract, force=force, run=run)


def _samples(spark, out):
    return sorted(r["sample"] for r in read_uploads_output(spark, out).collect())


def test_upload_batches_idempotent_on_replay(spark, tmp_dir):
    calls = []
    b0 = [("a", "u", 0, "OK"), ("b", "u", 0, "ERR"), ("c", "u", 0, "WARN")]
    _process(spark, b0, 0, tmp_dir, log=calls)
    _process(spark, b0, 0, tmp_dir, log=calls)  # replay of epoch 0
    _process(spark, [("a", "u", 0, "OK"), ("d", "u", 0, "OK")], 1, tmp_dir, log=calls)
    assert calls == [["a", "c"], ["a", "c"], ["d"]]
    assert _samples(spark, tmp_dir) == ["a", "c", "d"]


def test_new_checkpoint_neither_loses_nor_doubles(spark, tmp_dir):
    _process(spark, [("a", "u", 0, "OK")], 0, tmp_dir, run="one")
    _process(spark, [("b", "u", 0, "OK")], 1, tmp_dir, run="one")
    _process(spark, [("b", "u", 0, "OK"), ("c", "u", 0, "OK")], 0, tmp_dir, run="two")
    assert _samples(spark, tmp_dir) == ["a", "b", "c"]


def test_force_extracts_again_without_doubling(spark, tmp_dir):
    calls = []
    _process(spark, [("a", "u", 0, "OK")], 0, tmp_dir, log=calls)
    _process(spark, [("a", "u", 0, "OK")], 1, tmp_dir, force=True, log=calls)
    assert calls == [["a"], ["a"]] and _samples(spark, tmp_dir) == ["a"]


def test_empty_results_count_as_done(spark, tmp_dir):
    calls = []
    _process(spark, [("short", "u", 0, "OK")], 0, tmp_dir, log=calls)
    _process(spark, [("short", "u", 0, "OK")], 1, tmp_dir, log=calls)
    assert calls == [["short"], []] and _samples(spark, tmp_dir) == []


def test_stream_resume_equals_backfill(spark):
    s = QUERIES["stream_uploads_resume"](spark, SF_SMALL)
    b = QUERIES["backfill_features"](spark, SF_SMALL)
    assert s.count() == b.count() > 0 and s.exceptAll(b).count() == 0


def test_upload_documents_are_written_by_several_tasks(spark, tmp_dir):
    """One row of a table a file, of which rows may share their keys: a document each, from all tasks."""
    rows = [(i, -1.0 if i % 2 else 1.0) for i in range(40)] + [(7, 5.0)]
    spark.createDataFrame(rows, "s_suppkey long, s_acctbal double").coalesce(1).write.parquet(f"{tmp_dir}/supplier.parquet")
    assert SQ._write_upload_files(spark, tmp_dir, f"{tmp_dir}/in", "length(sample) = 2") == 11
    assert SQ._write_upload_files(spark, tmp_dir, f"{tmp_dir}/in", "length(sample) = 3") == 30
    assert SQ._write_upload_files(spark, tmp_dir, f"{tmp_dir}/none", "sample = ''") == 0 and os.path.isdir(f"{tmp_dir}/none")
    found = R.read_uploads(spark, f"{tmp_dir}/in", meta_glob="*/*/*/*.json").select("sample", "uuid", "run_id", "status").collect()
    assert sorted(map(tuple, found)) == sorted((f"p{i}", "u0", 0, "ERR" if x < 0 else "OK") for i, x in rows)
    names = glob.glob(f"{tmp_dir}/in/sample=p*/uuid=u0/run_id=0/*.json")
    assert len({int(os.path.basename(n).split("-")[1]) >> 33 for n in names}) > 1


def test_upload_documents_of_odd_keys(spark, tmp_dir):
    rows = [("a b/c+d", "u=1", 3, None), ("ü%", "u0", 12, "OK")]
    assert K.write_upload_documents(spark.createDataFrame(rows, "sample string, uuid string, run_id int, status string"), f"{tmp_dir}/in") == 2
    found = R.read_uploads(spark, f"{tmp_dir}/in", meta_glob="*/*/*/*.json").select("run_id", "status").collect()
    assert sorted(map(tuple, found)) == [(3, None), (12, "OK")]


def test_upload_trees_are_listed_by_few_tasks(spark, tmp_dir):
    """A stream lists its trees from their root, in as many tasks as run at once; documents at other depths or by other names are none."""
    root = f"{tmp_dir}/in x"
    for at in [f"p{i}/u0/0/run-0-meta.json" for i in range(300)] + ["p0/u0/run-0-meta.json", "p0/u0/0/deep/run-0-meta.json", "p0/u0/0/other.json"]:
        os.makedirs(os.path.dirname(f"{root}/{at}"), exist_ok=True)
        with open(f"{root}/{at}", "w") as out:
            out.write('{"status": "OK"}')
    spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, "listing")
    found = R.read_uploads(spark, root, stream=True, max_files_per_trigger=200)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(s.numTasks for s in stages if s) <= 2 * R.tasks(spark)
    seen = []
    query = found.writeStream.foreachBatch(lambda df, k: seen.append([tuple(r) for r in df.select("sample", "uuid", "run_id", "status").collect()])).trigger(availableNow=True)
    query.option("checkpointLocation", f"{tmp_dir}/ckpt").start().awaitTermination()
    assert sorted(r for batch in seen for r in batch) == sorted((f"p{i}", "u0", 0, "OK") for i in range(300)) and len(seen) == 2
    assert found.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_a_stream_of_many_documents_keeps_no_listings(spark, tmp_dir):
    """No cache of files on the driver's heap; what the session sets itself stays, and the session is as it was."""
    key, cache = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = dict(spark.conf.getAll)
    try:
        spark.conf.set(key, "77")
        conf = R.read_uploads(spark, tmp_dir, stream=True).sparkSession.conf
        assert conf.get(cache) == "0" and conf.get("spark.sql.sources.ignoreDataLocality") == "true" and conf.get(key) == "77"
    finally:
        spark.conf.unset(key)
    assert dict(spark.conf.getAll) == before and cache not in before
