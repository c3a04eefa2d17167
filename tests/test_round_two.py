"""Null keys and groups, batches of the feature sink, unreadable fields, checkpoint folders."""

import json
import os
import re

import pytest

from tracelens import session
from tracelens.operators import quality as Q
from tracelens.operators.metrics import auroc
from tracelens.operators.rank import ordered_positions
from tracelens.sources import readers as R
from tracelens.sources import sinks as K


def test_null_order_rows_are_ranked_first(spark):
    df = spark.createDataFrame([("a", None), ("a", 5), ("a", 900)], "k string, o long")
    for adaptive in (False, True):
        got = {r.o: r.pos for r in ordered_positions(df, ["k"], ["o"], bucket_rows=10, adaptive=adaptive).collect()}
        assert got == {None: 1, 5: 2, 900: 3}


def test_null_groups_have_an_area(spark):
    rows = [(g, s, lab) for g in ("x", None) for s, lab in ((0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1))]
    got = {r.g: (r.n_pos, r.n_neg, r.auroc) for r in auroc(spark.createDataFrame(rows, "g string, score double, label int"), groups=["g"]).collect()}
    assert got == {"x": (2, 2, 0.875), None: (2, 2, 0.875)}


def test_null_source_counts_its_features(spark):
    uploads = spark.createDataFrame([("a", "OK"), ("b", "OK"), ("c", "ERR")], "sample string, status string")
    samples = spark.createDataFrame([("a", None), ("b", "s"), ("c", "s")], "sample string, source string")
    features = spark.createDataFrame([("a", 2), ("b", 0)], "sample string, n_feature_sets int")
    got = {r.source: (r.n_good, r.n_featured) for r in Q.featured_by_source(uploads, samples, features).collect()}
    assert got == {None: (1, 1), "s": (1, 0)}


def _feature(spark, *samples):
    return spark.createDataFrame([(s, "u", 0, "f", [1]) for s in samples], "sample string, uuid string, run_id int, feature string, feature_data array<long>")


def test_feature_batches_stay_and_do_not_double(spark, tmp_dir):
    for batch in (["a"], ["b"], ["a", "b"], ["a"]):
        K.write_features(_feature(spark, *batch), tmp_dir)
    assert sorted(r["sample"] for r in K.read_feature_table(spark, tmp_dir).collect()) == ["a", "b"]


def test_one_bad_field_keeps_the_upload(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "s", "u", "1")
    os.makedirs(folder)
    with open(os.path.join(folder, "run-1-meta.json"), "w") as file:
        json.dump({"status": "OK", "runs-left": "n/a", "output_before_gz": "7", "exec_start_tm": "yesterday"}, file)
    row = R.read_uploads(spark, tmp_dir).first()
    assert (row.status, row.runs_left, row.output_before_gz, row.exec_start_tm) == ("OK", None, 7, None)


def test_equal_versions_are_resolved_alike(spark):
    rows = spark.createDataFrame([("a", 1, v) for v in "xyz"], "id string, version int, v string")
    got = {K.latest_version(rows.repartition(n), ["id"], ["version"]).first()["v"] for n in (1, 2, 3)}
    assert len(got) == 1


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    Context.master = "local-cluster[3,2,1000]"
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_scratch_tables_go_when_dropped(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/tmp")


def test_traces_of_an_upload_open_its_folders_only(spark, tmp_dir):
    for k in range(6):
        folder = os.path.join(tmp_dir, "text", f"sample=s{k}", "uuid=u", "run_id=0")
        os.makedirs(folder)
        with open(os.path.join(folder, "t.txt"), "w") as file:
            file.write("".join(f"0x{i:x}: R 0x{100 + k:x} 4 0x1\n" for i in range(5)))
    K.ingest_traces(spark, f"{tmp_dir}/text/*/*/*/*.txt", f"{tmp_dir}/traces")
    uploads = spark.createDataFrame([("s2", "u", 0)], "sample string, uuid string, run_id int")
    got = K.read_traces(spark, f"{tmp_dir}/traces", uploads)
    assert {r["sample"] for r in got.collect()} == {"s2"} and got.count() == 5
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", got._jdf.queryExecution().sparkPlan().toString())
    assert K.read_traces(spark, f"{tmp_dir}/traces").count() == 30
