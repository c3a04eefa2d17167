"""Remaining sinks and small operators: K6-K9, J9, U8, S8-S11."""

import json
import os

from pyspark.sql import functions as F

from tracelens.operators import joins as J
from tracelens.operators import labelling as L
from tracelens.operators import ml as ML
from tracelens.operators import sampling as U
from tracelens.operators.metrics import CSV_HEADER, metrics_report
from tracelens.sources import readers as R
from tracelens.sources import sinks as K


def test_sample_set_json_round_trip(spark, tmp_dir):
    ss = spark.createDataFrame([("n", "a", 0.0), ("n", "c", 1.0), ("n", "b", 0.0)], "name string, sample string, label double")
    doc = L.sample_set_document(ss, tags=["t1"])
    K.write_sample_set(doc, os.path.join(tmp_dir, "set"))
    files = [f for f in os.listdir(os.path.join(tmp_dir, "set")) if f.endswith(".json")]
    body = json.loads(open(os.path.join(tmp_dir, "set", files[0])).read())
    assert body == {"name": "n", "tags": ["t1"], "data": {"benign": ["a", "b"], "malware": ["c"]}}
    back = R.read_sample_set(spark, os.path.join(tmp_dir, "set", files[0]))
    assert back.count() == 3


def test_metrics_csv(spark, tmp_dir):
    m = spark.createDataFrame(
        [("W-MemOffsetMode.MAX_REF-5000", "rf", None, 0.5, 0.8, 0.6, 0.7, 0.68, 0.65)],
        "feature string, classifier string, normaliser string, accuracy double, precision double, recall double, "
        "specificity double, f1 double, auroc double",
    )
    r = metrics_report(m, ["feature", "classifier", "normaliser"]).first()
    assert r["csv"].startswith("W-MemOffsetMode.MAX_REF-5000/rf/None,0.500000,0.800000")
    assert json.loads(r["json"])["f1"] == 0.68
    K.write_metrics_csv(m, os.path.join(tmp_dir, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv"))
    assert ",".join(back.columns) == CSV_HEADER
    assert [tuple(r) for r in back.collect()] == [("W-MemOffsetMode.MAX_REF-5000/rf/None", "0.5", "0.8", "0.6", "0.7", "0.68", "0.65")]


def test_save_model_keeps_scaler(spark, tmp_dir):
    from pyspark.ml import PipelineModel

    rows = [(f"s{i}", [float(i % 2), 1.0], float(i % 2)) for i in range(20)]
    v = ML.labelled_vectors(spark.createDataFrame(rows, "sample string, feature_data array<double>, label double"))
    model = ML.train_model(v, "dt", "std")
    path = os.path.join(tmp_dir, "models", "raw", "m", "model_0")
    K.save_model(model, path)
    loaded = PipelineModel.load(path)
    assert len(loaded.stages) == 2
    assert ML.predict(loaded, v).where("prediction = label").count() == 20


def test_rebuild_tables(spark, tmp_dir):
    a = spark.createDataFrame([(1,)], "x int")
    K.rebuild_tables({"samples": a, "uploads": a}, tmp_dir)
    K.rebuild_tables({"samples": a.union(a)}, tmp_dir)
    assert spark.read.parquet(os.path.join(tmp_dir, "samples")).count() == 2


def test_attach_scan_report_and_dispatch(spark):
    samples = spark.createDataFrame([("/in/x.exe", "sx", "32"), ("/in/y.exe", "sy", "64")], "path string, sample string, arch string")
    side = spark.sql("SELECT '/in/x.exe' AS path, named_struct('scans', map('e', named_struct('detected', true))) AS existing")
    got = {r["sample"]: r["existing"] for r in J.attach_scan_report(samples, side).collect()}
    assert got["sy"] is None and got["sx"]["scans"]["e"]["detected"] is True
    items = U.dispatch_payload(samples, "vm-a", "pack-1").collect()
    assert {r["sample"]: (r["vm"], r["extractor-pack"], r["arch"]) for r in items}["sy"] == ("vm-a", "pack-1", "64")


def test_searches(spark):
    s = spark.createDataFrame(
        [("a", "malware", "32", "zoo"), ("b", "benign", "32", "zoo"), ("c", "malware", "64", "web")],
        "sample string, label string, arch string, source string",
    )
    assert [r["sample"] for r in R.search_samples(s, label="malware", arch="32").collect()] == ["a"]
    assert R.fetch_all(s).count() == 3
    assert R.get_by_id(s, "sample", "c").first()["source"] == "web"
    f = spark.createDataFrame([("a", "f1"), ("b", "f1")], "sample string, feature string")
    assert R.search_features(f, sample="b").count() == 1 and R.search_features(f).count() == 2
    up = spark.createDataFrame([("a", "pack-1"), ("b", "pack-9")], "sample string, extractor_pack string")
    assert [r["sample"] for r in R.search_uploads(up, feature_family="mem_rw_dump").collect()] == ["a"]


def test_sidecar_reports_attach_to_binaries(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "x.exe"), "wb") as fh:
        fh.write(b"MZ")
    with open(os.path.join(tmp_dir, "x.exe.json"), "w") as fh:
        json.dump({"scans": {"e1": {"detected": True}, "e2": {"detected": False}}}, fh)
    bins = R.read_binaries(spark, os.path.join(tmp_dir, "*.exe"))
    side = R.read_sidecar_reports(spark, tmp_dir)
    got = J.attach_scan_report(bins.select("path", "sample"), side).first()
    assert got["existing"]["scans"]["e1"]["detected"] is True
