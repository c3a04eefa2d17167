"""Readers and writers: round trips on small files."""

import json
import os

from pyspark.sql import functions as F

from tracelens.functions import catalog as CF
from tracelens.functions import redact as RD
from tracelens.sources import readers as R
from tracelens.sources import sinks as K

SHA = "a" * 64


def test_read_uploads_skips_bad_and_parses_ts(spark, tmp_dir):
    good = {"node": "vm1", "uuid": "u1", "run_id": "3", "extractor-pack": "pack-1", "status": "OK",
            "output_before_gz": "100", "output_after_gz": "25",
            "exec_start_tm": "2018-04-11 09:10:53", "exec_end_tm": "2018-04-11 09:13:54.500000"}
    for run, body in ((3, json.dumps(good)), (4, "{not json")):
        d = os.path.join(tmp_dir, SHA, "u1", str(run))
        os.makedirs(d)
        with open(os.path.join(d, f"run-{run}-meta.json"), "w") as fh:
            fh.write(body)
    up = R.read_uploads(spark, tmp_dir)
    rows = up.collect()
    assert len(rows) == 1 and rows[0]["run_id"] == 3 and rows[0]["sample"] == SHA
    dur = up.select(CF.run_duration_seconds(F.col("exec_start_tm"), F.col("exec_end_tm")).alias("d")).first()["d"]
    assert dur == 181.5
    st = up.select(CF.status_of_run(F.col("output_before_gz"), F.lit(dur))["status"].alias("s")).first()["s"]
    assert st == "WARN"


def test_sample_metadata_and_binaries(spark, tmp_dir):
    import hashlib

    content = b"MZ\x90\x00binary"
    name = hashlib.sha256(content).hexdigest()
    with open(os.path.join(tmp_dir, name), "wb") as fh:
        fh.write(content)
    with open(os.path.join(tmp_dir, "short"), "wb") as fh:
        fh.write(b"x")
    meta = {"source": "zoo", "arch": "PE32 executable (GUI) Intel 80386", "label": "malware",
            CF.METADATA_VERSION_KEY: "0.0.1", "existing": {"scans": {"e1": {"detected": True}}, "additional_info": "x"}}
    with open(os.path.join(tmp_dir, name + ".json"), "w") as fh:
        json.dump(meta, fh)
    s = R.read_samples(spark, os.path.join(tmp_dir, "*")).collect()
    assert [r["sample"] for r in s] == [name]
    m = R.read_sample_metadata(spark, tmp_dir).first()
    assert m["sample"] == name and m["existing"]["scans"]["e1"]["detected"] is True
    doc = K.metadata_document(spark.createDataFrame([(name, "zoo", "32", None)], "sample string, source string, arch string, label string"))
    assert json.loads(doc.first()["value"]) == {"source": "zoo", "arch": "32", CF.METADATA_VERSION_KEY: "0.0.1"}


def test_features_round_trip(spark, tmp_dir):
    feats = spark.createDataFrame(
        [("s1", "u", 0, "W-MemOffsetMode.MIN_REF-5000", [1, 0, 2], 1, 5, 3, 2),
         ("s1", "u", 0, "R-MemOffsetMode.MEAN-1000", [0, 0, 1], -1, 0, 0, 0)],
        "sample string, uuid string, run_id int, feature string, feature_data array<long>, "
        "histogram_min long, histogram_max long, histogram_mean long, histogram_std_dev long",
    )
    docs = K.feature_documents(feats)
    out = os.path.join(tmp_dir, "features", "s1", "0")
    os.makedirs(out)
    text = K.to_json_documents(docs).first()["value"]
    with open(os.path.join(out, "ext-mem-rw-dump-0.0.1.json"), "w") as fh:
        fh.write(text)
    os.makedirs(os.path.join(tmp_dir, "features", ".hidden", "0"))
    back = R.read_features(spark, os.path.join(tmp_dir, "features"), run_id="0")
    got = {r["feature"]: r for r in back.collect()}
    assert set(got) == {"W-MemOffsetMode.MIN_REF-5000", "R-MemOffsetMode.MEAN-1000"}
    assert got["W-MemOffsetMode.MIN_REF-5000"]["feature_data"] == [1, 0, 2]
    assert got["W-MemOffsetMode.MIN_REF-5000"]["feature_metadata"]["histogram_max"] == 5
    K.write_features(feats, os.path.join(tmp_dir, "parq"))
    assert spark.read.parquet(os.path.join(tmp_dir, "parq")).where("feature_set_ver = '0.0.1'").count() == 2


def test_sample_set_round_trip(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "set.json"), "w") as fh:
        json.dump({"name": "n", "tags": [], "data": {"benign": ["a", "b"], "malware": ["c"]}}, fh)
    ss = R.read_sample_set(spark, os.path.join(tmp_dir, "set.json"))
    assert sorted((r["sample"], r["label"]) for r in ss.collect()) == [("a", 0.0), ("b", 0.0), ("c", 1.0)]


def test_upsert_replaces_same_id(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("a", 10), ("c", 3)], "id string, v int")
    got = {r["id"]: r["v"] for r in K.upsert(old, new, ["id"]).collect()}
    assert got == {"a": 10, "b": 2, "c": 3}


def test_skip_existing_and_force(spark):
    todo = spark.createDataFrame([("a",), ("b",)], "k string")
    done = spark.createDataFrame([("a",)], "k string")
    assert [r["k"] for r in K.skip_existing(todo, done, ["k"]).collect()] == ["b"]
    assert K.skip_existing(todo, done, ["k"], force=True).count() == 2


def test_redaction_depth_and_reports(spark):
    df = spark.sql(
        "SELECT named_struct('a', named_struct('b', named_struct('c', named_struct('d', 1), 'x', 2))) AS l1,"
        " named_struct('scans', map('e', named_struct('detected', true)), 'additional_info', 'big') AS vti"
    )
    r = RD.redact_sample_document(df).first()
    assert r["l1"]["a"]["b"]["c"] == "REDACTED" and r["l1"]["a"]["b"]["x"] == 2
    assert r["vti"]["additional_info"] == "REDACTED" and r["vti"]["scans"]["e"]["detected"] is True


def test_scalar_catalog_functions(spark):
    df = spark.createDataFrame(
        [("PE32 executable (GUI) Intel 80386",), ("PE32+ executable (GUI) x86-64",),
         ("PE32 executable (DLL) (GUI) Intel 80386",), ("ELF 64-bit LSB executable",)], "t string")
    got = [(r["v"], r["a"]) for r in df.select(CF.valid_pe(F.col("t")).alias("v"), CF.arch_of(F.col("t")).alias("a")).collect()]
    assert got == [(True, "32"), (True, "64"), (False, "32"), (False, None)]
    ids = spark.createDataFrame([("abc", "u1", 2)], "s string, u string, r int")
    d = ids.select(CF.doc_id(F.col("s"), F.col("u"), F.col("r")).alias("d")).first()["d"]
    assert d == "abc-u1-2"
    assert ids.select(CF.sample_of_doc_id(F.lit(d))).first()[0] == "abc"
    assert ids.select(CF.strip_exe(F.lit("abc.exe"))).first()[0] == "abc"
