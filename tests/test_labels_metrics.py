"""Labels (count / percent / explicit) and metrics: the reference's cases."""

import pytest
from pyspark.sql import functions as F

from tracelens.functions import labels as LF
from tracelens.operators import labelling as L
from tracelens.operators import metrics as M


def _pairs(spark, tp, tn, fp, fn):
    rows = [(1.0, 1.0)] * tp + [(0.0, 0.0)] * tn + [(0.0, 1.0)] * fp + [(1.0, 0.0)] * fn
    return spark.createDataFrame(rows or [(None, None)], "label double, prediction double")


@pytest.mark.parametrize("counts,expected", [((2, 0, 0, 0), 1.0), ((1, 0, 1, 0), 0.5), ((0, 0, 1, 0), 0.0)])
def test_precision(spark, counts, expected):
    assert M.confusion_metrics(_pairs(spark, *counts)).first()["precision"] == expected


@pytest.mark.parametrize("counts,expected", [((1, 0, 0, 0), 1.0), ((1, 0, 0, 1), 0.5), ((0, 0, 0, 1), 0.0)])
def test_recall(spark, counts, expected):
    assert M.confusion_metrics(_pairs(spark, *counts)).first()["recall"] == expected


def test_f1(spark):
    r, p = 2 / 6, 2 / 5
    got = M.confusion_metrics(_pairs(spark, 2, 0, 3, 4)).first()
    assert got["f1"] == pytest.approx(2 * (r * p) / (r + p))
    # accuracy is (tp + tn) / n; the reference's column is the positive share.
    assert got["accuracy"] == pytest.approx(2 / 9) and got["positive_rate"] == pytest.approx(6 / 9)


def test_hard_auroc_equals_mean_of_recall_specificity(spark):
    df = _pairs(spark, 5, 7, 3, 2).withColumn("score", F.col("prediction"))
    hard = M.confusion_metrics(df).first()["auroc_hard"]
    exact = M.auroc(df, "score", "label").first()["auroc"]
    assert hard == pytest.approx(exact)


def test_auroc_matches_mllib_with_ties(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = [(float(s % 7), float((s * 3) % 2)) for s in range(200)]
    df = spark.createDataFrame(rows, "score double, label double")
    ours = M.auroc(df, "score", "label", n_buckets=3).first()["auroc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-9)


def _scans(spark, sample, report, detected):
    return [(sample, report, f"e{i}", d) for i, d in enumerate(detected)]


def test_label_rules(spark):
    rows = (
        _scans(spark, "five", "existing", [True] * 5 + [False] * 5)
        + _scans(spark, "six", "existing", [True] * 6 + [False] * 4)
        + _scans(spark, "vti_wins", "vti", [False] * 10) + _scans(spark, "vti_wins", "existing", [True] * 10)
        + [("strict", "existing", "a", None), ("strict", "existing", "b", True)]
    )
    scans = spark.createDataFrame(rows, "sample string, report string, engine string, detected boolean")
    samples = spark.createDataFrame(
        [("five", None), ("six", None), ("vti_wins", None), ("strict", None), ("explicit", "benign"), ("none", None)],
        "sample string, label string",
    )
    got = {r["sample"]: r for r in L.label_samples(samples, scans).collect()}
    assert got["five"]["label_value"] == 0.0 and got["six"]["label_value"] == 1.0
    assert got["vti_wins"]["report"] == "vti" and got["vti_wins"]["label_value"] == 0.0
    assert got["strict"]["detections"] == 1
    assert got["explicit"]["label_value"] == 0.0 and got["none"]["label_value"] is None
    pct = {r["sample"]: r["label_value"] for r in L.label_samples(samples, scans, pcount_perc=50.0).collect()}
    assert pct["five"] == 0.0 and pct["six"] == 1.0


def test_unknown_explicit_label_errors_except_vti_only(spark):
    scans = spark.createDataFrame([("x", "existing", "e", True)], "sample string, report string, engine string, detected boolean")
    samples = spark.createDataFrame([("x", "weird")], "sample string, label string")
    with pytest.raises(Exception):
        L.label_samples(samples, scans).collect()
    assert L.label_samples(samples, scans, mode="vti_only").first()["label_value"] == 0.0


def test_map_form_labels(spark):
    df = spark.sql(
        "SELECT named_struct('scans', map('a', named_struct('detected', true), 'b', named_struct('detected', false))) AS vti,"
        " CAST(NULL AS STRUCT<scans: MAP<STRING, STRUCT<detected: BOOLEAN>>>) AS existing"
    )
    r = df.select(LF.count_detections(LF.scan_data(F.col("vti"), F.col("existing"))).alias("n")).first()
    assert r["n"] == 1
