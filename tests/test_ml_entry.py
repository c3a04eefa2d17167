"""Models on small vectors, and the driver contract."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tracelens.operators import ml as ML


def _separable(spark, n=80):
    rows = [(f"s{i}", [float(i % 2) * 5 + (i % 7) / 10.0, 1.0 - (i % 2)], float(i % 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "sample string, feature_data array<double>, label double")
    return ML.labelled_vectors(df)


@pytest.mark.parametrize("clf,norm", [("dt", None), ("rf", "std"), ("svm", "std")])
def test_cross_validate_separable(spark, clf, norm):
    m = ML.cross_validate(_separable(spark), clf, norm, k=3, seed=1).first()
    assert m["accuracy"] == pytest.approx(1.0) and m["f1"] == pytest.approx(1.0)


def test_ensemble_vote_tie_goes_to_zero(spark):
    p = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, 1.0), (2, 1.0), (2, 0.0)], "id long, prediction double")
    got = {r["id"]: r["vote"] for r in ML.ensemble_vote(p).collect()}
    assert got == {1: 0.0, 2: 1.0}


def test_grid_and_ensemble(spark):
    v = _separable(spark).withColumn("feature", F.lit("f")).withColumn(
        "feature_data", F.array(F.lit(1.0), F.lit(2.0))
    )
    base = _separable(spark)
    from pyspark.ml.functions import vector_to_array

    feats = base.select("sample", F.lit("f").alias("feature"), vector_to_array("features").alias("feature_data"), "label")
    g = ML.evaluate_grid(feats, ["f"], classifiers=["dt"], normalizers=[None, "std"], k=2)
    assert g.count() == 2
    e = ML.train_ensemble(base, k=2, seed=3).first()
    assert e["accuracy"] == pytest.approx(1.0)
    assert v.count() == 80


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "feature_data" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    for name in o:
        assert "limit" not in o[name].lower()


def test_registered_grid_covers_every_size_and_fold(spark, monkeypatch):
    from tracelens.operators.sampling import DEFAULT_FOLDS
    from tracelens.plans import adapters as A
    from tracelens.plans import io_queries as Q

    from .conftest import SF_SMALL

    asked = {}

    def grid(features, feature_names=None, classifiers=ML.CLASSIFIERS, normalizers=ML.NORMALIZERS, k=DEFAULT_FOLDS, **_):
        asked.update(names=feature_names, classifiers=classifiers, normalizers=normalizers, k=k)
        asked["sizes"] = {int(r["feature"].rsplit("-", 1)[1]) for r in features.select("feature").distinct().collect()}
        none = [F.lit(None).cast("double").alias(m) for m in ML.METRIC_NAMES]
        return spark.range(1).select(F.lit("f").alias("feature"), F.lit("dt").alias("classifier"), F.lit("std").alias("normaliser"), *none)

    monkeypatch.setattr(Q.ML, "evaluate_grid", grid)
    Q.evaluate_feature_grid(spark, SF_SMALL)
    assert asked == {"names": None, "classifiers": ML.CLASSIFIERS, "normalizers": ML.NORMALIZERS, "k": DEFAULT_FOLDS, "sizes": set(A.LINEITEM_CHUNKS)}
