"""The grid's learners against Spark ML's own, numpy steps and invariants."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from tracelens.operators import grid as G
from tracelens.operators import ml as ML
from tracelens.operators.sampling import k_fold
from tracelens.operators.svm import SgdSvm


def _data(seed=0, n=160, dims=6, distinct=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) if distinct is None else rng.integers(-1, distinct, size=(n, dims)).astype(float)
    x[:, 2] = 3.0  # constant
    x[rng.random((n, dims)) < 0.4] = 0.0
    y = ((x[:, 0] - x[:, 1] + 0.5 * rng.normal(size=n)) > 0).astype(float)
    return x, y


def _frame(spark, x, y, feature="f"):
    return spark.createDataFrame([(f"s{i}", feature, r.tolist(), float(v)) for i, (r, v) in enumerate(zip(x, y))], "sample string, feature string, feature_data array<double>, label double").repartition(4)


@pytest.mark.parametrize("distinct", [None, 4])
def test_trees_equal_spark_ml(spark, distinct):
    """All thresholds, few and many values, negative values and zeros: same predictions and probabilities fold by fold."""
    x, y = _data(3, distinct=distinct)
    rows = k_fold(_frame(spark, x, y), "sample", 3, 5)
    s = G.Settings(k=3, seed=5, max_depth=4, max_bins=8)
    got = G.grid_predictions(rows, ["dt"], [None, "std"], s)
    mine = {n: sorted((r["fold"], r["label"], r["prediction"], round(r["score"], 9)) for r in got.where(F.col("normaliser").eqNullSafe(F.lit(n))).collect()) for n in (None, "std")}
    want = []
    data = ML.labelled_vectors(rows, extra=("fold",)).withColumnRenamed("features", "features_n")
    for fold in range(3):
        model = DecisionTreeClassifier(featuresCol="features_n", maxDepth=4, maxBins=8).fit(data.where(F.col("fold") != fold))
        for r in model.transform(data.where(F.col("fold") == fold)).select("label", "prediction", vector_to_array("probability")[1].alias("p")).collect():
            want.append((fold, r["label"], r["prediction"], round(r["p"], 9)))
    assert mine[None] == mine["std"] == sorted(want)


def _numpy_svm(x, y, s):
    w, sign = np.zeros(x.shape[1]), 2 * y - 1
    for i in range(1, s.iterations + 1):
        on = sign * (x @ w) < 1
        rate = s.step / np.sqrt(i)
        new = w * (1 - rate * s.reg) - rate * (-(sign[on, None] * x[on]).sum(axis=0) / len(y))
        moved, w = np.linalg.norm(new - w), new
        if i > 1 and moved < s.tol * max(np.linalg.norm(w), 1.0):
            break
    return w


@pytest.mark.parametrize("tol", [1e-3, 0.2])
def test_svm_equals_numpy(spark, tol, monkeypatch):
    x, y = _data(7)
    rows = k_fold(_frame(spark, x, y), "sample", 3, 5)
    s = G.Settings(k=3, iterations=25, tol=tol)
    blocks = G.vector_blocks(rows)
    facts = G.fold_facts(blocks, 3, True)
    weights = G.descend(blocks, facts, [None, "std"], s)["f"]
    monkeypatch.setattr(G, "TASK_ROWS", 0)  # steps over all tasks
    np.testing.assert_allclose(G.descend(blocks, facts, [None, "std"], s)["f"], weights, rtol=0, atol=1e-12)
    monkeypatch.setattr(G, "DRIVER_SUMS", 2)  # sums in stages
    np.testing.assert_allclose(G.descend(blocks, facts, [None, "std"], s)["f"], weights, rtol=0, atol=1e-12)
    fold = {r["sample"]: r["fold"] for r in rows.collect()}
    folds = np.array([fold[f"s{i}"] for i in range(len(y))])
    for k in range(3):
        train = x[folds != k], y[folds != k]
        np.testing.assert_allclose(weights[0, k], _numpy_svm(*train, s), rtol=0, atol=1e-9)
        std = train[0].std(axis=0, ddof=1)
        inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 1e-12)
        np.testing.assert_allclose(facts["f"].inverse[k], inverse, atol=1e-9)
        np.testing.assert_allclose(weights[1, k], _numpy_svm(train[0] * inverse, train[1], s) * inverse, rtol=0, atol=1e-9)


def test_svm_estimator_in_a_pipeline(spark, tmp_dir):
    from pyspark.ml import PipelineModel

    x, y = _data(9)
    vectors = ML.labelled_vectors(_frame(spark, x, y))
    model = ML.train_model(vectors, "svm", None)
    np.testing.assert_allclose(model.stages[-1].getOrDefault("weights"), _numpy_svm(x, y, G.Settings()), atol=1e-9)
    model.write().overwrite().save(f"{tmp_dir}/model")
    again = PipelineModel.load(f"{tmp_dir}/model")
    one, two = (ML.predict(m, vectors).select("sample", "prediction", "score") for m in (model, again))
    assert sorted(one.collect()) == sorted(two.collect())
    got = {r["sample"]: (r["prediction"], r["score"]) for r in one.collect()}
    margin = x @ np.array(model.stages[-1].getOrDefault("weights"))
    assert all(got[f"s{i}"] == (float(m > 0), pytest.approx(m)) for i, m in enumerate(margin))
    half = SgdSvm(featuresCol="features", miniBatchFraction=0.5, maxIter=30, seed=3)
    assert half.fit(vectors).getOrDefault("weights") == pytest.approx(half.fit(vectors).getOrDefault("weights"), abs=1e-12)
    with pytest.raises(ValueError, match="no rows"):
        half.fit(vectors.limit(0))


def test_grid_invariants(spark):
    """Every feature, classifier and normaliser; row counts, the hard AuROC identity, forests that learn."""
    x, y = _data(11, n=240, distinct=5)
    feats = _frame(spark, x, y, "a").union(_frame(spark, x[:, ::-1], y, "b")).union(_frame(spark, np.zeros((12, 3)), y[:12], "zero"))
    got = ML.evaluate_grid(feats, k=4, seed=2).collect()
    assert len(got) == 3 * 3 * 2
    cell = {(r["feature"], r["classifier"], r["normaliser"]): r for r in got}
    for r in got:
        assert r["auroc_hard"] == pytest.approx((r["recall"] + r["specificity"]) / 2)
    for c in ("dt", "rf"):
        assert cell["a", c, None]["accuracy"] == cell["a", c, "std"]["accuracy"]
        assert cell["a", c, None]["auroc"] > 0.7
    assert cell["a", "svm", None]["auroc"] > 0.8
    assert {r["feature"] for r in ML.evaluate_grid(feats, ["b"], ["dt"], [None], k=2).collect()} == {"b"}
    assert ML.evaluate_grid(feats.limit(0), k=2).count() == 0
    assert ML.cross_validate(ML.labelled_vectors(feats.limit(0)), "dt", None, k=2).count() == 0


def test_forest_equal_at_every_partitioning(spark):
    x, y = _data(13)
    rows = k_fold(_frame(spark, x, y), "sample", 2, 1)
    s = G.Settings(k=2, seed=4)
    score = lambda r: sorted((v["fold"], v["score"]) for v in G.grid_predictions(r, ["rf"], [None], s).collect())
    assert score(rows) == score(rows.repartition(1))


def test_bad_input(spark):
    x, y = _data(1, n=20)
    rows = k_fold(_frame(spark, x, y), "sample", 2, 1)
    with pytest.raises(Exception, match="labels are 0 or 1"):
        G.grid_predictions(rows.withColumn("label", F.lit(2.0)), ["dt"], [None], G.Settings(k=2))
    with pytest.raises(Exception, match="differ in length"):
        G.grid_predictions(rows.withColumn("feature_data", F.when(F.col("sample") == "s1", F.array(F.lit(1.0))).otherwise(F.col("feature_data"))), ["dt"], [None], G.Settings(k=2))
    with pytest.raises(ValueError, match="unknown classifier"):
        G.grid_predictions(rows, ["knn"], [None], G.Settings(k=2))


def test_scaler_equals_spark_ml(spark):
    x, y = _data(15)
    rows = _frame(spark, x, y).withColumn("fold", F.when(F.col("sample") < "s3", 0).otherwise(1))
    facts = G.fold_facts(G.vector_blocks(rows), 2, True)["f"]
    train = ML.labelled_vectors(rows.where("fold = 1"))
    std = StandardScaler(inputCol="features", outputCol="o", withStd=True, withMean=False).fit(train).std.toArray()
    np.testing.assert_allclose(facts.inverse[0], np.divide(1, std, out=np.zeros_like(std), where=std > 0), atol=1e-9)


def test_blocks_hold_every_row_once(spark, monkeypatch):
    """Blocks cut at features, at BLOCK_ROWS and at Arrow's batches hold each row's values; features are dealt out to several tasks."""
    monkeypatch.setattr(G, "BLOCK_ROWS", 7)
    x, y = _data(4, n=90)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        rows = _frame(spark, x, y).unionByName(_frame(spark, 2 * x, y, "g")).withColumn("fold", F.lit(1))
        none = spark.createDataFrame([("s0", "h", None, 1.0, 1)], "sample string, feature string, feature_data array<double>, label double, fold int")
        blocks = G.vector_blocks(rows.unionByName(none))
        assert blocks.agg(F.max("n")).first()[0] == 7
        held = [G._block(r.asDict()) for r in blocks.collect()]
        with pytest.raises(Exception, match="differ in length"):
            G.vector_blocks(rows.where("feature = 'f'").unionByName(none.withColumn("feature", F.lit("f"))))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(b.dims, len(b.label)) for b in held if b.feature == "h"] == [(0, 1)]
    for feature, factor in (("f", 1), ("g", 2)):
        mine = [b for b in held if b.feature == feature]
        got = sorted((*row, label) for b in mine for row, label in zip(b.dense().tolist(), b.label.tolist()))
        assert got == sorted((*row, label) for row, label in zip((factor * x).tolist(), y.tolist()))
    assert blocks.repartition(G._spread(blocks, 28), "feature").rdd.getNumPartitions() >= 8
