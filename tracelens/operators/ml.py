"""Model training and evaluation with Spark ML.

Feature vectors stay distributed: a feature's dense bins become an ML vector
column, a single model is a ``Pipeline`` (optional scaler + classifier),
cross-validation folds come from a seeded hash, predictions are a DataFrame
and metrics are grouped aggregates.  The models of a cross-validation or a
grid are learned together (:mod:`grid`), not one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stage_table
from . import grid
from .metrics import auroc, confusion_metrics, mean_over_folds
from .sampling import DEFAULT_FOLDS, k_fold
from .svm import SgdSvm

# Classifier settings of the reference (tree depth, bins,
# forest size) and its configuration grid.
CLASSIFIERS = ("svm", "dt", "rf")
NORMALIZERS = (None, "std")
TREE_MAX_DEPTH = 5
TREE_MAX_BINS = 32
FOREST_TREES = 6
SVM_REG = 0.01
SVM_STEP = 1.0
SVM_ITERATIONS = 100
SVM_TOL = 1e-3
ENSEMBLE_FEATURE = "W-MemOffsetMode.MIN_REF-5000"
ENSEMBLE_MEMBERS = (("dt", "std"), ("rf", None), ("svm", "std"))
METRIC_NAMES = ("accuracy", "precision", "recall", "specificity", "f1", "auroc", "auroc_hard")


def labelled_vectors(
    features: DataFrame, feature: str | None = None, data_col: str = "feature_data", label_col: str = "label", extra: Sequence[str] = ()
) -> DataFrame:
    """``(sample, extra..., features VECTOR, label DOUBLE)`` for one feature (M1)."""
    f = features if feature is None else features.where(F.col("feature") == feature)
    return f.select(
        "sample",
        *extra,
        array_to_vector(F.col(data_col).cast("array<double>")).alias("features"),
        F.col(label_col).cast("double").alias("label"),
    )


def make_classifier(name: str, seed: int = 0):
    """A fresh classifier by name (M3-M5)."""
    if name == "svm":
        return SgdSvm(featuresCol="features_n", maxIter=SVM_ITERATIONS, regParam=SVM_REG, stepSize=SVM_STEP, tol=SVM_TOL, seed=seed)
    if name == "svm_owlqn":
        # The same loss and L2 term, minimised to convergence by Spark ML's own optimiser.
        return LinearSVC(
            featuresCol="features_n", labelCol="label", regParam=SVM_REG, maxIter=SVM_ITERATIONS,
            fitIntercept=False, tol=SVM_TOL, standardization=False,
        )
    if name == "dt":
        return DecisionTreeClassifier(
            featuresCol="features_n", labelCol="label", impurity="gini", maxDepth=TREE_MAX_DEPTH, maxBins=TREE_MAX_BINS
        )
    if name == "rf":
        return RandomForestClassifier(
            featuresCol="features_n", labelCol="label", numTrees=FOREST_TREES, featureSubsetStrategy="auto",
            impurity="gini", maxDepth=TREE_MAX_DEPTH, maxBins=TREE_MAX_BINS, seed=seed,
        )
    raise ValueError(f"unknown classifier {name!r}")


def model_pipeline(classifier: str, normalizer: str | None, seed: int = 0) -> Pipeline:
    """Optional standard scaler (std only, no centring, fit on train) + classifier (M2, M6)."""
    if normalizer == "std":
        scaler = StandardScaler(inputCol="features", outputCol="features_n", withStd=True, withMean=False)
        return Pipeline(stages=[scaler, make_classifier(classifier, seed)])
    if normalizer is not None:
        raise ValueError(f"unknown normalizer {normalizer!r}")
    from pyspark.ml.feature import VectorAssembler

    passthrough = VectorAssembler(inputCols=["features"], outputCol="features_n")
    return Pipeline(stages=[passthrough, make_classifier(classifier, seed)])


def train_model(train: DataFrame, classifier: str, normalizer: str | None, seed: int = 0) -> PipelineModel:
    """Fit scaler (on train only) and classifier (M7)."""
    return model_pipeline(classifier, normalizer, seed).fit(train)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Scale with the train scaler, then predict (M8)."""
    out = model.transform(rows)
    score = F.col("probability") if "probability" in out.columns else F.col("rawPrediction")
    return out.withColumn("score", vector_to_array(score)[1]).drop("features_n")


def _fold_means(preds: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Mean metrics over folds, per group. AuROC from the classifier's score (probability, or the SVM margin) is the
    default; ``auroc_hard`` is the area of the hard 0/1 predictions (D2)."""
    per_fold = confusion_metrics(preds, groups=[*groups, "fold"]).join(
        auroc(preds, "score", "label", [*groups, "fold"]).select(*groups, "fold", "auroc"), on=[*groups, "fold"], how="left"
    )
    return mean_over_folds(per_fold, groups, METRIC_NAMES)


def _settings(k: int, seed: int) -> grid.Settings:
    return grid.Settings(k=k, seed=seed, max_depth=TREE_MAX_DEPTH, max_bins=TREE_MAX_BINS, trees=FOREST_TREES, iterations=SVM_ITERATIONS, step=SVM_STEP, reg=SVM_REG, tol=SVM_TOL)


def cross_validate(
    vectors: DataFrame,
    classifier: str,
    normalizer: str | None,
    k: int = DEFAULT_FOLDS,
    seed: int = 0,
    key_col: str = "sample",
) -> DataFrame:
    """k-fold cross-validation: per-fold metrics averaged.

    Folds are a seeded hash of the key, so every recomputation sees the same
    split; the models of all folds are learned at once (:mod:`grid`). Returns
    one row with the mean of each metric over folds, none if no fold has rows
    both inside and outside.
    """
    rows = k_fold(vectors, key_col, k, seed).select(
        F.lit("").alias("feature"), F.col(key_col).alias("sample"), "fold", "label", vector_to_array("features").alias("feature_data")
    )
    preds = stage_table(grid.grid_predictions(rows, [classifier], [normalizer], _settings(k, seed)), "cv-predictions")
    return _fold_means(preds, ["feature"]).drop("feature")


def evaluate_grid(
    features: DataFrame,
    feature_names: Sequence[str] | None = None,
    classifiers: Sequence[str] = CLASSIFIERS,
    normalizers: Sequence[str | None] = NORMALIZERS,
    k: int = DEFAULT_FOLDS,
    seed: int = 0,
) -> DataFrame:
    """Every feature x classifier x normaliser, cross-validated.

    The models of all cells and folds are learned at once (:mod:`grid`), and
    one grouped aggregate over all predictions gives the metrics. Without
    ``feature_names`` every feature that the rows have is evaluated.
    """
    rows = k_fold(features.select("sample", "feature", "feature_data", "label"), "sample", k, seed)
    if feature_names is not None:
        rows = rows.where(F.col("feature").isin(list(feature_names)))
    preds = stage_table(grid.grid_predictions(rows, classifiers, normalizers, _settings(k, seed)), "grid-predictions")
    # "None" stands for no normaliser, as a key of joins.
    means = _fold_means(preds.withColumn("_norm", F.coalesce("normaliser", F.lit("None"))), ["feature", "classifier", "_norm"])
    return means.select("feature", "classifier", F.when(F.col("_norm") != "None", F.col("_norm")).alias("normaliser"), *METRIC_NAMES)


def ensemble_vote(predictions: DataFrame, id_col: str = "id", pred_col: str = "prediction") -> DataFrame:
    """Majority vote of model outputs per row.

    Binary ties go to 0.0 (the smaller label), as the reference's pick does in
    practice.  Map-side combined: sum and count per id.
    """
    agg = predictions.groupBy(id_col).agg(F.sum(F.col(pred_col)).alias("_s"), F.count(F.lit(1)).alias("n_models"))
    return agg.select(
        id_col, F.when(F.col("_s") * 2 > F.col("n_models"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("vote"), "n_models"
    )


def train_ensemble(
    vectors: DataFrame,
    members: Sequence[tuple[str, str | None]] = ENSEMBLE_MEMBERS,
    k: int = DEFAULT_FOLDS,
    seed: int = 0,
    key_col: str = "sample",
    run_cols: Sequence[str] = (),
) -> DataFrame:
    """Train each member on one half, vote on the other half, score over k folds of it.

    ``run_cols`` tell a key's runs apart (uuid and run id, D5): every run has
    its own vote, and the runs of a key stay in one half and one fold. Returns the mean metrics over the k folds of the held-out half.
    """
    halves = cut_lineage(k_fold(vectors, key_col, 2, seed).withColumnRenamed("fold", "_half"))
    train, held = halves.where(F.col("_half") == 0).drop("_half"), halves.where(F.col("_half") == 1).drop("_half")
    long = None
    for i, (clf, norm) in enumerate(members):
        p = predict(train_model(train, clf, norm, seed), held).select(
            key_col, *run_cols, F.lit(i).alias("model"), "prediction"
        )
        long = p if long is None else long.unionByName(p)
    run = [key_col, *run_cols]
    votes = ensemble_vote(long.withColumn("_run", F.struct(*run)), "_run")
    scored = k_fold(held.select(F.struct(*run).alias("_run"), key_col, "label"), key_col, k, seed + 1).join(votes, "_run")
    # A vote is a hard 0/1 output: its AuROC is the hard one.
    per_fold = confusion_metrics(scored, prediction="vote", groups=["fold"]).withColumn("auroc", F.col("auroc_hard"))
    return mean_over_folds(per_fold.withColumn("_cfg", F.lit(1)), ["_cfg"], METRIC_NAMES).drop("_cfg")
