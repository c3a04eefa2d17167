"""Evaluation metrics over (label, prediction/score) rows.

All metrics are grouped aggregates (optionally per fold / per model config),
so predictions never leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import safe_div
from ..session import cut_lineage, stage_table

#: Distinct scores in one window of :func:`auroc`, about.
SCORES_A_BUCKET = 1 << 16
METRIC_COLS = ("accuracy", "precision", "recall", "specificity", "f1", "auroc")


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", groups: Sequence[str] = ()) -> DataFrame:
    """TP, TN, FP, FN by exact equality (A7); other values count in none."""
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")
    aggs = [
        F.count_if((lab == 1.0) & (pred == 1.0)).alias("tp"),
        F.count_if((lab == 0.0) & (pred == 0.0)).alias("tn"),
        F.count_if((lab == 0.0) & (pred == 1.0)).alias("fp"),
        F.count_if((lab == 1.0) & (pred == 0.0)).alias("fn"),
    ]
    return df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)


def metric_columns(tp: Column, tn: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """E1-E5 and the hard-prediction AuROC from counts (0 on a zero denominator)."""
    n = tp + tn + fp + fn
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    specificity = safe_div(tn, tn + fp)
    f1 = F.lit(2.0) * safe_div(recall * precision, recall + precision)
    return {
        "accuracy": safe_div(tp + tn, n),
        # What the reference labels "accuracy": the share of positives.
        "positive_rate": safe_div(tp + fn, n),
        "precision": precision,
        "recall": recall,
        "specificity": specificity,
        "f1": f1,
        # ROC of hard 0/1 predictions: one interior point, area (tpr + tnr) / 2.
        "auroc_hard": (recall + specificity) / F.lit(2.0),
    }


def confusion_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", groups: Sequence[str] = ()) -> DataFrame:
    """Counts plus every metric, one row per group."""
    c = confusion_counts(df, label, prediction, groups)
    m = metric_columns(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    return c.select(*groups, "tp", "tn", "fp", "fn", *[v.alias(k) for k, v in m.items()])


def auroc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    groups: Sequence[str] = (),
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve of real-valued scores.

    AUC = sum over positives of (negatives with a lower score + half the
    negatives with an equal score) / (P * N), i.e. average ranks for ties.

    Rows are first combined per distinct (group, score). The running count of
    negatives below each score is two-level: the distinct scores are dealt out
    by range of (group, score) into ``n_buckets`` partitions of similar size (by
    default one for each SCORES_A_BUCKET of them), whatever the distribution,
    and staged, so that a partition is a bucket.
    The small per-bucket table gets prefix offsets, and the window over
    distinct scores runs inside one bucket at a time. Equal scores share a
    bucket, so ties are exact. Null groups are groups like any other.
    """
    out_groups = list(groups)
    key = F.struct(*out_groups) if out_groups else F.struct(F.lit(0).alias("_all"))
    lab = F.col(label).cast("double")
    per_score = df.groupBy(key.alias("_g"), F.col(score).cast("double").alias("_s")).agg(
        F.count_if(lab == 1.0).alias("_p"), F.count_if(lab == 0.0).alias("_n")
    )
    per_score = stage_table(per_score, "auroc-scores")  # read to count, to find the ranges, and to deal
    buckets = n_buckets or max(1, -(-per_score.count() // SCORES_A_BUCKET))
    b = cut_lineage(per_score.repartitionByRange(buckets, "_g", "_s").withColumn("_b", F.spark_partition_id().cast("long")))
    per_bucket = b.groupBy("_g", "_b").agg(F.sum("_n").alias("_bn"))
    before_b = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("_g", "_b", F.coalesce(F.sum("_bn").over(before_b), F.lit(0)).alias("_off"))
    before_s = Window.partitionBy("_g", "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    within = b.withColumn("_below", F.coalesce(F.sum("_n").over(before_s), F.lit(0)))
    scored = within.join(offsets, on=["_g", "_b"], how="inner").withColumn(
        "_credit", F.col("_p") * ((F.col("_off") + F.col("_below")).cast("double") + F.col("_n") / F.lit(2.0))
    )
    agg = scored.groupBy("_g").agg(F.sum("_credit").alias("_c"), F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"))
    return agg.select(
        *[F.col("_g")[g].alias(g) for g in out_groups], "n_pos", "n_neg",
        safe_div(F.col("_c"), F.col("n_pos") * F.col("n_neg")).alias("auroc"),
    )


def mean_over_folds(per_fold: DataFrame, config_cols: Sequence[str], metric_cols: Sequence[str] = METRIC_COLS) -> DataFrame:
    """Unweighted mean of per-fold metric rows."""
    return per_fold.groupBy(*config_cols).agg(*[F.avg(m).alias(m) for m in metric_cols])


def metrics_report(metrics: DataFrame, label_cols: Sequence[str], metric_cols: Sequence[str] = METRIC_COLS) -> DataFrame:
    """Text, JSON and CSV renderings of metric rows."""
    label = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in label_cols])
    # Fixed value: the report line of the reference.
    text = F.format_string(
        "[Accuracy: %f, Precision: %f, Recall: %f, Specificity: %f, F1: %f AuROC: %f]", *[F.col(m) for m in metric_cols]
    )
    csv = F.concat_ws(",", label, *[F.format_string("%.6f", F.col(m)) for m in metric_cols])
    js = F.to_json(F.struct(*[F.col(m) for m in metric_cols]))
    return metrics.select(*label_cols, label.alias("label"), text.alias("text"), js.alias("json"), csv.alias("csv"))


# Fixed value: header of the reference's metrics CSV.
CSV_HEADER = "feature,accuracy,precision,recall,specificity,f1-score,AuROC"


def metrics_csv(metrics: DataFrame, label_cols: Sequence[str], metric_cols: Sequence[str] = METRIC_COLS) -> DataFrame:
    """Metric rows under one label column and the header of the report file (K7)."""
    label = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in label_cols])
    names = CSV_HEADER.split(",")
    return metrics.select(label.alias(names[0]), *[F.col(m).alias(n) for m, n in zip(metric_cols, names[1:])])
