"""Upload quality and catalogue coverage reports.

Per-row lookups of the reference become joins and grouped aggregates.
Totals are taken over the already-aggregated rows (a handful of statuses or
sources), so no window ever spans the raw uploads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import STATUS_ERR, STATUS_OK


def status_breakdown(uploads: DataFrame, status_col: str = "status") -> DataFrame:
    """Uploads per status with their share of all uploads in percent (A1)."""
    per = uploads.groupBy(status_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return per.select(status_col, "n", (F.col("n") * F.lit(100.0) / total).alias("pct"))


def uploads_with_sample(uploads: DataFrame, samples: DataFrame, on: str = "sample") -> DataFrame:
    """Attach sample metadata to each upload."""
    return uploads.join(samples, on=on, how="inner")


def distinct_by_source(uploads: DataFrame, samples: DataFrame, status_col: str = "status") -> DataFrame:
    """Distinct samples per (status, source) (A2)."""
    j = uploads_with_sample(uploads.select("sample", status_col), samples.select("sample", "source"))
    return j.groupBy(status_col, "source").agg(F.countDistinct("sample").alias("n_samples"))


def featured_samples(features: DataFrame, sets_col: str = "n_feature_sets") -> DataFrame:
    """Samples that have at least one non-empty feature document."""
    return features.where(F.col(sets_col) > 0).select("sample").distinct()


def featured_by_source(uploads: DataFrame, samples: DataFrame, features: DataFrame, status_col: str = "status") -> DataFrame:
    """Of the samples with a good upload, per source, how many have features (A3)."""
    good = uploads.where(F.col(status_col) == STATUS_OK).select("sample").distinct()
    flagged = good.join(featured_samples(features).withColumn("_has", F.lit(True)), on="sample", how="left")
    each = flagged.join(samples.select("sample", "source").distinct(), on="sample", how="inner")
    # One aggregate with a flag: sources that are null form a group like any other.
    return each.groupBy("source").agg(F.count(F.lit(1)).alias("n_good"), F.count("_has").alias("n_featured"))


def list_for_source(
    uploads: DataFrame, samples: DataFrame, features: DataFrame, source: str, status_col: str = "status"
) -> DataFrame:
    """Sample ids of one source: ``bad``, ``good`` and ``featured`` lists (A4)."""
    src = samples.where(F.col("source") == source).select("sample")
    up = uploads.select("sample", status_col).join(src, on="sample", how="left_semi")
    bad = up.where(F.col(status_col) == STATUS_ERR).select(F.lit("bad").alias("list"), "sample").distinct()
    good_ids = up.where(F.col(status_col) == STATUS_OK).select("sample").distinct()
    good = good_ids.select(F.lit("good").alias("list"), "sample")
    feat = good_ids.join(featured_samples(features), on="sample", how="left_semi").select(
        F.lit("featured").alias("list"), "sample"
    )
    return bad.unionByName(good).unionByName(feat)


def feature_coverage(features_long: DataFrame) -> DataFrame:
    """Distinct feature names over a set of samples and how many samples have each."""
    return features_long.groupBy("feature").agg(F.countDistinct("sample").alias("n_samples"))
