"""Sample labelling from scan reports.

Scan reports are taken in long form ``(sample, report, engine, detected)``
with ``report`` in {'vti', 'existing'}; one aggregate per sample (partial
aggregation, so a sample with very many engines is still combined map-side)
yields detections and engine counts of the report in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as LF
from .sampling import balance_classes


def scan_summary(scans: DataFrame, sample_col: str = "sample") -> DataFrame:
    """Detections and engines per sample from its vti report when it has one,
    else from its existing report (L1 + A5).  Columns: sample, report,
    engines, detections."""
    vti = F.col("report") == "vti"
    ex = F.col("report") == "existing"
    det = F.col("detected") == F.lit(True)
    agg = scans.groupBy(sample_col).agg(
        F.count_if(vti).alias("_n_vti"),
        F.count_if(vti & det).alias("_d_vti"),
        F.count_if(ex).alias("_n_ex"),
        F.count_if(ex & det).alias("_d_ex"),
    )
    has_vti = F.col("_n_vti") > 0
    return agg.select(
        sample_col,
        F.when(has_vti, F.lit("vti")).when(F.col("_n_ex") > 0, F.lit("existing")).alias("report"),
        F.when(has_vti, F.col("_n_vti")).otherwise(F.col("_n_ex")).alias("engines"),
        F.when(has_vti, F.col("_d_vti")).otherwise(F.col("_d_ex")).alias("detections"),
    )


def scan_label(summary: DataFrame, pcount_min: int = LF.DEFAULT_PCOUNT_MIN, pcount_perc: float | None = None) -> Column:
    """Scan-based label: percentage rule when ``pcount_perc`` is set (L3), else count rule (L2)."""
    if pcount_perc is not None:
        return LF.label_by_percent(F.col("detections"), F.col("engines"), pcount_perc)
    return LF.label_by_count(F.col("detections"), pcount_min)


def label_samples(
    samples: DataFrame,
    scans: DataFrame,
    label_col: str = "label",
    sample_col: str = "sample",
    pcount_min: int = LF.DEFAULT_PCOUNT_MIN,
    pcount_perc: float | None = None,
    mode: str = "default",
) -> DataFrame:
    """Resolve every sample's label (L5): explicit label first, then scans.

    ``samples`` holds one row per sample with its optional explicit label
    string.  Samples without scan data get a null scan label.  Output adds
    ``engines, detections, explicit_label, scan_label, label_value``.
    """
    summary = scan_summary(scans, sample_col)
    joined = samples.join(summary, on=sample_col, how="left")
    explicit = LF.explicit_label(F.col(label_col)) if mode != "vti_only" else F.lit(None).cast("double")
    scanned = scan_label(joined, pcount_min, pcount_perc)
    return joined.withColumn("explicit_label", explicit).withColumn("scan_label", scanned).withColumn(
        "label_value", LF.resolve_label(F.col("explicit_label"), F.col("scan_label"), mode)
    )


def class_counts(labelled: DataFrame, label_col: str = "label_value") -> DataFrame:
    """malware, benign and total counts (A6) as one row."""
    return labelled.agg(
        F.count_if(F.col(label_col) == LF.MALWARE).alias("malware"),
        F.count_if(F.col(label_col) == LF.BENIGN).alias("benign"),
        F.count_if(F.col(label_col).isin(LF.MALWARE, LF.BENIGN)).alias("total"),
    )


def build_sample_set(
    labelled: DataFrame,
    featured: DataFrame,
    name: str,
    sample_col: str = "sample",
    label_col: str = "label_value",
    seed: str = "",
) -> DataFrame:
    """Sample set (L6): labelled samples that have non-empty features, unknown
    labels excluded, classes balanced (U3).  Columns: name, sample, label."""
    with_features = labelled.join(featured.select(sample_col).distinct(), on=sample_col, how="left_semi")
    known = with_features.where(F.col(label_col).isin(LF.MALWARE, LF.BENIGN))
    balanced = balance_classes(known, label_col=label_col, key_col=sample_col, seed=seed)
    return balanced.select(F.lit(name).alias("name"), sample_col, F.col(label_col).alias("label"))


def sample_set_document(sample_set: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """JSON-shaped sample set ``{name, tags, data: {benign: [...], malware: [...]}}`` (K6).

    Gathers ids into two lists per set: use at the sink only, on a balanced
    set (the reference's sets hold hundreds of ids).
    """
    tag_array = F.array(*[F.lit(t) for t in (tags or [])]).cast("array<string>")
    return sample_set.groupBy("name").agg(
        F.struct(
            F.sort_array(F.collect_list(F.when(F.col("label") == LF.BENIGN, F.col("sample")))).alias("benign"),
            F.sort_array(F.collect_list(F.when(F.col("label") == LF.MALWARE, F.col("sample")))).alias("malware"),
        ).alias("data"),
    ).select("name", tag_array.alias("tags"), "data")
