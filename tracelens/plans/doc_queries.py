"""Registered queries: nested documents, feature joins, sample-set documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import redact as RD
from ..operators import joins as J
from ..operators import labelling as L
from . import adapters as A
from .catalog_queries import BALANCED, FEATURES, RESOLVED, _resolved
from .registry import register


@register("redact_below_depth", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract(props, '$.k') AS INTEGER) + 3 AS k3,
       'REDACTED' AS deepest,
       CAST(CASE WHEN event_type IN ('view', 'error') THEN 1 ELSE 0 END
            + CASE WHEN value > 100 THEN 1 ELSE 0 END AS INTEGER) AS n_detected,
       'REDACTED' AS info
FROM events""")
def redact_below_depth(spark, sf_dir):
    """Nested documents from ``events.props``: dicts at depth 4 become a
    constant, report ``additional_info`` redacted, shallower data kept (F9)."""
    e = A.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    doc = e.select(
        "event_id",
        F.struct(
            k.alias("k"),
            F.struct(
                (k + 1).alias("k2"),
                F.struct((k + 3).alias("k3"), F.struct((k + 4).alias("k4")).alias("deepest")).alias("deeper"),
            ).alias("inner"),
        ).alias("meta"),
        F.struct(
            F.create_map(
                F.lit("typ"), F.struct(F.col("event_type").isin("view", "error").alias("detected")),
                F.lit("val"), F.struct((F.col("value") > 100).alias("detected")),
            ).alias("scans"),
            F.col("props").alias("additional_info"),
        ).alias("existing"),
    )
    red = RD.redact_sample_document(doc)
    return red.select(
        "event_id",
        F.col("meta.k").alias("k"),
        F.col("meta.inner.deeper.k3").alias("k3"),
        F.col("meta.inner.deeper.deepest").alias("deepest"),
        F.size(F.filter(F.map_values("existing.scans"), lambda s: s["detected"])).alias("n_detected"),
        F.col("existing.additional_info").alias("info"),
    )


@register("features_with_label", f"""WITH {RESOLVED}, {FEATURES}
SELECT f.sample, f.orderkey, f.n_feature_sets, r.label_value
FROM features f JOIN resolved r USING (sample) WHERE r.label_value IS NOT NULL""")
def features_with_label(spark, sf_dir):
    """Feature documents with the label of their sample."""
    f = A.order_features(spark, sf_dir)
    return J.features_with_label(f, _resolved(spark, sf_dir)).select("sample", "orderkey", "n_feature_sets", "label_value")


@register("sample_set_features", f"""WITH {RESOLVED}, {FEATURES},
featured AS (SELECT * FROM resolved WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)),
{BALANCED.format(src='featured')}
SELECT 'all' AS name, b.sample, f.orderkey, f.n_feature_sets
FROM balanced b JOIN features f USING (sample) WHERE f.n_feature_sets > 0""")
def sample_set_features(spark, sf_dir):
    """Feature documents of the samples in the sample set, empty ones dropped."""
    feats = A.order_features(spark, sf_dir)
    ss = L.build_sample_set(_resolved(spark, sf_dir), feats.where(F.col("n_feature_sets") > 0), "all")
    return J.sample_set_features(ss.select("name", "sample"), feats, "n_feature_sets").select(
        "name", "sample", "orderkey", "n_feature_sets"
    )


@register("sample_set_document", f"""WITH {RESOLVED}, {FEATURES},
featured AS (SELECT * FROM resolved WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)),
{BALANCED.format(src='featured')}
SELECT 'all' AS name,
       CAST(count(*) FILTER (WHERE label_value = 0) AS INTEGER) AS n_benign,
       CAST(count(*) FILTER (WHERE label_value = 1) AS INTEGER) AS n_malware,
       string_agg(CAST(sample AS VARCHAR), ',' ORDER BY sample) FILTER (WHERE label_value = 0) AS benign,
       string_agg(CAST(sample AS VARCHAR), ',' ORDER BY sample) FILTER (WHERE label_value = 1) AS malware
FROM balanced""")
def sample_set_document(spark, sf_dir):
    """The sample set as one JSON-shaped document {name, tags, data} (K6)."""
    feats = A.order_features(spark, sf_dir).where(F.col("n_feature_sets") > 0)
    ss = L.build_sample_set(_resolved(spark, sf_dir), feats, "all")
    doc = L.sample_set_document(ss, tags=["balanced"])
    return doc.select(
        "name", F.size("data.benign").alias("n_benign"), F.size("data.malware").alias("n_malware"),
        F.array_join(F.col("data.benign").cast("array<string>"), ",").alias("benign"),
        F.array_join(F.col("data.malware").cast("array<string>"), ",").alias("malware"),
    )
