"""Registered queries: sinks written and read back, lookups."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import joins as J
from ..operators import labelling as L
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import sampling as SMP
from ..session import cut_lineage, scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming import uploads as SU
from . import adapters as A
from .catalog_queries import BALANCED, FEATURES, PAIRS, RESOLVED, SAMPLES, UPLOADS, _pairs, _resolved
from .io_queries import TEXT_TRACE
from .oracle import GRID, chunk_sql
from .registry import register
from .stream_queries import EXTRACT_SQL, _extractor, _feature_summary


@register("ingest_traces", chunk_sql(TEXT_TRACE, "seq", A.EVENTS_CHUNKS) + f"""
SELECT sample, access, chunk_size, mode, chunk_id, round(delta, 6) AS delta FROM d WHERE mode IN {GRID}""")
def ingest_traces(spark, sf_dir):
    """Compressed tracer text -> line numbers -> Parquet trace table -> chunk deltas (S1 dense, gz)."""
    root = scratch_path(spark, f"ingest-{uuid.uuid4().hex[:8]}")
    glob = A.write_events_trace_files(spark, sf_dir, f"{root}/text", compression="gzip")
    K.ingest_traces(spark, glob, f"{root}/traces")
    d = C.chunk_deltas(K.read_traces(spark, f"{root}/traces"), A.TRACE_KEYS, A.EVENTS_CHUNKS)
    return d.select(
        "sample", "access", F.col("chunk_size").cast("long").alias("chunk_size"), "mode",
        F.col("chunk_id").cast("long").alias("chunk_id"), F.round(F.col("delta").cast("double"), 6).alias("delta"),
    )


def _features(spark, sf_dir):
    return SU.backfill(A.supplier_uploads(spark, sf_dir), _extractor(spark, sf_dir))


@register("write_features", EXTRACT_SQL)
def write_features(spark, sf_dir):
    """Feature table written in three overlapping batches, read back without loss or doubling (K1)."""
    root = scratch_path(spark, f"features-{uuid.uuid4().hex[:8]}")
    rows = cut_lineage(_features(spark, sf_dir))
    third = F.pmod(F.xxhash64("sample"), F.lit(3))
    for part in (third < 2, third > 0, third == 0):
        K.write_features(rows.where(part), root)
    return _feature_summary(K.read_feature_table(spark, root))


@register("feature_documents", EXTRACT_SQL)
def feature_documents(spark, sf_dir):
    """Feature documents exported as a JSON file an upload and read back as rows, through files only."""
    root = scratch_path(spark, f"documents-{uuid.uuid4().hex[:8]}")
    K.write_feature_documents(K.feature_documents(_features(spark, sf_dir)), root)
    back = R.read_features(spark, root, pattern="s=*/u=*/r=*/*.json")
    return _feature_summary(back.select("sample", "feature", "feature_data", "feature_metadata.*"))


@register("metadata_documents", f"""WITH {SAMPLES}
SELECT sample, source, label, '0.0.1' AS version FROM samples""")
def metadata_documents(spark, sf_dir):
    """Sample metadata rendered as JSON under a caller's version key, and parsed with the reader's schema."""
    rows = A.customer_samples(spark, sf_dir).withColumn("arch", F.lit("32"))
    docs = K.metadata_document(rows, version_key="version")
    parsed = docs.select("sample", F.from_json("value", R.sample_metadata_schema("version")).alias("m"))
    return parsed.select("sample", "m.source", "m.label", "m.version")


@register("sample_set_file", f"""WITH {RESOLVED}, {FEATURES},
featured AS (SELECT * FROM resolved WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)),
{BALANCED.format(src='featured')}
SELECT 'all' AS name, CAST(sample AS VARCHAR) AS sample, label_value AS label FROM balanced""")
def sample_set_file(spark, sf_dir):
    """Sample set exported as its JSON document and read back as rows."""
    root = scratch_path(spark, f"set-{uuid.uuid4().hex[:8]}")
    feats = A.order_features(spark, sf_dir).where(F.col("n_feature_sets") > 0)
    K.export_sample_set(L.build_sample_set(_resolved(spark, sf_dir), feats, "all"), root)
    return R.read_sample_set(spark, root)


@register("sample_set_rows", f"""WITH {RESOLVED}, {FEATURES},
featured AS (SELECT * FROM resolved WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)),
{BALANCED.format(src='featured')}
SELECT 'all' AS name, sample, label_value AS label FROM balanced""")
def sample_set_rows(spark, sf_dir):
    """Sample set kept as rows by (name, label), and read back."""
    root = scratch_path(spark, f"set-rows-{uuid.uuid4().hex[:8]}")
    feats = A.order_features(spark, sf_dir).where(F.col("n_feature_sets") > 0)
    K.write_sample_set_rows(L.build_sample_set(_resolved(spark, sf_dir), feats, "all"), root)
    return R.read_sample_set_rows(spark, root, "all")


@register("metrics_file", f"""WITH {PAIRS}
SELECT lang || '/None' AS feature,
       CAST((count(*) FILTER (WHERE label = prediction)) AS DOUBLE) / count(*) AS accuracy
FROM pairs WHERE label IN (0, 1) AND prediction IN (0, 1) GROUP BY lang""")
def metrics_file(spark, sf_dir):
    """Metric rows written as the report's CSV, one label column and fixed header, and read back (K7)."""
    root = scratch_path(spark, f"metrics-{uuid.uuid4().hex[:8]}")
    m = M.confusion_metrics(_pairs(spark, sf_dir), groups=["lang"]).withColumn("auroc", F.col("auroc_hard"))
    K.write_metrics_csv(m.withColumn("normaliser", F.lit(None).cast("string")), root, ["lang", "normaliser"])
    back = spark.read.option("header", True).csv(root)
    return back.select("feature", F.col("accuracy").cast("double").alias("accuracy"))


@register("rebuild_and_search", f"""WITH {SAMPLES}, {FEATURES}
SELECT s.sample, s.source, f.orderkey, f.n_feature_sets
FROM samples s JOIN features f USING (sample)
WHERE s.label = 'malware'""")
def rebuild_and_search(spark, sf_dir):
    """Tables reloaded in full, then searched: samples by label, with all of their features."""
    root = scratch_path(spark, f"rebuild-{uuid.uuid4().hex[:8]}")
    K.rebuild_tables({"samples": A.customer_samples(spark, sf_dir), "features": A.order_features(spark, sf_dir)}, root)
    samples = R.search_samples(spark.read.parquet(f"{root}/samples"), label="malware")
    features = R.fetch_all(R.search_features(spark.read.parquet(f"{root}/features")))
    return samples.join(features, "sample").select("sample", "source", "orderkey", "n_feature_sets")


@register("point_lookup", f"""WITH {UPLOADS}
SELECT sample, orderkey, status FROM uploads WHERE uuid = (SELECT max(uuid) FROM uploads)""")
def point_lookup(spark, sf_dir):
    """One upload by its id."""
    uploads = A.order_uploads(spark, sf_dir)
    return R.get_by_id(uploads, "uuid", uploads.agg(F.max("uuid")).first()[0]).select("sample", "orderkey", "status")


@register("attach_scan_report", """
SELECT d.doc_id, d.source, CASE WHEN d.n_chars > 1000 THEN d.lang END AS info
FROM documents d""")
def attach_scan_report(spark, sf_dir):
    """Sidecar reports joined to their files by path; files without one keep a null report."""
    d = A.table(spark, sf_dir, "documents").withColumn("path", F.format_string("/in/%d", F.col("doc_id")))
    reports = d.where("n_chars > 1000").select("path", F.struct(F.col("lang").alias("additional_info")).alias("existing"))
    return J.attach_scan_report(d, reports).select("doc_id", "source", F.col("existing.additional_info").alias("info"))


@register("dispatch_payload", f"""WITH {SAMPLES}
SELECT CAST(sample AS VARCHAR) AS sample, 'vm-1' AS vm, 'pack-1' AS "extractor-pack", '64' AS arch FROM samples""")
def dispatch_payload(spark, sf_dir):
    """A work item for every sample of the catalogue (U8)."""
    picks = A.customer_samples(spark, sf_dir).select(F.col("sample").cast("string").alias("sample"), F.lit("64").alias("arch"))
    return SMP.dispatch_payload(picks, "vm-1", "pack-1")


@register("scaled_vectors", """
WITH x AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
s AS (SELECT i, stddev_samp(v) AS sd FROM x GROUP BY i)
SELECT vec_id AS sample, round(sum(CASE WHEN sd > 0 THEN v / sd ELSE 0 END), 6) AS total, CAST(count(*) AS INTEGER) AS n
FROM x JOIN s USING (i) GROUP BY vec_id""")
def scaled_vectors(spark, sf_dir):
    """Labelled vectors scaled to unit deviation per dimension, without centring (M1, M2)."""
    rows = ML.labelled_vectors(A.embedding_vectors(spark, sf_dir))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False)
    values = vector_to_array("scaled")
    scaled = scaler.fit(rows).transform(rows)
    return scaled.select("sample", F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.size(values).alias("n"))


@register("train_test_split", """
SELECT vec_id AS sample, CAST(('0x' || substr(md5('3:' || vec_id), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
       ('0x' || substr(md5('3:' || vec_id), 1, 8))::BIGINT % 5 <> 2 AS train FROM embeddings""")
def train_test_split(spark, sf_dir):
    """Every row either in the training union of the other folds or in the fold."""
    rows = SMP.k_fold(A.embedding_vectors(spark, sf_dir).select("sample"), "sample", 5, 3, method="md5")
    train, test = SMP.train_test(rows, 2)
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@register("samples_from_folder", "SELECT sha256(CAST(c_custkey AS VARCHAR) || ':' || c_name) AS sample, CAST(strlen(CAST(c_custkey AS VARCHAR) || ':' || c_name) AS BIGINT) AS length, n_name AS source FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def samples_from_folder(spark, sf_dir):
    """Binary samples named by their hash, and a metadata document beside each: files written, then read by the readers, verified and joined."""
    # A file costs its task much more than a row: rows are dealt out to all tasks, however few files the table has.
    c, n = A.table(spark, sf_dir, "customer").repartition(R.tasks(spark), "c_custkey", "c_name"), A.table(spark, sf_dir, "nation")
    body = F.concat_ws(":", F.col("c_custkey").cast("string"), "c_name")
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(F.sha2(body, 256).alias("sample"), body.alias("content"), F.col("n_name").alias("source"), F.lit("32").alias("arch"))
    root = scratch_path(spark, f"samples-{uuid.uuid4().hex[:8]}")
    docs = K.metadata_document(rows).select("sample", "value")
    K.write_named_files(rows.select(F.col("sample").alias("file"), "content"), f"{root}/samples")
    K.write_named_files(docs.select(F.concat("sample", F.lit(".json")).alias("file"), F.col("value").alias("content")), f"{root}/metadata")
    meta = R.read_sample_metadata(spark, f"{root}/metadata").select("sample", "source")
    return R.read_samples(spark, f"{root}/samples").select("sample", "length").join(meta, "sample")
