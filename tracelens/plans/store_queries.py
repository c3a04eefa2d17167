"""Registered queries: versioned document tables, redaction of any JSON, extractors by pack, saved models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.redact import redact_json
from ..operators import extractors as X
from ..operators import ml as ML
from ..session import scratch_path
from ..sources import sinks, versioned
from . import adapters as A
from .oracle import LINEITEM_ORDER, hist_sql
from .registry import register


def _root(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@register("upsert_samples", """
SELECT printf('p%d', s_suppkey) AS sample,
       CASE WHEN s_suppkey % 5 = 0 THEN 'third' WHEN s_acctbal < 0 THEN 'second' ELSE 'first' END AS source,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'REDACTED' END AS deep, 'REDACTED' AS info
FROM supplier""")
def upsert_samples(spark, sf_dir):
    """Sample documents in three upserts with a compaction between: redacted on
    the way in, the newest of an id read back (K5, F9). The third batch's deepest dict is null."""
    s = A.table(spark, sf_dir, "supplier")
    none = F.lit(None).cast("struct<k:bigint>")

    def documents(source, deepest):
        meta = F.struct(F.struct(F.struct(deepest.alias("d")).alias("c")).alias("b"))
        vti = F.struct(F.struct(F.lit(1).alias("x")).alias("additional_info"), F.lit(2).alias("scans"))
        return s.select(F.format_string("p%d", "s_suppkey").alias("sample"), F.lit(source).alias("source"), meta.alias("meta"), vti.alias("vti"), "s_suppkey", "s_acctbal")

    table = versioned.sample_table(spark, _root(spark, "samples"))
    deepest = F.struct(F.col("s_suppkey").cast("bigint").alias("k"))
    versioned.store_samples(table, documents("first", deepest))
    versioned.store_samples(table, documents("second", deepest).where("s_acctbal < 0"))
    table.compact()
    versioned.store_samples(table, documents("third", F.when(F.lit(False), deepest).otherwise(none)).where("s_suppkey % 5 = 0"))
    return table.read().select("sample", "source", F.col("meta.b.c.d").alias("deep"), F.col("vti.additional_info").alias("info"))


@register("upsert_features", """
SELECT printf('p%d', s_suppkey) AS sample, CASE WHEN s_suppkey % 4 = 2 THEN 'W' ELSE 'R' END AS feature,
       CAST(CASE WHEN s_suppkey % 4 = 2 THEN s_suppkey ELSE s_nationkey END AS BIGINT) AS value
FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 4 = 2""")
def upsert_features(spark, sf_dir):
    """Feature documents upserted: an empty or null set map replaces nothing and brings nothing (K4)."""
    s = A.table(spark, sf_dir, "supplier")
    keys = [F.format_string("p%d", "s_suppkey").alias("sample"), F.lit("u0").alias("uuid"), F.lit(0).alias("run_id")]
    empty = F.expr("CAST(map() AS map<string,bigint>)")
    sets = lambda name, value: F.create_map(F.lit(name), F.col(value).cast("bigint"))
    table = versioned.feature_document_table(spark, _root(spark, "features"))
    versioned.store_features(table, s.select(*keys, F.when(F.col("s_suppkey") % 3 != 0, sets("R", "s_nationkey")).otherwise(empty).alias("feature_sets")))
    table.compact()
    again = F.when(F.col("s_suppkey") % 4 == 2, sets("W", "s_suppkey")).when(F.col("s_suppkey") % 4 == 0, empty)
    versioned.store_features(table, s.where("s_suppkey % 2 = 0").select(*keys, again.alias("feature_sets")))
    return table.read().select("sample", F.explode("feature_sets").alias("feature", "value"))


@register("replace_table", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'late' ELSE 'new' END AS state FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def replace_table(spark, sf_dir):
    """A full reload switches readers at once; an upsert after it goes on from there (K9)."""
    c = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    table = versioned.VersionedTable(spark, _root(spark, "reload"), ("id",))
    table.upsert(c.withColumn("state", F.lit("old")))
    table.replace(c.where("id % 3 <> 0").withColumn("state", F.lit("new")))
    table.upsert(c.where("id % 2 = 0").withColumn("state", F.lit("late")))
    return table.read()


@register("redact_any_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, 'REDACTED' AS deep,
       CASE WHEN event_id % 3 = 1 THEN 'REDACTED' END AS info, CASE WHEN event_id % 3 = 1 THEN 'true' END AS detected,
       CASE WHEN event_id % 3 = 0 THEN '["null"]' WHEN event_id % 3 = 1 THEN '["object"]' ELSE '[]' END AS vti
FROM events""")
def redact_any_json(spark, sf_dir):
    """JSON documents without a schema: undeclared keys stay and are cut below depth 4, reports absent, null or there."""
    e = A.table(spark, sf_dir, "events")
    vti = F.when(F.col("event_id") % 3 == 0, ',"vti":null').when(F.col("event_id") % 3 == 1, ',"vti":{"additional_info":{"a":1},"scans":{"e1":{"detected":true}}}').otherwise("")
    head = F.concat(F.lit('{"extra":{"p":'), "props", F.lit(',"deep":{"x":{"y":{"k":'), F.col("event_id").cast("string"), F.lit("}}}}"))
    red = e.select("event_id", F.concat(head, vti, F.lit("}")).alias("doc")).select("event_id", redact_json(F.col("doc")).alias("doc"))
    at = lambda path: F.get_json_object("doc", path)
    kinds = F.transform(F.filter(F.json_object_keys("doc"), lambda k: k == "vti"), lambda _: F.when(F.col("doc").contains('"vti":null'), "null").otherwise("object"))
    return red.select("event_id", at("$.extra.p.k").cast("int").alias("k"), at("$.extra.deep.x.y").alias("deep"), at("$.vti.additional_info").alias("info"), at("$.vti.scans.e1.detected").alias("detected"), F.to_json(kinds).alias("vti"))


#: pack-2 takes uploads through both extractors.
PACKS = {"pack-1": ["ext-mem-rw-dump"], "pack-2": ["ext-mem-rw-dump", ("ext-access-summary", "0.0.1")]}
_PACK_TRACE = """
trace AS (
  SELECT printf('p%d', l_suppkey) AS sample, l_suppkey,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         CASE WHEN l_returnflag = 'N' THEN 'R' ELSE 'W' END AS rw,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS tgt
  FROM lineitem WHERE l_suppkey % 7 <> 0)"""


@register("features_by_pack", hist_sql(_PACK_TRACE, LINEITEM_ORDER, A.LINEITEM_CHUNKS, A.LINEITEM_RANGES) + """
SELECT m.sample, 'ext-mem-rw-dump' AS feature_set_name, printf('%s-MemOffsetMode.%s-%d', m.access, m.mode, m.chunk_size) AS feature,
       CAST(coalesce((SELECT sum(h.n) FROM hist h WHERE h.sample = m.sample AND h.access = m.access
                       AND h.chunk_size = m.chunk_size AND h.mode = m.mode), 0) AS BIGINT) AS total
FROM meta m
UNION ALL
SELECT sample, 'ext-access-summary', rw || '-access-summary', CAST(count(*) + count(DISTINCT tgt >> 12) + min(tgt) + max(tgt) AS BIGINT)
FROM trace WHERE l_suppkey % 2 = 1 GROUP BY sample, rw""")
def features_by_pack(spark, sf_dir):
    """Uploads of two packs and of one that nobody knows: each goes through the
    extractors of its pack, all in one plan over one read of the traces; the
    unknown pack is skipped, as asked (F20)."""
    s = A.table(spark, sf_dir, "supplier")
    pack = F.when(F.col("s_suppkey") % 7 == 0, "pack-9").when(F.col("s_suppkey") % 2 == 0, "pack-1").otherwise("pack-2")
    uploads = s.select(F.format_string("p%d", "s_suppkey").alias("sample"), F.lit("u0").alias("uuid"), F.lit(0).alias("run_id"), pack.alias("extractor_pack"))
    own = {("ext-mem-rw-dump", "0.0.1"): X.mem_rw_dump(A.LINEITEM_CHUNKS, A.LINEITEM_ORDER, A.LINEITEM_RANGES)}
    found = X.extract_by_pack(uploads, A.lineitem_trace(spark, sf_dir), PACKS, own, on_unknown="skip")
    return found.select("sample", "feature_set_name", "feature", F.aggregate("feature_data", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@register("saved_model", "SELECT CAST(count(*) AS BIGINT) AS n, true AS same FROM embeddings")
def saved_model(spark, sf_dir):
    """A model saved, read back and used: the same predictions for every row (K8, M8)."""
    vectors = ML.labelled_vectors(A.embedding_vectors(spark, sf_dir))
    model, path = ML.train_model(vectors, "svm", "std"), _root(spark, "model")
    sinks.save_model(model, path)
    one, two = (ML.predict(m, vectors).select("sample", "prediction", "score") for m in (model, PipelineModel.load(path)))
    two = two.select("sample", F.col("prediction").alias("p2"), F.col("score").alias("s2"))
    return one.join(two, "sample").agg(F.count(F.lit(1)).alias("n"), F.bool_and((F.col("prediction") == F.col("p2")) & (F.col("score") == F.col("s2"))).alias("same"))
