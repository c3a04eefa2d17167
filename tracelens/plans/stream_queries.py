"""Registered queries: Structured Streaming forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.catalog import epoch_us
from ..operators import chunks as C
from ..operators import histogram as H
from ..session import scratch_path
from ..sources import sinks as K
from ..streaming import state as ST
from ..streaming import uploads as SU
from ..streaming import watchdog as WD
from . import adapters as A
from .oracle import LINEITEM_ORDER, hist_sql
from .registry import ORACLE, register

# SQL twin of the extraction over successful supplier uploads (W1 and W2 give the same rows).
_OK_SUPPLIER_TRACE = """
trace AS (
  SELECT printf('p%d', l_suppkey) AS sample,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         CASE WHEN l_returnflag = 'N' THEN 'R' ELSE 'W' END AS rw,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS tgt
  FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal IS NULL OR s_acctbal >= 0))"""
EXTRACT_SQL = hist_sql(_OK_SUPPLIER_TRACE, LINEITEM_ORDER, A.LINEITEM_CHUNKS, A.LINEITEM_RANGES) + """
SELECT m.sample, printf('%s-MemOffsetMode.%s-%d', m.access, m.mode, m.chunk_size) AS feature,
       CAST(coalesce((SELECT sum(h.n) FROM hist h WHERE h.sample = m.sample AND h.access = m.access
                       AND h.chunk_size = m.chunk_size AND h.mode = m.mode), 0) AS BIGINT) AS n_binned,
       m.histogram_min, m.histogram_max, m.histogram_mean, m.histogram_std_dev
FROM meta m"""



def _extractor(spark, sf_dir):
    traces = A.lineitem_trace(spark, sf_dir)

    def extract(uploads):
        tr = traces.join(uploads.select(*A.TRACE_KEYS), on=list(A.TRACE_KEYS), how="left_semi")
        d = C.chunk_deltas(tr, A.TRACE_KEYS, A.LINEITEM_CHUNKS, order_cols=A.LINEITEM_ORDER)
        fv = H.feature_vectors(d, A.TRACE_KEYS, A.LINEITEM_RANGES)
        return fv.select(
            "sample", "uuid", "run_id", "feature", "feature_data",
            *[F.col(c).cast("long").alias(c) for c in ("histogram_min", "histogram_max", "histogram_mean", "histogram_std_dev")],
        )

    return extract


def _feature_summary(df):
    return df.select(
        "sample", "feature",
        F.aggregate("feature_data", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_binned"),
        "histogram_min", "histogram_max", "histogram_mean", "histogram_std_dev",
    )


@register("stream_uploads", EXTRACT_SQL)
def stream_uploads(spark, sf_dir):
    """Upload metadata documents (one JSON file per ``sample/uuid/run_id``
    tree) stream in, half of the files per micro-batch; successful, not
    yet extracted uploads get their traces chunked and histogrammed into an
    epoch-idempotent sink (S2, W1, K2, F7)."""
    root = scratch_path(spark, f"stream-uploads-{uuid.uuid4().hex[:8]}")
    n_files = _write_upload_files(spark, sf_dir, f"{root}/in")
    out = SU.stream_uploads(spark, _upload_source(spark, f"{root}/in", -(-n_files // 2)), f"{root}/out", f"{root}/ckpt", _extractor(spark, sf_dir))
    return _feature_summary(out)


def _write_upload_files(spark, sf_dir, path, where="true"):
    return K.write_upload_documents(A.supplier_uploads(spark, sf_dir).where(where), path)


def _upload_source(spark, path, per_batch):
    from ..sources.readers import read_uploads

    return read_uploads(spark, path, meta_glob="*/*/*/*.json", stream=True, max_files_per_trigger=max(1, per_batch))


@register("stream_uploads_resume", EXTRACT_SQL)
def stream_uploads_resume(spark, sf_dir):
    """Two runs of the upload stream on two checkpoints into one sink: the
    first half of the uploads, then all of them; what the first run did is
    neither lost nor doubled (W1, K2)."""
    root = scratch_path(spark, f"stream-resume-{uuid.uuid4().hex[:8]}")
    extract = _extractor(spark, sf_dir)
    first = _write_upload_files(spark, sf_dir, f"{root}/in", "length(sample) % 2 = 0")
    SU.stream_uploads(spark, _upload_source(spark, f"{root}/in", first), f"{root}/out", f"{root}/ckpt-1", extract)
    rest = _write_upload_files(spark, sf_dir, f"{root}/in", "length(sample) % 2 = 1")
    out = SU.stream_uploads(spark, _upload_source(spark, f"{root}/in", first + rest), f"{root}/out", f"{root}/ckpt-2", extract)
    return _feature_summary(out)


@register("backfill_features", EXTRACT_SQL)
def backfill_features(spark, sf_dir):
    """All successful existing uploads re-extracted as one batch."""
    return _feature_summary(SU.backfill(A.supplier_uploads(spark, sf_dir), _extractor(spark, sf_dir)))


@register("stream_run_counter", ORACLE["run_counter"])
def stream_run_counter(spark, sf_dir):
    """Run numbers per uuid from a callback stream, some files of events per
    micro-batch in time order, equal to the batch counter (W5)."""
    root = scratch_path(spark, f"stream-runs-{uuid.uuid4().hex[:8]}")
    glob = A.write_weekly_event_files(spark, sf_dir, f"{root}/in")
    src = spark.readStream.schema("uuid long, event_id long, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(glob)
    return ST.run_counter_stream(src, f"{root}/runs", f"{root}/ckpt")


@register("stream_node_liveness", """
WITH beats AS (SELECT user_id AS node, epoch_us(ts) AS us FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
gaps AS (SELECT node, us, lead(us) OVER (PARTITION BY node ORDER BY us) AS next, max(us) OVER () AS now FROM beats)
SELECT node, us AS last_seen_us, us + 300000000 AS expired_at_us FROM gaps WHERE coalesce(next, now) - us > 300000000""")
def stream_node_liveness(spark, sf_dir):
    """Heartbeats stream in time order over several micro-batches; every
    silence over 300 s gives one expiry row, also those open when the stream
    has ended that much later (W3, W4 trigger)."""
    root = scratch_path(spark, f"stream-live-{uuid.uuid4().hex[:8]}")
    glob = A.write_weekly_event_files(spark, sf_dir, f"{root}/in")
    src = spark.readStream.schema("uuid long, event_id long, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(glob)
    beats = src.select(F.col("uuid").alias("node"), epoch_us(F.col("ts")).alias("ts_us"))
    return ST.liveness_stream(beats, f"{root}/live", f"{root}/ckpt")


def _watchdog(spark, sf_dir, clock_us=None):
    """Heartbeats of events, then the orders in process as work that starts when the last heartbeat is in; a tick so much later."""
    root = scratch_path(spark, f"stream-watch-{uuid.uuid4().hex[:8]}")
    none = lambda kind: F.lit(None).cast(kind)
    beats = A.table(spark, sf_dir, "events").where("user_id is not null and ts is not null").select(
        F.lit("beat").alias("kind"), F.col("user_id").cast("long").alias("node"), none("string").alias("item"), epoch_us(F.col("ts")).alias("ts_us")
    )
    now = beats.agg(F.max("ts_us")).first()[0]
    orders = A.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    starts = orders.select(F.lit("start").alias("kind"), F.col("o_custkey").cast("long").alias("node"), F.col("o_orderkey").cast("string").alias("item"), F.lit(now).alias("ts_us"))
    rows = beats.unionByName(starts)
    if clock_us:
        rows = rows.unionByName(spark.range(1).select(F.lit("tick").alias("kind"), none("long").alias("node"), none("string").alias("item"), F.lit(now + clock_us).alias("ts_us")))
    glob = A.write_weekly_files(rows, F.col("ts_us"), f"{root}/in")
    source = spark.readStream.schema(WD.EVENTS).option("maxFilesPerTrigger", 1).parquet(glob)
    return WD.watchdog_stream(source, f"{root}/watch", f"{root}/ckpt").withColumn("orderkey", F.col("item").cast("long"))


@register("stream_timeout_runs", ORACLE["timeout_runs"])
def stream_timeout_runs(spark, sf_dir):
    """Heartbeats and work in flight stream in; work on nodes that are silent
    for too long becomes an ERR run, the same as in the batch form (W4)."""
    return _watchdog(spark, sf_dir).select("node", "orderkey", "status", "status_msg")


@register("stream_all_silent", """
WITH hb AS (SELECT user_id AS node, epoch_us(max(ts)) AS last_us FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
now AS (SELECT epoch_us(max(ts)) AS now_us FROM events WHERE user_id IS NOT NULL)
SELECT o.o_custkey AS node, o.o_orderkey AS orderkey, greatest(now_us, coalesce(last_us + 300000001, now_us)) AS failed_at_us
FROM orders o CROSS JOIN now LEFT JOIN hb ON hb.node = o.o_custkey WHERE o.o_orderstatus = 'P'""")
def stream_all_silent(spark, sf_dir):
    """The heartbeats end and only the clock goes on: the work of every node fails, at the end of its node's limit."""
    return _watchdog(spark, sf_dir, clock_us=3600 * 1_000_000).select("node", "orderkey", "failed_at_us")
