"""Stateful streams (W5 run counter, W3/W4 liveness) as micro-batches of DataFrame work.

Each micro-batch runs in ``foreachBatch`` with native operators, so a key that
holds a third of the rows is ranked or reduced over many tasks like any other.
The state is a small table of one row a key, written as
``<root>/state/run=<query id>/epoch=<k>``; epoch ``k`` reads that of ``k - 1`` and writes its
own and its output by overwriting, so a batch that is replayed after a failure
gives the same again. The query id comes from the checkpoint: a new
checkpoint starts a new run beside the old one, never over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rank import ordered_positions
from .liveness import HEARTBEAT_TIMEOUT_SECONDS
from .runs import path_exists, query_id, remove

RUN_COUNTER_OUT = "uuid long, event_id long, run_id long"
RUN_COUNTER_STATE = "uuid long, next_run long"
LIVENESS_OUT = "node long, last_seen_us long, expired_at_us long"
LIVENESS_STATE = "node long, last_seen_us long, expired boolean, now_us long"


def _epoch(root: str, kind: str, run: str, epoch: int) -> str:
    return f"{root.rstrip('/')}/{kind}/run={run}/epoch={epoch}"


def _state(spark: SparkSession, root: str, run: str, epoch: int, schema: str, kind: str = "state") -> DataFrame:
    before = _epoch(root, kind, run, epoch - 1)
    if path_exists(spark, before):
        return spark.read.schema(schema).parquet(before)
    return spark.createDataFrame([], schema)


def _keep(spark: SparkSession, state: DataFrame, root: str, run: str, epoch: int, kind: str = "state") -> None:
    state.write.mode("overwrite").parquet(_epoch(root, kind, run, epoch))
    remove(spark, _epoch(root, kind, run, epoch - 2))  # a replay of this epoch needs the one before it, no older one


def count_runs(batch: DataFrame, epoch: int, root: str, run: str = "batch") -> None:
    """One micro-batch ``(uuid, event_id, ts)``: run numbers go on from the state (W5 body).

    Callbacks of a uuid count in order of time, then event id, those without a
    time first.
    """
    spark = batch.sparkSession
    seen = _state(spark, root, run, epoch, RUN_COUNTER_STATE)
    ranked, counts = ordered_positions(batch, ["uuid"], ["ts", "event_id"], with_totals=True, adaptive=True)
    known = F.coalesce("next_run", F.lit(0).cast("long"))
    numbered = ranked.join(seen, "uuid", "left").select("uuid", "event_id", (known + F.col("pos") - 1).alias("run_id"))
    numbered.write.mode("overwrite").parquet(_epoch(root, "out", run, epoch))
    grown = seen.unionByName(counts.select("uuid", F.col("n").alias("next_run"))).groupBy("uuid").agg(F.sum("next_run").alias("next_run"))
    _keep(spark, grown, root, run, epoch)


def expire_nodes(batch: DataFrame, epoch: int, root: str, run: str = "batch", timeout_s: int = HEARTBEAT_TIMEOUT_SECONDS) -> None:
    """One micro-batch ``(node, ts_us)``: a row for every silence over the limit (W3, W4 trigger body).

    A silence ends with the node's next heartbeat, in this batch or a later
    one, or is still open when the latest heartbeat of any node is over the
    limit later; either way it is reported once, with the heartbeat before it.
    Within a slot of the limit's length no two heartbeats are further apart
    than the limit, so first the earliest and latest of each (node, slot) are
    taken, map-side; what is then ordered per node grows with time, not with
    the number of heartbeats. Heartbeats not later than the node's last known
    one are ignored, and so are those without node or time.
    """
    spark = batch.sparkSession
    limit = timeout_s * 1_000_000
    seen = _state(spark, root, run, epoch, LIVENESS_STATE)
    beats = batch.where("node is not null and ts_us is not null").join(seen, "node", "left")
    fresh = beats.where("last_seen_us is null or ts_us > last_seen_us").select("node", "ts_us")
    slots = fresh.groupBy("node", F.floor(F.col("ts_us") / F.lit(limit)).alias("slot")).agg(F.min("ts_us").alias("first"), F.max("ts_us").alias("last"))
    points = slots.select("node", "first", "last", F.lit(False).alias("expired")).unionByName(
        seen.select("node", F.col("last_seen_us").alias("first"), F.col("last_seen_us").alias("last"), "expired")
    )
    now = F.lit(max((r[0] for r in (batch.agg(F.max("ts_us")).first(), seen.agg(F.max("now_us")).first()) if r[0] is not None), default=0))
    ordered = points.withColumn("next", F.lead("first").over(Window.partitionBy("node").orderBy("first", "last")))
    due = F.coalesce("next", now) - F.col("last") > limit
    flagged = ordered.withColumn("due", due)
    out = flagged.where("due and not expired").select("node", F.col("last").alias("last_seen_us"), (F.col("last") + limit).alias("expired_at_us"))
    out.write.mode("overwrite").parquet(_epoch(root, "out", run, epoch))
    # The last point of each node, and whether its silence has been reported.
    kept = flagged.where("next is null").select("node", F.col("last").alias("last_seen_us"), (F.col("expired") | F.col("due")).alias("expired"), now.cast("long").alias("now_us"))
    _keep(spark, kept, root, run, epoch)


def _run(stream: DataFrame, body, root: str, checkpoint_dir: str, out_schema: str, available_now: bool):
    spark = stream.sparkSession
    writer = stream.writeStream.foreachBatch(lambda df, epoch: body(df, epoch, root, query_id(df))).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if not available_now:
        return query
    query.awaitTermination()
    out = f"{root.rstrip('/')}/out/run={query.id}"
    return spark.read.schema(out_schema).parquet(out).drop("epoch")


def run_counter_stream(callbacks: DataFrame, root: str, checkpoint_dir: str, available_now: bool = True):
    """Per-uuid run number 0, 1, 2, ... as callbacks ``(uuid, event_id, ts)`` stream in.

    Returns the numbered callbacks so far, or the running query with ``available_now=False``.
    """
    return _run(callbacks, count_runs, root, checkpoint_dir, RUN_COUNTER_OUT, available_now)


def liveness_stream(heartbeats: DataFrame, root: str, checkpoint_dir: str, available_now: bool = True):
    """Expiry events of nodes silent for longer than the heartbeat timeout (W3, W4 trigger).

    ``heartbeats`` is a stream ``(node, ts_us)``, times as epoch microseconds,
    so no session time zone comes in. Returns ``(node, last_seen_us,
    expired_at_us)`` so far, or the running query.
    """
    return _run(heartbeats, expire_nodes, root, checkpoint_dir, LIVENESS_OUT, available_now)
