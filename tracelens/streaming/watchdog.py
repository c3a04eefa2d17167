"""The watchdog as a stream: work in flight on a silent node fails, though nothing arrives.

One stream of events carries heartbeats, work that starts and ends, and ticks
of a clock (:func:`with_clock`). The ticks move the present on while every
node is silent, so each micro-batch can tell which silences have grown over
the limit. An item of work fails at the first moment, from its start on, at
which its node has been silent for longer than the limit (at its start, if the
node was never heard of); it then leaves the work in flight, as it does when
it ends. What fails depends on the events' times, not on how they fall into
micro-batches, as long as these come in order of time.

State and output are tables of one epoch each, as in :mod:`.state`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import STATUS_ERR, WATCHDOG_TIMEOUT_MSG
from .liveness import HEARTBEAT_TIMEOUT_SECONDS
from .state import _epoch, _keep, _run, _state

#: kind is beat (of a node), start (of an item on a node), end (of an item) or tick.
EVENTS = "kind string, node long, item string, ts_us long"
FAILED = "node long, item string, failed_at_us long, status string, status_msg string"
_NODES, _ITEMS, _CLOCK = "node long, last_us long", "item string, node long, since_us long", "now_us long"


def with_clock(events: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """The events and a tick a second: a rate source, which has rows for every micro-batch."""
    ticks = events.sparkSession.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    none = [F.lit(None).cast("long").alias("node"), F.lit(None).cast("string").alias("item")]
    return events.unionByName(ticks.select(F.lit("tick").alias("kind"), *none, F.unix_micros("timestamp").alias("ts_us")))


def _silences(beats: DataFrame, seen: DataFrame, now: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Silences (node, last_us, next_us) over the limit up to now, and each node's last heartbeat.

    A null ``last_us`` is the time before a node's first heartbeat. Of a
    slot of the limit's length only the first and the last heartbeat matter.
    """
    fresh = beats.join(seen, "node", "left").where("last_us is null or ts_us > last_us").select("node", "ts_us", F.col("last_us").isNull().alias("new"))
    slots = fresh.groupBy("node", F.floor(F.col("ts_us") / F.lit(limit)).alias("slot")).agg(F.min("ts_us").alias("first"), F.max("ts_us").alias("last"), F.first("new").alias("new"))
    points = slots.select("node", "first", "last", "new").unionByName(seen.select("node", F.col("last_us").alias("first"), F.col("last_us").alias("last"), F.lit(False).alias("new")))
    order = Window.partitionBy("node").orderBy("first", "last")
    ordered = points.select("node", "first", "last", F.lead("first").over(order).alias("next"), (F.col("new") & (F.row_number().over(order) == 1)).alias("begins"))
    long_ones = ordered.where(F.coalesce("next", F.lit(now)) - F.col("last") > limit).select("node", F.col("last").alias("last_us"), F.col("next").alias("next_us"))
    before = ordered.where("begins").select("node", F.lit(None).cast("long").alias("last_us"), F.col("first").alias("next_us"))
    return long_ones.unionByName(before), ordered.where("next is null").select("node", F.col("last").alias("last_us"))


def watch(batch: DataFrame, epoch: int, root: str, run: str = "batch", timeout_s: int = HEARTBEAT_TIMEOUT_SECONDS) -> None:
    """One micro-batch of :data:`EVENTS`: an ERR row for each item that fails. Events without their node, item or time are ignored."""
    spark = batch.sparkSession
    limit = timeout_s * 1_000_000
    seen, items, clock = (_state(spark, root, run, epoch, schema, kind) for schema, kind in ((_NODES, "nodes"), (_ITEMS, "items"), (_CLOCK, "clock")))
    latest = [r[0] for r in (batch.agg(F.max("ts_us")).first(), clock.agg(F.max("now_us")).first()) if r[0] is not None]
    now = max(latest, default=0)
    timed = batch.where("ts_us is not null")
    silences, nodes = _silences(timed.where("kind = 'beat' and node is not null").select("node", "ts_us"), seen, now, limit)
    starts = timed.where("kind = 'start' and node is not null and item is not null").select("item", "node", F.col("ts_us").alias("since_us"))
    # An item that starts again is on its newest node.
    begun = items.unionByName(starts).groupBy("item").agg(F.max(F.struct("since_us", "node")).alias("_s")).select("item", "_s.node", "_s.since_us")
    ends = timed.where("kind = 'end' and item is not null").groupBy("item").agg(F.max("ts_us").alias("_end"))
    open_ = begun.join(ends, "item", "left").withColumn("_end", F.when(F.col("_end") >= F.col("since_us"), F.col("_end")))
    known = nodes.select("node", F.lit(True).alias("_known"))
    unheard = open_.join(known, "node", "left").where("_known is null").select("item", F.col("since_us").alias("at"))
    meets = open_.join(silences, "node").withColumn("at", F.greatest("since_us", F.coalesce(F.col("last_us") + limit + 1, F.col("since_us"))))
    hit = meets.where((F.col("at") < F.coalesce("next_us", F.lit(2**62))) & (F.col("at") <= now)).select("item", "at")
    first = unheard.unionByName(hit).groupBy("item").agg(F.min("at").alias("failed_at_us"))
    judged = open_.join(first, "item", "left").withColumn("_fails", F.col("failed_at_us").isNotNull() & (F.col("_end").isNull() | (F.col("_end") > F.col("failed_at_us"))))
    failed = judged.where("_fails").select("node", "item", "failed_at_us", F.lit(STATUS_ERR).alias("status"), F.lit(WATCHDOG_TIMEOUT_MSG).alias("status_msg"))
    failed.write.mode("overwrite").parquet(_epoch(root, "out", run, epoch))
    _keep(spark, judged.where("not _fails and _end is null").select("item", "node", "since_us"), root, run, epoch, "items")
    _keep(spark, nodes, root, run, epoch, "nodes")
    _keep(spark, spark.range(1).select(F.lit(now).cast("long").alias("now_us")), root, run, epoch, "clock")


def watchdog_stream(events: DataFrame, root: str, checkpoint_dir: str, available_now: bool = True, timeout_s: int = HEARTBEAT_TIMEOUT_SECONDS):
    """ERR rows (:data:`FAILED`) of the items that failed so far, or the running query with ``available_now=False``."""
    return _run(events, lambda df, epoch, at, run: watch(df, epoch, at, run, timeout_s), root, checkpoint_dir, FAILED, available_now)
