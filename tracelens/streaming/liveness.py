"""Node liveness, watchdog timeouts and work-queue state (W3, W4, W6, W7), batch forms.

The streaming form of W3/W4 is in ``streaming.state``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.catalog import STATUS_ERR, WATCHDOG_TIMEOUT_MSG, epoch_us

# Fixed value of the reference: heartbeat timeout (5 minutes).
HEARTBEAT_TIMEOUT_SECONDS = 5 * 60


def node_liveness(nodes: DataFrame, heartbeats: DataFrame, now=None, timeout_s: int = HEARTBEAT_TIMEOUT_SECONDS) -> DataFrame:
    """Last heartbeat per node; expired when never seen or idle longer than the timeout.

    ``now`` defaults to the latest heartbeat seen: one number read from a
    distributed max aggregate.  Idle time keeps whole days (D17).
    """
    last = heartbeats.groupBy("node").agg(F.max("ts").alias("last_ts"))
    if now is None:
        now_us = heartbeats.agg(F.max(epoch_us(F.col("ts")))).first()[0]
    else:
        now_us = heartbeats.sparkSession.range(1).select(epoch_us(F.lit(now).cast("timestamp_ntz"))).first()[0]
    j = nodes.join(last, on="node", how="left")
    idle_us = F.lit(now_us).cast("long") - epoch_us(F.col("last_ts"))
    return j.select(
        "node",
        epoch_us(F.col("last_ts")).alias("last_seen_us"),
        (idle_us / F.lit(1_000_000.0)).alias("idle_s"),
        (F.col("last_ts").isNull() | (idle_us > F.lit(timeout_s * 1_000_000))).alias("expired"),
    )


def timeout_runs(liveness: DataFrame, in_flight: DataFrame) -> DataFrame:
    """Work in flight on an expired node becomes an ERR run."""
    dead = liveness.where("expired").select("node")
    return in_flight.join(dead, on="node", how="left_semi").select(
        "*", F.lit(STATUS_ERR).alias("status"), F.lit(WATCHDOG_TIMEOUT_MSG).alias("status_msg")
    )


def queue_depths(work: DataFrame, state_col: str = "state") -> DataFrame:
    """Number of work items per state."""
    return work.groupBy(state_col).agg(F.count(F.lit(1)).alias("n"))


def in_process_check(in_flight: DataFrame) -> DataFrame:
    """Nodes with more than one item in process: an error state."""
    return in_flight.groupBy("node").agg(F.count(F.lit(1)).alias("n_in_process")).where(F.col("n_in_process") > 1)
