"""Registered queries: one per operator family of the survey inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole test
tables.  Output columns are plain (BIGINT / DOUBLE rounded to 6 places /
STRING) so that they compare one-to-one with ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import trace as TF
from ..operators import chunks as C
from ..operators import histogram as H
from . import adapters as A

from .registry import QUERIES, Query, register  # noqa: F401


def _r6(c):
    return F.round(c.cast("double"), 6)


def _delta_out(d: DataFrame) -> DataFrame:
    return d.select(
        "sample", "access", F.col("chunk_size").cast("long").alias("chunk_size"), "mode",
        F.col("chunk_id").cast("long").alias("chunk_id"), _r6(F.col("delta")).alias("delta"),
    )


# -- trace parsing and chunking (F1-F3, C1-C10) -----------------------------

@register("trace_parse")
def trace_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse tracer lines (F1), convert hex (F2); comment lines and 16-byte
    accesses drop out."""
    from ..sources.readers import parse_trace

    lines = A.events_trace_text(spark, sf_dir).where(~F.col("value").startswith("#"))
    parsed = parse_trace(lines, keep=["sample", "seq"])
    return parsed.select(
        "sample", "seq", F.col("ins").cast("long").alias("ins"), "rw",
        TF.word_to_unsigned(F.col("tgt")).cast("long").alias("tgt"),
    )


@register("access_filter_counts")
def access_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept per trace by each access filter r / w / rw."""
    tr = A.events_trace(spark, sf_dir)
    return tr.groupBy("sample").agg(
        *[F.count_if(TF.access_filter(F.col("rw"), a)).alias(f"n_{a}") for a in ("r", "w", "rw")]
    )


@register("chunk_deltas_all_modes")
def chunk_deltas_all_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole (access x chunk x mode) grid in one pass, row gate on."""
    tr = A.events_trace(spark, sf_dir)
    return _delta_out(C.chunk_deltas(tr, A.TRACE_KEYS, A.EVENTS_CHUNKS))


def _single_mode(mode: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        tr = A.events_trace(spark, sf_dir)
        return _delta_out(C.chunk_delta(tr, A.TRACE_KEYS, mode=mode, chunk_size=100, access="RW"))

    q.__doc__ = f"{mode} deltas of 100-access chunks over R and W accesses (direct call, no gate)."
    return q


for _m in C.ALL_MODES:
    register(f"chunk_delta_{_m.lower()}")(_single_mode(_m))


@register("chunk_deltas_lineitem")
def chunk_deltas_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid over supplier traces ordered by all lineitem columns (keys repeat)."""
    tr = A.lineitem_trace(spark, sf_dir)
    return _delta_out(
        C.chunk_deltas(tr, A.TRACE_KEYS, A.LINEITEM_CHUNKS, order_cols=A.LINEITEM_ORDER)
    )


@register("raw_deltas")
def raw_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debug output: ordered raw deltas of every feature, no chunk-count gate."""
    tr = A.events_trace(spark, sf_dir)
    d = C.chunk_deltas(tr, A.TRACE_KEYS, A.EVENTS_CHUNKS)
    return C.raw_deltas(d, A.TRACE_KEYS).select(
        "sample", "feature", F.col("chunk_id").cast("long").alias("chunk_id"), _r6(F.col("delta")).alias("delta")
    )


def _events_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk_deltas(A.events_trace(spark, sf_dir), A.TRACE_KEYS, A.EVENTS_CHUNKS, modes=C.GRID_MODES)


@register("delta_histogram")
def delta_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse fixed-range histogram bins, out-of-range dropped, >= 3 chunks."""
    h = H.delta_histogram(_events_deltas(spark, sf_dir), A.TRACE_KEYS, A.EVENTS_RANGES)
    return h.select(
        "sample", "access", F.col("chunk_size").cast("long").alias("chunk_size"), "mode",
        F.col("bin").cast("long").alias("bin"), "n",
    )


@register("histogram_metadata")
def histogram_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min / max / mean / sample std of deltas before clipping, truncated (H3)."""
    m = H.histogram_metadata(_events_deltas(spark, sf_dir), A.TRACE_KEYS)
    return m.select(
        "sample", "access", F.col("chunk_size").cast("long").alias("chunk_size"), "mode",
        *[F.col(c).cast("long").alias(c) for c in ("histogram_min", "histogram_max", "histogram_mean", "histogram_std_dev")],
    )


@register("feature_vectors")
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense 1024-bin feature vectors with metadata, one row per feature (H4)."""
    fv = H.feature_vectors(_events_deltas(spark, sf_dir), A.TRACE_KEYS, A.EVENTS_RANGES)
    return fv.select(
        "sample", "feature",
        F.array_join(F.col("feature_data").cast("array<string>"), ",").alias("feature_data"),
        F.aggregate("feature_data", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_binned"),
        *[F.col(c).cast("long").alias(c) for c in ("histogram_min", "histogram_max", "histogram_mean", "histogram_std_dev")],
    )


@register("range_monitor")
def range_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed delta range and out-of-range count per chunk size (H5)."""
    r = H.range_monitor(_events_deltas(spark, sf_dir), A.EVENTS_RANGES)
    return r.select(
        F.col("chunk_size").cast("long").alias("chunk_size"),
        _r6(F.col("observed_min")).alias("observed_min"),
        _r6(F.col("observed_max")).alias("observed_max"),
        "range_lo", "range_hi", "n_deltas", "n_out_of_range",
    )
