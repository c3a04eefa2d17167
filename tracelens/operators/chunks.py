"""Chunking by occurrence and chunk deltas (all modes in one aggregate).

A chunk of size ``n`` is positions ``[i*n, (i+1)*n)`` of the access-filtered
trace; the trailing partial chunk is kept.  Per chunk we keep five values -
count, exact sum, min, max and the first target - from which every delta mode
follows:

* ``SUM_ABS_REF`` = ``abs(sum - count*first)`` (absolute value of the sum)
* ``SUM_REF_ASC`` = ``sum - count*first``
* ``MAX_REF``     = ``max - first``
* ``MIN_REF``     = ``min - first``
* ``MEAN``        = ``(sum - count*first) / count`` (exact numerator)

A one-row chunk gives 0 in every mode.

Targets are 64-bit words (LONG, see ``functions.trace.hex_to_word``).  The
per-row work stays in long arithmetic inside codegen: the sum is split into
high and low 32-bit halves (each half-sum fits a long for any chunk below
2^31 rows) and min/max/first use the sign-flipped word, which orders like the
unsigned address.  The exact unsigned values are rebuilt as DECIMAL(38,0)
only on the per-chunk table, which is ``rows / chunk`` rows.

All chunk sizes are aggregated at their greatest common divisor and rolled
up, so the trace is aggregated once whatever the number of sizes.  When the
gcd is below 16 (roll-up would save little) every size is aggregated directly
from the positions, still in one aggregate over exploded sizes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import DEFAULT_BUCKET_ROWS, access_positions

# Delta modes and the default extraction grid of the reference
# extractor.  SUM_ABS_REF is the default mode and is skipped by the grid loop,
# giving 3 access types x 3 chunk sizes x 4 modes = 36 features.
ALL_MODES = ("SUM_ABS_REF", "SUM_REF_ASC", "MAX_REF", "MIN_REF", "MEAN")
GRID_MODES = ("SUM_REF_ASC", "MAX_REF", "MIN_REF", "MEAN")
GRID_CHUNK_SIZES = (1000, 2000, 5000)
GRID_ACCESS = ("R", "W", "RW")
DEFAULT_CHUNK_SIZE = 10000
MIN_CHUNKS_FOR_HISTOGRAM = 3
FEATURE_FAMILY = "ext-mem-rw-dump"
FEATURE_VERSION = "0.0.1"

_MIN_LONG = -9223372036854775808
_TWO_63 = 9223372036854775808
_TWO_32 = 4294967296
# Below this gcd, rolling chunks up saves little: aggregate each size directly.
_MIN_USEFUL_GCD = 16


def feature_name(access: Column, mode: Column, chunk_size: Column) -> Column:
    """``"{access}-MemOffsetMode.{mode}-{chunk}"`` (F8)."""
    return F.format_string("%s-MemOffsetMode.%s-%d", access, mode, chunk_size)


def _flip(c: Column) -> Column:
    # Sign-bit flip: signed order of the result == unsigned order of the word.
    return c.bitwiseXOR(F.lit(_MIN_LONG))


def _stats(df: DataFrame, group: list[str], pos: str, tgt: str) -> DataFrame:
    """Per-chunk count, hi/lo half sums, flipped min/max/first of ``tgt``."""
    f = _flip(F.col(tgt))
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.shiftrightunsigned(F.col(tgt), 32)).alias("sum_hi"),
        F.sum(F.col(tgt).bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_lo"),
        F.min(f).alias("min_f"),
        F.max(f).alias("max_f"),
        F.min_by(f, F.col(pos)).alias("first_f"),
        F.max("n_rows").alias("n_rows"),
    )


def _rollup(stats: DataFrame, keys: list[str], base: int, sizes: Sequence[int]) -> DataFrame:
    """Roll base-size chunk stats up to every size in ``sizes`` (multiples of base)."""
    factors = F.array(*[F.struct(F.lit(n).alias("chunk_size"), F.lit(n // base).alias("_k")) for n in sizes])
    exploded = stats.select("*", F.inline(factors))
    if len(sizes) == 1 and sizes[0] == base:
        return exploded.drop("_k").withColumnRenamed("_c", "chunk_id")
    return (
        exploded.withColumn("chunk_id", F.expr("_c div _k"))
        .groupBy(*keys, "access", "chunk_size", "chunk_id")
        .agg(
            F.sum("cnt").alias("cnt"),
            F.sum("sum_hi").alias("sum_hi"),
            F.sum("sum_lo").alias("sum_lo"),
            F.min("min_f").alias("min_f"),
            F.max("max_f").alias("max_f"),
            F.min_by("first_f", "_c").alias("first_f"),
            F.max("n_rows").alias("n_rows"),
        )
    )


def chunk_stats(
    trace: DataFrame,
    keys: Sequence[str],
    chunk_sizes: Sequence[int] = GRID_CHUNK_SIZES,
    access_types: Sequence[str] = GRID_ACCESS,
    order_cols: Sequence[str] = ("seq",),
    rw_col: str = "rw",
    tgt_col: str = "tgt",
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    positions: DataFrame | None = None,
    adaptive_buckets: bool = False,
) -> DataFrame:
    """Per-chunk statistics for every (trace, access, chunk size, chunk).

    Columns: ``keys, access, chunk_size, chunk_id, cnt, n_rows`` plus the
    exact unsigned ``sum_u, min_u, max_u, first_u`` (DECIMAL).  ``n_rows`` is
    the number of rows of the access-filtered trace; it comes with the
    positions (from the rank's small offset table), so no second pass over
    the trace is needed for the row and chunk-count gates.
    """
    keys = list(keys)
    sizes = sorted(set(int(n) for n in chunk_sizes))
    if not sizes or sizes[0] <= 0:
        raise ValueError("chunk sizes must be positive")
    pos = positions if positions is not None else access_positions(
        trace, keys, order_cols=order_cols, rw_col=rw_col, carry=[tgt_col], bucket_rows=bucket_rows,
        adaptive=adaptive_buckets,
    )
    pos = pos.where(F.col("access").isin(list(access_types)))

    g = reduce(math.gcd, sizes)
    if g >= _MIN_USEFUL_GCD or len(sizes) == 1:
        base = pos.withColumn("_c", F.expr(f"(pos - 1) div {g}"))
        stats = _rollup(_stats(base, [*keys, "access", "_c"], "pos", tgt_col), keys, g, sizes)
    else:
        per_size = pos.select(
            "*", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("chunk_size")
        ).withColumn("chunk_id", F.expr("(pos - 1) div chunk_size"))
        stats = _stats(per_size, [*keys, "access", "chunk_size", "chunk_id"], "pos", tgt_col)

    two32 = F.lit(str(_TWO_32)).cast("decimal(38,0)")
    two63 = F.lit(str(_TWO_63)).cast("decimal(20,0)")

    def unsigned(c: str) -> Column:
        return (F.col(c).cast("decimal(20,0)") + two63).cast("decimal(20,0)")

    return stats.select(
        *keys,
        "access",
        "chunk_size",
        "chunk_id",
        "cnt",
        "n_rows",
        (F.col("sum_hi").cast("decimal(38,0)") * two32 + F.col("sum_lo").cast("decimal(38,0)"))
        .cast("decimal(38,0)")
        .alias("sum_u"),
        unsigned("min_f").alias("min_u"),
        unsigned("max_f").alias("max_u"),
        unsigned("first_f").alias("first_u"),
    )


def _mode_num(mode: str) -> Column:
    """Exact numerator of a mode's delta (DECIMAL(38,0)); denominator is 1 except MEAN."""
    sum_ref = (F.col("sum_u") - F.col("cnt").cast("decimal(20,0)") * F.col("first_u")).cast("decimal(38,0)")
    if mode == "SUM_ABS_REF":
        return F.abs(sum_ref)
    if mode in ("SUM_REF_ASC", "MEAN"):
        return sum_ref
    if mode == "MAX_REF":
        return (F.col("max_u") - F.col("first_u")).cast("decimal(38,0)")
    if mode == "MIN_REF":
        return (F.col("min_u") - F.col("first_u")).cast("decimal(38,0)")
    raise ValueError(f"unknown delta mode {mode!r}")


def deltas_from_stats(stats: DataFrame, keys: Sequence[str], modes: Sequence[str] = GRID_MODES) -> DataFrame:
    """Unpivot chunk statistics into one delta row per mode.

    Columns: ``keys, access, chunk_size, mode, chunk_id, n_rows, delta_num,
    delta_den, delta`` where ``delta = delta_num / delta_den`` as DECIMAL(38,6).
    """
    keys = list(keys)

    def entry(m: str):
        num = _mode_num(m)
        den = F.col("cnt") if m == "MEAN" else F.lit(1).cast("long")
        delta = (num / den.cast("decimal(20,0)")).cast("decimal(38,6)")
        return F.struct(F.lit(m).alias("mode"), num.alias("delta_num"), den.alias("delta_den"), delta.alias("delta"))

    # One projection (no trailing withColumn): the plan is analysed once.
    return stats.select(
        *keys, "access", "chunk_size", "chunk_id", "n_rows", F.inline(F.array(*[entry(m) for m in modes]))
    )


def chunk_deltas(
    trace: DataFrame,
    keys: Sequence[str],
    chunk_sizes: Sequence[int] = GRID_CHUNK_SIZES,
    modes: Sequence[str] = GRID_MODES,
    access_types: Sequence[str] = GRID_ACCESS,
    order_cols: Sequence[str] = ("seq",),
    rw_col: str = "rw",
    tgt_col: str = "tgt",
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    min_rows_gate: bool = True,
    adaptive_buckets: bool = False,
) -> DataFrame:
    """Chunk deltas for the whole (access x chunk size x mode) grid in one pass.

    With ``min_rows_gate`` (C8) a (trace, access, chunk size) is skipped when
    the filtered trace has fewer rows than the chunk size.
    """
    stats = chunk_stats(
        trace, keys, chunk_sizes, access_types, order_cols, rw_col, tgt_col, bucket_rows,
        adaptive_buckets=adaptive_buckets,
    )
    if min_rows_gate:
        stats = stats.where(F.col("n_rows") >= F.col("chunk_size"))
    return deltas_from_stats(stats, keys, modes)


def chunk_delta(
    trace: DataFrame,
    keys: Sequence[str],
    mode: str = "SUM_ABS_REF",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    access: str = "RW",
    **kw,
) -> DataFrame:
    """One mode, one chunk size, one access type (C2-C6 called directly).

    Called directly there is no row gate: a trace shorter than the chunk gives
    one chunk, as in the reference's direct call.
    """
    return chunk_deltas(
        trace, keys, [chunk_size], [mode], [access.upper()], min_rows_gate=False, **kw
    )


def chunk_counts(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of chunks per (trace, access, chunk size, mode)."""
    return deltas.groupBy(*keys, "access", "chunk_size", "mode").agg(F.count(F.lit(1)).alias("n_chunks"))


def min_chunks_gate(deltas: DataFrame, keys: Sequence[str], min_chunks: int = MIN_CHUNKS_FOR_HISTOGRAM) -> DataFrame:
    """Keep only features with at least ``min_chunks`` chunks.

    Chunks partition positions ``1..n_rows``, so a feature has
    ``ceil(n_rows / chunk_size)`` chunks: a row filter, no aggregate.  Without
    an ``n_rows`` column the count is a small aggregate joined back.
    """
    keys = list(keys)
    if "n_rows" in deltas.columns:
        n_chunks = F.ceil(F.col("n_rows") / F.col("chunk_size"))
        return deltas.where(n_chunks >= F.lit(min_chunks))
    counts = chunk_counts(deltas, keys).where(F.col("n_chunks") >= min_chunks)
    return deltas.join(counts.drop("n_chunks"), on=[*keys, "access", "chunk_size", "mode"], how="left_semi")


def raw_deltas(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Debug output (C10): the ordered chunk deltas of every feature.

    Kept in long form ``(keys, feature, chunk_id, delta)`` - the list order is
    ``chunk_id`` - because one feature of a long trace can have millions of
    chunks, too many to gather into one array value.  Not subject to C9.
    """
    return deltas.select(
        *keys,
        feature_name(F.col("access"), F.col("mode"), F.col("chunk_size")).alias("feature"),
        "chunk_id",
        "delta",
    )
