"""Fixed-range histograms of chunk deltas and their metadata (H1-H5).

Bins are computed from the exact delta ``num / den``:

    in range  <=>  lo*den <= num <= hi*den
    bin        =   min((num - lo*den) * BINS div ((hi - lo) * den), BINS - 1)

which equals numpy's ``histogram(range=(lo, hi), bins=1024)`` for integer
deltas (all edges of the fixed ranges are exact in double) and is the exact
rational answer for MEAN.  Out-of-range deltas are dropped; the last bin is
closed on the right.  Only the per-chunk table (``rows / chunk`` rows) is
touched here and the result has at most BINS rows per feature, so the dense
vector is built from a bounded group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.catalog import truncate
from .chunks import MIN_CHUNKS_FOR_HISTOGRAM, feature_name, min_chunks_gate

# Histogram ranges per chunk size and the bin count of the
# reference extractor.  Other chunk sizes have no range (an error unless the
# caller passes its own table).
HISTOGRAM_RANGES: dict[int, tuple[int, int]] = {
    1000: (-318537000000000, 365617000000000),
    2000: (-18397000000000, 17959000000000),
    5000: (-343961000000000, 359544000000000),
}
BINS = 1024


def _check_sizes(deltas: DataFrame, ranges: Mapping[int, tuple[int, int]]) -> Column:
    known = [int(n) for n in ranges]
    return F.when(
        ~F.col("chunk_size").isin(known),
        F.raise_error(F.format_string("no histogram range for chunk size %d", F.col("chunk_size"))),
    )


def with_bins(deltas: DataFrame, ranges: Mapping[int, tuple[int, int]] = HISTOGRAM_RANGES, bins: int = BINS) -> DataFrame:
    """Add ``lo, hi, in_range, bin`` to a delta table (H1, H2).

    The range table has one row per chunk size: it is attached as a CASE
    expression, not a join, so no exchange is planned for it.
    """
    lo = F.lit(None).cast("long")
    hi = F.lit(None).cast("long")
    for n, (a, b) in ranges.items():
        lo = F.when(F.col("chunk_size") == n, F.lit(int(a))).otherwise(lo)
        hi = F.when(F.col("chunk_size") == n, F.lit(int(b))).otherwise(hi)
    # Unknown chunk size -> error, as a missing key is in the reference.
    lo = F.coalesce(lo, _check_sizes(deltas, ranges).cast("long"))
    dec = "decimal(38,0)"
    den = F.col("delta_den").cast(dec)
    lo_d = F.col("lo").cast(dec) * den
    hi_d = F.col("hi").cast(dec) * den
    in_range = (F.col("delta_num") >= lo_d) & (F.col("delta_num") <= hi_d)
    width = ((F.col("hi") - F.col("lo")).cast(dec) * den).cast(dec)
    scaled = ((F.col("delta_num") - lo_d).cast(dec) * F.lit(bins).cast(dec)).cast(dec)
    out = deltas.withColumn("lo", lo).withColumn("hi", hi).withColumn("in_range", in_range)
    raw_bin = F.when(F.col("in_range"), F.least(F.expr("`_scaled` div `_width`"), F.lit(bins - 1)))
    return (
        out.withColumn("_scaled", F.when(F.col("in_range"), scaled))
        .withColumn("_width", width)
        .withColumn("bin", raw_bin.cast("int"))
        .drop("_scaled", "_width")
    )


def delta_histogram(
    deltas: DataFrame,
    keys: Sequence[str],
    ranges: Mapping[int, tuple[int, int]] = HISTOGRAM_RANGES,
    bins: int = BINS,
    min_chunks: int = MIN_CHUNKS_FOR_HISTOGRAM,
) -> DataFrame:
    """Sparse histogram ``(keys, access, chunk_size, mode, bin, n)`` (H1).

    Features with fewer than ``min_chunks`` chunks are skipped (C9); empty
    bins are absent (see :func:`feature_vectors` for the dense form).
    """
    keys = list(keys)
    gated = min_chunks_gate(deltas, keys, min_chunks)
    binned = with_bins(gated, ranges, bins).where(F.col("in_range"))
    return binned.groupBy(*keys, "access", "chunk_size", "mode", "bin").agg(F.count(F.lit(1)).alias("n"))


def histogram_metadata(
    deltas: DataFrame, keys: Sequence[str], min_chunks: int = MIN_CHUNKS_FOR_HISTOGRAM
) -> DataFrame:
    """min, max, mean and sample std of the deltas before range clipping,
    truncated toward zero (H3).  Only features that get a histogram (C9)."""
    keys = list(keys)
    gated = min_chunks_gate(deltas, keys, min_chunks)
    agg = gated.groupBy(*keys, "access", "chunk_size", "mode").agg(
        F.min("delta").alias("_min"),
        F.max("delta").alias("_max"),
        F.avg("delta").alias("_mean"),
        F.stddev_samp(F.col("delta").cast("double")).alias("_std"),
    )
    return agg.select(
        *keys,
        "access",
        "chunk_size",
        "mode",
        truncate(F.col("_min")).cast("decimal(38,0)").alias("histogram_min"),
        truncate(F.col("_max")).cast("decimal(38,0)").alias("histogram_max"),
        truncate(F.col("_mean")).cast("decimal(38,0)").alias("histogram_mean"),
        truncate(F.col("_std")).cast("decimal(38,0)").alias("histogram_std_dev"),
    )


def feature_vectors(
    deltas: DataFrame,
    keys: Sequence[str],
    ranges: Mapping[int, tuple[int, int]] = HISTOGRAM_RANGES,
    bins: int = BINS,
    min_chunks: int = MIN_CHUNKS_FOR_HISTOGRAM,
) -> DataFrame:
    """Dense feature table ``(keys, feature, feature_data ARRAY<LONG>, histogram_*)`` (H3, H4).

    One pass over the deltas: a grouping-sets aggregate yields both the
    per-bin counts (set ``feature, bin``) and the metadata over all deltas of
    the feature (set ``feature``), map-side combined.  A second aggregate
    gathers a feature's bins - at most ``bins`` entries - in order, with zeros
    between them.  Features whose deltas all fall out
    of range still get a vector of zeros, as numpy's histogram does.
    """
    keys = list(keys)
    fkeys = [*keys, "access", "chunk_size", "mode"]
    binned = with_bins(min_chunks_gate(deltas, keys, min_chunks), ranges, bins)
    per_set = binned.groupingSets([[*fkeys, "bin"], fkeys], *fkeys, "bin").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("delta").alias("_min"),
        F.max("delta").alias("_max"),
        F.avg("delta").alias("_mean"),
        F.stddev_samp(F.col("delta").cast("double")).alias("_std"),
        F.grouping_id().alias("_gid"),
    )
    is_bin = (F.col("_gid") == 0) & F.col("bin").isNotNull()
    is_all = F.col("_gid") != 0
    per_feature = per_set.groupBy(*fkeys).agg(
        F.array_sort(F.collect_list(F.when(is_bin, F.struct(F.col("bin").cast("int").alias("bin"), "_n")))).alias("_m"),
        F.max(F.when(is_all, F.col("_min"))).alias("_min"),
        F.max(F.when(is_all, F.col("_max"))).alias("_max"),
        F.max(F.when(is_all, F.col("_mean"))).alias("_mean"),
        F.max(F.when(is_all, F.col("_std"))).alias("_std"),
    )
    # Zeros up to each entry, the entry, and zeros behind the last: linear in the bins, no lookups.
    zero = F.lit(0).cast("long")
    before = lambda i: F.when(i > 0, F.col("_m")[i - 1]["bin"]).otherwise(F.lit(-1))
    filled = F.transform("_m", lambda e, i: F.concat(F.array_repeat(zero, e["bin"] - before(i) - 1), F.array(e["_n"])))
    last = F.coalesce(F.try_element_at("_m", F.lit(-1))["bin"], F.lit(-1))
    dense = F.concat(F.flatten(filled), F.array_repeat(zero, F.lit(bins - 1) - last))
    return per_feature.select(
        *keys,
        feature_name(F.col("access"), F.col("mode"), F.col("chunk_size")).alias("feature"),
        "access",
        "chunk_size",
        "mode",
        dense.alias("feature_data"),
        truncate(F.col("_min")).cast("decimal(38,0)").alias("histogram_min"),
        truncate(F.col("_max")).cast("decimal(38,0)").alias("histogram_max"),
        truncate(F.col("_mean")).cast("decimal(38,0)").alias("histogram_mean"),
        truncate(F.col("_std")).cast("decimal(38,0)").alias("histogram_std_dev"),
    )


def range_monitor(
    deltas: DataFrame, ranges: Mapping[int, tuple[int, int]] = HISTOGRAM_RANGES
) -> DataFrame:
    """Observed delta range per chunk size and how many fall outside the fixed range (H5)."""
    binned = with_bins(deltas, ranges)
    return binned.groupBy("chunk_size").agg(
        F.min("delta").alias("observed_min"),
        F.max("delta").alias("observed_max"),
        F.min("lo").alias("range_lo"),
        F.max("hi").alias("range_hi"),
        F.count(F.lit(1)).alias("n_deltas"),
        F.sum((~F.col("in_range")).cast("long")).alias("n_out_of_range"),
    )
