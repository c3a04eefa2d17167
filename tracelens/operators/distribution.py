"""Feature-value distributions: pooled stats, repeated draws, KDE (H6-H8).

Values are the entries of the dense feature vectors, pooled by chunk size and
numbered in order of (sample, uuid, run id, feature, bin index). A draw takes
the numbers to which a seeded permutation moves the first ones, so it repeats
none, and hashes as many numbers as it draws, not all values for every draw.
The arithmetic is that of longs and md5, the same in any engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stage_table

# Fixed values of the reference's distribution report.
DRAWS = 50
DRAW_SIZE = 150
KDE_GRID = 100
KDE_CUT = 3.0


#: What tells one extraction's values from another's.
RUN_KEYS = ("sample", "uuid", "run_id")


def pooled_values(features: DataFrame) -> DataFrame:
    """``(chunk_size, sample, uuid, run_id, feature, bin, value)``: every vector entry, with
    the chunk size taken from the feature name's suffix."""
    return features.select(
        F.regexp_extract("feature", r"-([0-9]+)$", 1).cast("long").alias("chunk_size"),
        *RUN_KEYS,
        "feature",
        F.posexplode("feature_data").alias("bin", "value"),
    )


def pooled_distribution(features: DataFrame) -> DataFrame:
    """min, max and number of pooled values per chunk size (H6)."""
    return pooled_values(features).groupBy("chunk_size").agg(
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count(F.lit(1)).alias("n_values")
    )


#: Rounds of the position shuffle.
ROUNDS = 48


def seeded_positions(sizes: DataFrame, draws: int, draw_size: int, seed: str = "") -> DataFrame:
    """``draw_size`` distinct positions below ``_n`` for each draw and row of ``sizes`` (all of them where there are no more).

    Position ``i`` of draw ``d`` is where a seeded permutation of 0..n-1 takes
    ``i``: a swap-or-not shuffle, which is one for every n. In each round x has
    the partner ``k - x`` mod n, and the pair changes places if a hash of its
    larger member is odd.
    """
    text = lambda *parts: F.md5(F.concat_ws(":", F.lit(seed), F.col("draw"), *parts))

    def round_(x: Column, r: Column) -> Column:
        key = F.conv(F.substring(text(r), 1, 13), 16, 10).cast("long") % F.col("_n")
        partner = (key + F.col("_n") - x) % F.col("_n")
        odd = F.substring(text(r, F.greatest(x, partner)), 1, 1).isin(*"13579bdf")
        return F.when(odd, partner).otherwise(x)

    each = sizes.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    picked = each.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(draw_size), F.col("_n")) - 1)))
    return picked.withColumn("position", F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.col("_i"), round_)).drop("_i")


def _vector_places(vectors: DataFrame) -> DataFrame:
    """(chunk_size, _vid, _first, _len): where each vector's values begin among those of its chunk size, in order of keys, feature and row.

    Lengths are summed within ranges of that order, and the ranges' totals before each.
    """
    order = ["chunk_size", *RUN_KEYS, "feature", "_vid"]
    dealt = cut_lineage(vectors.select(*order, F.size("feature_data").cast("long").alias("_len")).where("_len > 0").repartitionByRange(*order).withColumn("_b", F.spark_partition_id()))
    per = dealt.groupBy("chunk_size", "_b").agg(F.sum("_len").alias("_bl"))
    before = Window.partitionBy("chunk_size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("chunk_size", "_b", F.coalesce(F.sum("_bl").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("chunk_size", "_b").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("_in", F.coalesce(F.sum("_len").over(within), F.lit(0))).join(offsets, ["chunk_size", "_b"]).select("chunk_size", "_vid", (F.col("_off") + F.col("_in")).alias("_first"), "_len")


def repeated_samples(features: DataFrame, draws: int = DRAWS, draw_size: int = DRAW_SIZE, seed: str = "") -> DataFrame:
    """``draws`` independent draws of ``draw_size`` values per chunk size,
    without replacement inside a draw (H7).

    Positions are drawn, not values: see :func:`seeded_positions`. The vectors
    are staged once; a position leads to its vector through prefix sums of
    lengths, by an equi-join on cells as wide as the longest vector. What is
    broadcast are the positions, draws x draw_size a chunk size, whatever the
    number of values; no vector is shuffled.
    Output adds ``sampled_pct = draws * draw_size / n * 100``.
    """
    vectors = stage_table(
        features.select(F.regexp_extract("feature", r"-([0-9]+)$", 1).cast("long").alias("chunk_size"), *RUN_KEYS, "feature", "feature_data", F.monotonically_increasing_id().alias("_vid")), "draw-vectors"
    )
    size = F.size("feature_data")
    sizes = vectors.where(size > 0).groupBy("chunk_size").agg(F.sum(size).cast("long").alias("_n"), F.max(size).cast("long").alias("_wide"))
    positions = seeded_positions(stage_table(sizes, "draw-sizes"), draws, draw_size, seed)
    positions = stage_table(positions.withColumn("_cell", F.expr("position div _wide")), "draw-positions")
    wide = positions.select("chunk_size", "_wide").distinct()
    places = _vector_places(vectors).join(F.broadcast(wide), "chunk_size")
    cells = places.withColumn("_cell", F.explode(F.sequence(F.expr("_first div _wide"), F.expr("(_first + _len - 1) div _wide")))).drop("_wide")
    inside = (F.col("position") >= F.col("_first")) & (F.col("position") < F.col("_first") + F.col("_len"))
    picked = cells.join(F.broadcast(positions.drop("_wide")), ["chunk_size", "_cell"]).where(inside)
    picked = stage_table(picked.select("_vid", "draw", "_n", (F.col("position") - F.col("_first")).cast("int").alias("bin")), "draw-picks")
    return vectors.join(F.broadcast(picked), "_vid").select(
        "chunk_size", "draw", *RUN_KEYS, "feature", "bin", F.get("feature_data", F.col("bin")).alias("value"),
        (F.lit(float(draws * draw_size)) / F.col("_n") * F.lit(100.0)).alias("sampled_pct"),
    )


def kde_curve(draws_df: DataFrame, grid: int = KDE_GRID, cut: float = KDE_CUT) -> DataFrame:
    """Gaussian kernel density of each draw on a regular grid (H8).

    Bandwidth by Scott's rule (sample std x n^(-1/5)); the grid spans
    ``[min - cut*h, max + cut*h]``.  A draw holds ``draw_size`` values (150),
    so gathering one draw into an array is bounded.  Degenerate draws (zero
    spread) get a null density.
    """
    per = draws_df.groupBy("chunk_size", "draw").agg(
        F.collect_list(F.col("value").cast("double")).alias("_v"),
        F.stddev_samp(F.col("value").cast("double")).alias("_sd"),
        F.min("value").alias("_lo"),
        F.max("value").alias("_hi"),
        F.count(F.lit(1)).alias("_n"),
    )
    h = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    per = per.withColumn("_bw", h)
    start = F.col("_lo") - F.lit(cut) * F.col("_bw")
    step = (F.col("_hi") - F.col("_lo") + F.lit(2 * cut) * F.col("_bw")) / F.lit(grid - 1)
    pts = per.select(
        "chunk_size", "draw", "_v", "_bw", "_n",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: start + i * step)).alias("gi", "x"),
    )
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    dens = F.aggregate(
        "_v", F.lit(0.0), lambda acc, v: acc + F.exp(F.lit(-0.5) * F.pow((F.col("x") - v) / F.col("_bw"), F.lit(2.0)))
    ) * norm / (F.col("_n") * F.col("_bw"))
    return pts.select(
        "chunk_size", "draw", "gi", "x", F.when(F.col("_bw") > 0, dens).alias("density")
    )
