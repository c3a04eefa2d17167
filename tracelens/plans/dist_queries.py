"""Registered queries: feature-value distributions and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import distribution as D
from ..operators import histogram as H
from ..operators import quality as Q
from . import adapters as A
from .oracle import _HIST_BASE
from .registry import register


def _features(spark, sf_dir):
    d = C.chunk_deltas(A.events_trace(spark, sf_dir), A.TRACE_KEYS, A.EVENTS_CHUNKS, modes=C.GRID_MODES)
    return H.feature_vectors(d, A.TRACE_KEYS, A.EVENTS_RANGES)


_VALS = _HIST_BASE + """,
vals AS (
  SELECT f.chunk_size, f.sample, printf('%s-MemOffsetMode.%s-%d', f.access, f.mode, f.chunk_size) AS feature,
         CAST(r.i AS BIGINT) AS bin, CAST(coalesce(h.n, 0) AS BIGINT) AS value
  FROM feat f CROSS JOIN range(0, 1024) r(i)
  LEFT JOIN hist h ON h.sample = f.sample AND h.access = f.access AND h.chunk_size = f.chunk_size
                  AND h.mode = f.mode AND h.bin = r.i)"""


@register("pooled_distribution", _VALS + """
SELECT chunk_size, min(value) AS min_value, max(value) AS max_value, count(*) AS n_values
FROM vals GROUP BY chunk_size""")
def pooled_distribution(spark, sf_dir):
    """All feature values pooled by chunk size: min, max, count (H6)."""
    return D.pooled_distribution(_features(spark, sf_dir))


_DRAWS_SQL = _VALS.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
nper AS (SELECT chunk_size, count(*) AS n FROM vals GROUP BY chunk_size),
numbered AS (SELECT *, row_number() OVER (PARTITION BY chunk_size ORDER BY sample, feature, bin) - 1 AS position FROM vals),
shuffled AS (
  SELECT chunk_size, n, CAST(d.draw AS INTEGER) AS draw, i.i AS slot, 0 AS r, CAST(i.i AS BIGINT) AS x
  FROM nper CROSS JOIN range(0, {D.DRAWS}) d(draw) CROSS JOIN range(0, {D.DRAW_SIZE}) i(i) WHERE i.i < n
  UNION ALL
  SELECT chunk_size, n, draw, slot, r + 1,
         CASE WHEN substr(md5(':' || draw || ':' || r || ':' || greatest(x, y)), 1, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') THEN y ELSE x END
  FROM (SELECT *, ((('0x' || substr(md5(':' || draw || ':' || r), 1, 13))::BIGINT % n) + n - x) % n AS y FROM shuffled WHERE r < {D.ROUNDS})),
sel AS (
  SELECT v.*, s.draw, s.n FROM numbered v JOIN (SELECT * FROM shuffled WHERE r = {D.ROUNDS}) s
  ON s.chunk_size = v.chunk_size AND s.x = v.position)"""


@register("repeated_samples", _DRAWS_SQL + """
SELECT chunk_size, draw, sample, feature, bin, value, round(50 * 150 / CAST(n AS DOUBLE) * 100, 6) AS sampled_pct
FROM sel""")
def repeated_samples(spark, sf_dir):
    """50 seeded draws of 150 pooled values per chunk size, no repeats within a draw (H7)."""
    r = D.repeated_samples(_features(spark, sf_dir))
    return r.select(
        "chunk_size", "draw", "sample", "feature", F.col("bin").cast("long").alias("bin"), "value",
        F.round("sampled_pct", 6).alias("sampled_pct"),
    )


@register("kde_curve", _DRAWS_SQL + """,
drawn AS (SELECT chunk_size, draw, CAST(value AS DOUBLE) AS v FROM sel),
per AS (
  SELECT chunk_size, draw, count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
         stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw
  FROM drawn GROUP BY chunk_size, draw),
grid AS (
  SELECT per.*, CAST(g.i AS INTEGER) AS gi,
         (lo - 3.0 * bw) + g.i * ((hi - lo + 6.0 * bw) / 99) AS x
  FROM per CROSS JOIN range(0, 100) g(i))
SELECT grid.chunk_size, grid.draw, gi, round(x, 6) AS x,
       round(CASE WHEN bw > 0 THEN sum(exp(-0.5 * pow((x - drawn.v) / bw, 2.0))) * (1.0 / sqrt(2 * pi())) / (n * bw) END, 9) AS density
FROM grid JOIN drawn USING (chunk_size, draw)
GROUP BY grid.chunk_size, grid.draw, gi, x, bw, n""")
def kde_curve(spark, sf_dir):
    """Gaussian KDE of every draw on a 100-point grid, Scott bandwidth (H8)."""
    k = D.kde_curve(D.repeated_samples(_features(spark, sf_dir)))
    return k.select("chunk_size", "draw", "gi", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@register("feature_coverage", _HIST_BASE + """
SELECT printf('%s-MemOffsetMode.%s-%d', access, mode, chunk_size) AS feature, count(DISTINCT sample) AS n_samples
FROM meta GROUP BY ALL""")
def feature_coverage(spark, sf_dir):
    """Distinct feature names and how many samples have each."""
    return Q.feature_coverage(_features(spark, sf_dir).select("sample", "feature"))
