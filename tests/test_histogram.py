"""Histograms: numpy cross-check, fixed-range edges, metadata."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelens.operators import histogram as H

KEYS = ["sample"]


def _deltas(spark, values, chunk_size=1000, mode="SUM_REF_ASC", den=1):
    # One delta per full chunk: the trace has len(values) * chunk_size rows.
    n_rows = len(values) * chunk_size
    rows = [("s", "R", chunk_size, mode, i, n_rows, int(v), den) for i, v in enumerate(values)]
    df = spark.createDataFrame(
        rows, "sample string, access string, chunk_size int, mode string, chunk_id long, n_rows long, num long, den long"
    )
    return df.select(
        "*", F.col("num").cast("decimal(38,0)").alias("delta_num"), F.col("den").alias("delta_den"),
        (F.col("num").cast("decimal(38,0)") / F.col("den").cast("decimal(20,0)")).cast("decimal(38,6)").alias("delta"),
    ).drop("num", "den")


@pytest.mark.parametrize("size", [1000, 2000, 5000])
def test_matches_numpy_on_random_and_edges(spark, size):
    lo, hi = H.HISTOGRAM_RANGES[size]
    rng = np.random.default_rng(size)
    width = (hi - lo) / 1024
    edges = [int(np.ceil(lo + k * width)) for k in range(0, 1025, 97)]
    values = list(rng.integers(lo - (hi - lo) // 10, hi + (hi - lo) // 10, 3000)) + [lo, hi, lo - 1, hi + 1] + edges
    got = H.feature_vectors(_deltas(spark, values, size), KEYS).first()
    want, _ = np.histogram(np.array(values, dtype=np.int64), range=(lo, hi), bins=1024)
    assert got["feature_data"] == want.tolist()


def test_bin_edges_first_last_dropped(spark):
    lo, hi = H.HISTOGRAM_RANGES[1000]
    d = _deltas(spark, [lo, hi, lo - 1, hi + 1])
    rows = {int(r["delta_num"]): r for r in H.with_bins(d).collect()}
    assert rows[lo]["bin"] == 0 and rows[hi]["bin"] == 1023
    assert not rows[lo - 1]["in_range"] and not rows[hi + 1]["in_range"]


def test_unknown_chunk_size_errors(spark):
    with pytest.raises(Exception):
        H.with_bins(_deltas(spark, [1, 2, 3], chunk_size=777)).collect()


def test_metadata_truncates_toward_zero(spark):
    vals = [-7, -3, 2]
    m = H.histogram_metadata(_deltas(spark, vals), KEYS).first()
    assert int(m["histogram_min"]) == -7 and int(m["histogram_max"]) == 2
    assert int(m["histogram_mean"]) == int(np.mean(vals))  # -2.67 -> -2
    assert int(m["histogram_std_dev"]) == int(np.std(vals, ddof=1))


def test_mean_mode_exact_rational_bins(spark):
    lo, hi = H.HISTOGRAM_RANGES[1000]
    # num/den exactly on an inner edge: bin boundary decided without rounding.
    width_num = hi - lo
    num = lo * 3 + width_num * 3 * 5 // 1024  # = 3 * (lo + 5 * width)
    d = _deltas(spark, [num], mode="MEAN", den=3)
    b = H.with_bins(d).first()["bin"]
    assert b == 5
