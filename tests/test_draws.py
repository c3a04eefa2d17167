"""Seeded draws of positions, subsets by hash cuts, ROC buckets by counted scores."""

import hashlib
import random

from pyspark.sql import functions as F

from tracelens.operators import distribution as D
from tracelens.operators import metrics as M
from tracelens.operators import sampling as U


def _shuffled(n, draw, i, seed=""):
    md5 = lambda *parts: hashlib.md5(":".join(map(str, [seed, draw, *parts])).encode()).hexdigest()
    x = i
    for r in range(D.ROUNDS):
        y = (int(md5(r)[:13], 16) % n + n - x) % n
        if md5(r, max(x, y))[0] in "13579bdf":
            x = y
    return x


def test_positions_are_a_seeded_permutation(spark):
    """For every n, also tiny ones: distinct positions below n, and those of a plain loop."""
    sizes = spark.createDataFrame([(1, 1), (2, 2), (3, 7), (4, 150), (5, 1000), (6, 10**12)], "chunk_size long, _n long")
    rows = D.seeded_positions(sizes, 3, 150, "s").collect()
    for c, n in ((1, 1), (2, 2), (3, 7), (4, 150), (5, 1000), (6, 10**12)):
        for draw in range(3):
            got = {r.position for r in rows if (r.chunk_size, r.draw) == (c, draw)}
            assert got == {_shuffled(n, draw, i, "s") for i in range(min(150, n))} and len(got) == min(150, n)
            assert all(0 <= p < n for p in got)
    large = [r.position for r in rows if r.chunk_size == 6]
    assert 0.4 < sum(large) / len(large) / 10**12 < 0.6


def test_draws_of_ragged_vectors(spark):
    """Vectors of different lengths, empty and repeated ones: every position leads to its own value."""
    rng = random.Random(3)
    rows = [(f"s{i % 40}", "u", 0, "R-x-50", [rng.randint(0, 10**6) for _ in range(rng.choice([0, 1, 3, 40]))]) for i in range(60)]
    rows += [("s1", "u", 0, "R-x-100", [5, 6])]
    feats = spark.createDataFrame(rows, "sample string, uuid string, run_id int, feature string, feature_data array<long>").repartition(3)
    got = D.repeated_samples(feats, draws=4, draw_size=10_000).collect()
    values = sorted(v for *_, f, d in rows for v in d if f == "R-x-50")
    for draw in range(4):  # more than there are: all of them, once
        assert sorted(r.value for r in got if (r.chunk_size, r.draw) == (50, draw)) == values
        assert sorted(r.value for r in got if (r.chunk_size, r.draw) == (100, draw)) == [5, 6]
    few = D.repeated_samples(feats, draws=4, draw_size=20).collect()
    assert len([r for r in few if r.chunk_size == 50]) == 80
    assert {r.value for r in few if r.chunk_size == 50} <= set(values)
    assert len({frozenset((r.sample, r.bin, r.value) for r in few if (r.chunk_size, r.draw) == (50, d)) for d in range(4)}) == 4


def test_subsets_shuffle_the_cut_bucket_only(spark):
    df = spark.range(9000).select(F.format_string("k%d", "id").alias("sample"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit("payload").alias("more"))
    inside, edge = U._subset_parts(df, 4, "label", "sample", 3, "s")
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert edge.count() < 40
    out = U.overlapping_subsets(df, 4, "label", "sample", seed="s").collect()
    for s in range(4):
        for label in (0, 1):
            keys = [f"k{i}" for i in range(9000) if (i % 3 == 0) == bool(label)]
            order = sorted(keys, key=lambda k: (hashlib.md5(f"s:{s}:{k}".encode()).hexdigest(), f"{s}:{k}"))
            assert {r.sample for r in out if (r.set_id, r.label) == (s, label)} == set(order[:1000])


def test_roc_buckets_follow_the_scores(spark, monkeypatch):
    monkeypatch.setattr(M, "SCORES_A_BUCKET", 50)
    rows = spark.range(3000).select((F.col("id") % 1000 / 7.0).alias("score"), (F.xxhash64("id") % 2 == 0).cast("int").alias("label"))
    assert abs(M.auroc(rows).first()["auroc"] - M.auroc(rows, n_buckets=1).first()["auroc"]) < 1e-12
