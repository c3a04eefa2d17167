"""Balancing, folds, subsets, picks, dedup: properties."""

from pyspark.sql import functions as F

from tracelens.operators import sampling as U


def _labelled(spark, n_mal, n_ben):
    rows = [(f"m{i}", 1.0) for i in range(n_mal)] + [(f"b{i}", 0.0) for i in range(n_ben)]
    return spark.createDataFrame(rows, "sample string, label double")


def test_balance_equal_counts(spark):
    out = U.balance_classes(_labelled(spark, 37, 120), "label", "sample")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {1.0: 37, 0.0: 37}


def test_hash_rank_many_buckets_is_dense(spark):
    df = _labelled(spark, 0, 5000)
    r = U.hash_rank(df, ["label"], "sample", bucket_bits=6)
    ranks = sorted(x["rank"] for x in r.collect())
    assert ranks == list(range(1, 5001))


def test_folds_partition_ids(spark):
    df = _labelled(spark, 300, 300)
    f = U.k_fold(df, "sample", 10, seed=3)
    assert f.count() == 600 and f.select("sample").distinct().count() == 600
    assert set(r["fold"] for r in f.select("fold").distinct().collect()) == set(range(10))


def test_overlapping_subsets(spark):
    out = U.overlapping_subsets(_labelled(spark, 30, 30), 4, "label", "sample")
    per = out.groupBy("set_id", "label").count().collect()
    assert len(per) == 8 and all(r["count"] == 10 for r in per)
    assert out.groupBy("set_id", "sample").count().where("count > 1").count() == 0


def test_next_batch_balances_and_never_repeats(spark):
    rows = [(f"m{i}", 1.0) for i in range(10)] + [(f"b{i}", 0.0) for i in range(3)] + [(f"u{i}", None) for i in range(4)]
    cand = spark.createDataFrame(rows, "sample string, label_value double")
    picks = U.next_batch(cand, existing_malware=5, existing_benign=2, queue_depth=35)
    got = picks.orderBy("pick").collect()
    assert len(got) == 15 and len({r["sample"] for r in got}) == 15
    # benign first until balanced (2 -> 5), then alternating, unlabelled last.
    assert [r["label"] for r in got[:3]] == [0.0, 0.0, 0.0]
    assert got[-1]["label"] is None
    assert U.next_batch(cand, 0, 0, queue_depth=50).count() == 0


def test_dedup_keeps_smallest(spark):
    df = spark.createDataFrame([("h1", 5, "x"), ("h1", 2, "y"), ("h2", 9, "z")], "sample string, doc_id long, v string")
    got = {r["sample"]: (r["doc_id"], r["v"]) for r in U.dedup_by_content(df, "sample", "doc_id").collect()}
    assert got == {"h1": (2, "y"), "h2": (9, "z")}
