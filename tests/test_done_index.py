"""Marks of done uploads: what a batch opens, compaction, replays and runs."""

from pyspark.sql import functions as F

from tracelens.streaming import done_index as I

KEYS = ["sample", "run_id"]


def _batch(spark, ids):
    return spark.createDataFrame([(f"s{i}", 0) for i in ids], "sample string, run_id int")


def _ids(df):
    return sorted(int(r["sample"][1:]) for r in df.collect())


def test_files_opened_stay_few(spark, tmp_dir):
    """After 50 epochs: a batch of new keys opens hardly any bucket of the base, a batch of one old key opens one."""
    index = I.DoneIndex(spark, tmp_dir, KEYS)
    for epoch in range(50):
        index.mark(_batch(spark, range(epoch * 20, epoch * 20 + 20)), "r", epoch)
        index.compact("r", epoch)
    assert index.version() == 6
    deltas, folders, _ = index.opened(_batch(spark, range(10_000, 10_200)))
    assert len(deltas) <= I.COMPACT_EPOCHS and len(folders) <= 20  # of some 250 buckets
    deltas, folders, mine = index.opened(_batch(spark, [7]))
    assert len(folders) == 1 == len(mine)
    files = len(spark.read.option("basePath", f"{tmp_dir}/base").parquet(*[f"{tmp_dir}/base/v={v}/bucket={b}" for v, b in folders]).inputFiles())
    assert files == 1
    assert _ids(index.unseen(_batch(spark, [7, 999, 1000, 5000]), "r", 50)) == [1000, 5000]
    assert _ids(index.all()) == list(range(1000))


def test_only_touched_buckets_are_rewritten(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(I, "COMPACT_EPOCHS", 1)
    index = I.DoneIndex(spark, tmp_dir, KEYS)
    index.mark(_batch(spark, range(600)), "r", 0)
    assert index.compact("r", 1)
    index.mark(_batch(spark, [9000]), "r", 1)
    assert index.compact("r", 2)
    assert len(I.children(spark, f"{tmp_dir}/base/v=1")) > 200 and len(I.children(spark, f"{tmp_dir}/base/v=2")) == 1
    assert _ids(index.all()) == [*range(600), 9000]
    assert not index.compact("r", 3)  # nothing new


def test_replays_and_other_runs(spark, tmp_dir):
    index = I.DoneIndex(spark, tmp_dir, KEYS)
    index.mark(_batch(spark, [1]), "r", 0)
    index.mark(_batch(spark, [2]), "r", 1)
    assert _ids(index.unseen(_batch(spark, [1, 2, 3]), "r", 1)) == [2, 3]  # a replay of epoch 1 does not see its own marks
    assert _ids(index.unseen(_batch(spark, [1, 2, 3]), "other", 0)) == [3]
    assert index.compact("r", 1, least=1)  # epoch 1 may be replayed yet: it stays a delta
    index.mark(_batch(spark, [5]), "r", 1)
    assert _ids(index.all()) == [1, 5]
    index.mark(_batch(spark, []), "r", 2)
    assert index.compact("z", 0, least=1) and _ids(index.all()) == [1, 5]
    assert _ids(index.unseen(_batch(spark, [1, 5, 6]), "z", 0)) == [6]


def test_a_failed_compaction_changes_nothing(spark, tmp_dir):
    index = I.DoneIndex(spark, tmp_dir, KEYS)
    index.mark(_batch(spark, range(50)), "r", 0)
    index.compact("r", 1, least=1)
    _batch(spark, [77]).withColumns({"done_us": F.lit(0), "bucket": F.lit(3)}).write.partitionBy("bucket").parquet(f"{tmp_dir}/base/v=2")  # it got no manifest
    assert index.version() == 1 and _ids(index.all()) == list(range(50))
    index.mark(_batch(spark, [60]), "r", 1)
    assert index.compact("r", 2, least=1) and _ids(index.all()) == [*range(50), 60]


def test_null_keys(spark, tmp_dir):
    """A null key is never done, as before: it joins nothing."""
    index = I.DoneIndex(spark, tmp_dir, KEYS)
    rows = spark.createDataFrame([(None, 0)], "sample string, run_id int")
    index.mark(rows, "r", 0)
    assert index.unseen(rows, "r", 1).count() == 1
