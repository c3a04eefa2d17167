"""Upload stream into feature extraction (W1) and backfill.

New upload records arrive as files; each micro-batch keeps the successful
runs (F7), skips uploads whose features already exist (K2), extracts the
features of its traces (the same batch operators), and writes them.

Each micro-batch writes under ``run=<query id>/epoch=<k>``, by overwriting:
first its features, then the keys of its uploads, which mark them as done even
where nothing could be extracted (:mod:`.done_index`). A batch replayed after a failure rewrites
exactly its own output, and consults everything but that when skipping. The
query id comes from the checkpoint, so a new checkpoint writes beside earlier
runs, skips what they did, and loses nothing of it. With ``force`` uploads are
extracted again; :func:`read_uploads_output` takes an upload's newest features.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.catalog import run_ok
from .done_index import DoneIndex
from .runs import query_id, remove

Extract = Callable[[DataFrame], DataFrame]
KEYS = ("sample", "uuid", "run_id")


def _index(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DoneIndex:
    return DoneIndex(spark, f"{out_dir.rstrip('/')}/done", keys)


def process_uploads(
    batch: DataFrame, epoch: int, out_dir: str, extract: Extract, keys: Sequence[str] = KEYS, force: bool = False, run: str = "batch"
) -> None:
    """One micro-batch: successful, not yet extracted uploads -> features (W1 body).

    The batch's documents are parsed once: the uploads to do are staged, for
    the skip, the features and the marks.
    """
    spark = batch.sparkSession
    own = f"run={run}/epoch={epoch}"
    index, staged = _index(spark, out_dir, keys), f"{out_dir.rstrip('/')}/todo/{own}"
    batch.where(run_ok(F.col("status"))).dropDuplicates(list(keys)).write.mode("overwrite").parquet(staged)
    todo = spark.read.parquet(staged)
    if not force:
        todo = index.unseen(todo, run, epoch)
    extract(todo).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/features/{own}")
    index.mark(todo, run, epoch)
    index.compact(run, epoch)
    remove(spark, staged)


def read_uploads_output(spark: SparkSession, out_dir: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Features of every upload done, each from the newest batch that did it."""
    newest = _index(spark, out_dir, keys).all().groupBy(*keys).agg(F.max(F.struct("done_us", "run", "epoch")).alias("_at"))
    newest = newest.select(*keys, F.col("_at.run").alias("run"), F.col("_at.epoch").alias("epoch"))
    features = spark.read.parquet(f"{out_dir.rstrip('/')}/features")
    return features.join(newest, [*keys, "run", "epoch"], "left_semi").drop("run", "epoch")


def stream_uploads(
    spark: SparkSession,
    uploads: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    extract: Extract,
    keys: Sequence[str] = KEYS,
    available_now: bool = True,
    force: bool = False,
):
    """Run the upload stream until the files present are processed.

    ``uploads`` is a streaming DataFrame of upload records, e.g.
    ``read_uploads(..., stream=True)``. ``available_now`` processes everything
    available, stops and returns the features so far (the batch equivalent; W2
    backfill is the same extraction in batch); without it the running query is
    returned and takes new files every 10 seconds.
    """
    writer = uploads.writeStream.foreachBatch(
        lambda df, epoch: process_uploads(df, epoch, out_dir, extract, keys, force, query_id(df))
    ).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if not available_now:
        return query
    query.awaitTermination()
    return read_uploads_output(spark, out_dir, keys)


def backfill(uploads: DataFrame, extract: Extract, keys: Sequence[str] = ("sample", "uuid", "run_id")) -> DataFrame:
    """Re-run extraction for every successful existing upload (W2), as a batch."""
    return extract(uploads.where(run_ok(F.col("status"))).dropDuplicates(list(keys)))
