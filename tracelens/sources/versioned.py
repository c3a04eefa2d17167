"""Tables of documents that are replaced by id, merged when read (K3-K5, K9).

An upsert writes the new documents as a delta, ``delta/d=<n>/bucket=<b>``, dealt
out by a hash of the id, and reads nothing of the table. Readers take the newest
version of each id from the base and the deltas that are not in it. A
compaction rewrites the buckets that those deltas touch as ``base/v=<n>`` and
writes ``manifest/v=<n>`` last: which version holds each bucket, and up to which
delta. That one write switches all readers to the new version; a job that dies
before it leaves the old one current. A full reload is a version of its own,
switched to in the same way.

One writer at a time: two that take the same delta number would meet in one
folder, and the second one fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.redact import redact_sample_document
from ..streaming.runs import children, path_exists
from .sinks import latest_version

#: Buckets of a table.
BUCKETS = 64
_MANIFEST = "bucket int, version long, upto long"


class VersionedTable:
    """Documents under ``root``; ``version_cols`` rank an id's versions before the order in which they were written."""

    def __init__(self, spark: SparkSession, root: str, id_cols: Sequence[str], version_cols: Sequence[str] = ()):
        self.spark, self.root, self.id_cols, self.version_cols = spark, root.rstrip("/"), list(id_cols), list(version_cols)

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.id_cols]), F.lit(BUCKETS)).cast("int")

    def _numbers(self, kind: str) -> list[int]:
        folders = children(self.spark, f"{self.root}/{kind}")
        return sorted(int(f.split("=")[1]) for f in folders if path_exists(self.spark, f"{self.root}/{kind}/{f}/_SUCCESS"))

    def _current(self) -> tuple[dict[int, int], int]:
        """The version of each bucket of the base, and the last delta that is in it."""
        versions = self._numbers("manifest")
        if not versions:
            return {}, -1
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/v={versions[-1]}").collect()  # a row a bucket
        return {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}, max(r["upto"] for r in rows)

    def _write(self, rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
        rows.repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(path)

    def upsert(self, updates: DataFrame) -> int:
        """Writes the updates as the next delta and returns its number."""
        taken = [int(f.split("=")[1]) for f in children(self.spark, f"{self.root}/delta")]
        number = max([*taken, self._current()[1]], default=-1) + 1
        self._write(updates.withColumn("bucket", self._bucket()), f"{self.root}/delta/d={number}")
        return number

    def _parts(self, deltas: Sequence[int], base: dict[int, int], buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows with ``bucket`` and ``_written``, the delta that brought them; of the given buckets only, if given."""
        parts = []
        for d in deltas:
            path = f"{self.root}/delta/d={d}"
            if any(f.startswith("bucket=") for f in children(self.spark, path)):
                parts.append(self.spark.read.parquet(path).withColumn("_written", F.lit(d).cast("long")))
        wanted = [(v, b) for b, v in sorted(base.items()) if buckets is None or b in buckets]
        by_version: dict[int, list[str]] = {}
        for v, b in wanted:
            by_version.setdefault(v, []).append(f"{self.root}/base/v={v}/bucket={b}")
        for v, paths in by_version.items():  # each version has the columns of its time
            parts.append(self.spark.read.option("basePath", f"{self.root}/base/v={v}").parquet(*paths))
        out = None
        for p in parts:
            p = p if buckets is None else p.where(F.col("bucket").isin(list(buckets)))
            out = p if out is None else out.unionByName(p, allowMissingColumns=True)
        return out

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_version(rows, self.id_cols, [*self.version_cols, "_written"])

    def read(self, ids: DataFrame | None = None) -> DataFrame | None:
        """The newest version of each id, or of the given ids, from their buckets alone; None if nothing was ever written."""
        base, upto = self._current()
        buckets = None
        if ids is not None:
            buckets = [r[0] for r in ids.select(self._bucket().alias("b")).distinct().collect()]  # at most BUCKETS
        rows = self._parts([d for d in self._numbers("delta") if d > upto], base, buckets)
        if rows is None:
            return None
        if ids is not None:
            rows = rows.join(ids.select(*self.id_cols).distinct(), self.id_cols, "left_semi")
        return self._newest(rows).drop("bucket", "_written")

    def _switch(self, version: int, base: dict[int, int], upto: int) -> None:
        rows = [(b, v, upto) for b, v in base.items()] or [(None, None, upto)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")

    def _next_version(self) -> int:
        return max(self._numbers("manifest"), default=0) + 1

    def compact(self) -> list[int]:
        """Takes all deltas into the base; returns the buckets that were rewritten."""
        base, upto = self._current()
        deltas = [d for d in self._numbers("delta") if d > upto]
        fresh = self._parts(deltas, {})
        if not deltas:
            return []
        touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect()) if fresh is not None else []
        version = self._next_version()
        if touched:
            rows = self._newest(self._parts(deltas, base, touched))
            self._write(rows, f"{self.root}/base/v={version}", "overwrite")  # what an earlier try left has no manifest
        self._switch(version, base | dict.fromkeys(touched, version), deltas[-1])
        return touched

    def replace(self, rows: DataFrame) -> None:
        """A full reload: readers see all of the old table, then all of the new one (K9)."""
        version, last = self._next_version(), max(self._numbers("delta"), default=-1)
        path = f"{self.root}/base/v={version}"
        self._write(self._newest(rows.withColumns({"bucket": self._bucket(), "_written": F.lit(last).cast("long")})), path, "overwrite")
        held = [int(f.split("=")[1]) for f in children(self.spark, path) if f.startswith("bucket=")]
        self._switch(version, dict.fromkeys(held, version), last)


def sample_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, ("sample",))


def store_samples(table: VersionedTable, documents: DataFrame) -> int:
    """Sample documents, redacted below their depth, into their table (K5)."""
    return table.upsert(redact_sample_document(documents))


def feature_document_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, ("sample", "uuid", "run_id"))


def store_features(table: VersionedTable, documents: DataFrame, sets_col: str = "feature_sets") -> int:
    """Feature documents into their table; those whose set map is empty or null are skipped (K4)."""
    return table.upsert(documents.where(F.size(sets_col) > 0))
