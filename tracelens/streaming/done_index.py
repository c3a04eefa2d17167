"""Which keys are done: marks in buckets by key hash, compacted, with a Bloom filter a bucket.

Every epoch writes its marks as a delta, ``delta/run=<r>/epoch=<k>``, a few files
in order of buckets. When ``COMPACT_EPOCHS`` deltas have come together, the buckets that they touch
are rewritten, each from its marks so far and the new ones, as ``base/v=<n>``;
the other buckets stay in the versions that they are in. ``manifest/v=<n>`` is
written last and makes version n the current one: it says for each bucket its
version, holds its Bloom filter, and names the deltas that are in. A batch
opens, of the base, the buckets whose filter its keys hit, and the few deltas
outside the base, of which it takes the buckets that its keys hash to.

A compaction that fails before its manifest leaves the version before it
current. A replayed epoch overwrites its own delta, and consults no mark of its
run from its own epoch on; a run's epochs are compacted only when they are
older than the one at hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runs import children, path_exists

#: Buckets of the index, and deltas that are left to come together before a compaction.
BUCKETS, COMPACT_EPOCHS = 256, 8
#: Bits of a bucket's Bloom filter: at least, at most, and for each key; a key sets two.
LEAST_BITS, MOST_BITS, BITS_A_KEY = 1 << 10, 1 << 22, 16
_MANIFEST = "bucket int, version int, bits long, words map<long,long>, run string, upto long"


class DoneIndex:
    """Marks (keys, done_us) under ``root``; a mark read back has its run and epoch, too."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(k).cast("string") for k in self.keys])

    def _bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(BUCKETS)).cast("int").alias("bucket")

    @staticmethod
    def _places(hash_: Column, bits: Column) -> list[Column]:
        """The two bits of a key; ``bits`` is a power of two. The hash's low end chose the bucket, so it takes no part."""
        return [F.shiftrightunsigned(hash_, 8).bitwiseAND(bits - 1), F.shiftrightunsigned(hash_, 33).bitwiseAND(bits - 1)]

    def version(self) -> int:
        """The current version, 0 before the first compaction."""
        found = [int(v.split("=")[1]) for v in children(self.spark, f"{self.root}/manifest") if path_exists(self.spark, f"{self.root}/manifest/{v}/_SUCCESS")]
        return max(found, default=0)

    def _manifest(self) -> DataFrame:
        """A row a bucket in the base, and a row (run, upto) a run whose epochs up to that one are in it."""
        v = self.version()
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/v={v}") if v else self.spark.createDataFrame([], _MANIFEST)

    def _covered(self, manifest: DataFrame) -> dict[str, int]:
        return {r["run"]: r["upto"] for r in manifest.where("run is not null").select("run", "upto").collect()}

    def _deltas(self, covered: dict[str, int]) -> list[tuple[str, int]]:
        """(run, epoch) of the deltas that are not in the base."""
        out = []
        for run in children(self.spark, f"{self.root}/delta"):
            name = run.split("=", 1)[1]
            out += [(name, e) for e in (int(x.split("=")[1]) for x in children(self.spark, f"{self.root}/delta/{run}")) if e > covered.get(name, -1)]
        return out

    def _read(self, deltas: Sequence[tuple[str, int]], versions: Sequence[tuple[int, int]], buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Marks of the given deltas and (version, bucket) folders of the base; of the deltas those buckets only, if given."""
        parts = []
        for run, epoch in deltas:
            path = f"{self.root}/delta/run={run}/epoch={epoch}"
            if path_exists(self.spark, f"{path}/_SUCCESS"):
                table = self.spark.read.parquet(path)
                table = table if buckets is None else table.where(F.col("bucket").isin(list(buckets)))
                parts.append(table.withColumns({"run": F.lit(run), "epoch": F.lit(epoch).cast("long")}))
        if versions:
            paths = [f"{self.root}/base/v={v}/bucket={b}" for v, b in versions]
            parts.append(self.spark.read.option("basePath", f"{self.root}/base").parquet(*paths).drop("v"))
        columns = [*self.keys, "done_us", "run", "epoch", "bucket"]
        out = None
        for p in parts:
            out = p.select(columns) if out is None else out.unionByName(p.select(columns))
        return out

    def opened(self, batch: DataFrame) -> tuple[list[tuple[str, int]], list[tuple[int, int]], list[int]]:
        """What a batch of keys has to open: deltas, (version, bucket) folders of the base, and its own buckets."""
        manifest = self._manifest()
        deltas = self._deltas(self._covered(manifest))
        if not deltas and manifest.isEmpty():
            return [], [], []
        hashed = batch.select(self._hash().alias("h"), self._bucket())
        mine = [r[0] for r in hashed.select("bucket").distinct().collect()]  # at most BUCKETS
        filters = manifest.where("bucket is not null").select("bucket", "version", "bits", "words")
        places = self._places(F.col("h"), F.col("bits"))
        # 64 bits a word; a word that is not there has no bit. One row a bucket of bounded size: broadcast.
        bit = lambda p: F.getbit(F.coalesce(F.element_at("words", F.shiftright(p, 6)), F.lit(0).cast("long")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        hits = hashed.join(F.broadcast(filters), "bucket").where(bit(places[0]) & bit(places[1])).select("version", "bucket").distinct()
        return deltas, sorted((r[0], r[1]) for r in hits.collect()), mine

    def unseen(self, batch: DataFrame, run: str, epoch: int) -> DataFrame:
        """The rows of a batch whose keys have no mark but those of this run from this epoch on. The batch is read three times."""
        deltas, versions, mine = self.opened(batch)
        marks = self._read([d for d in deltas if d[0] != run or d[1] < epoch], versions, mine)
        if marks is None:
            return batch
        before = marks.where(~((F.col("run") == run) & (F.col("epoch") >= epoch)))
        return batch.join(before.select(*self.keys).distinct(), on=self.keys, how="left_anti")

    def all(self) -> DataFrame | None:
        """Every mark, with run and epoch; None before the first."""
        manifest = self._manifest()
        versions = [(r["version"], r["bucket"]) for r in manifest.where("bucket is not null").select("version", "bucket").collect()]
        return self._read(self._deltas(self._covered(manifest)), versions)

    def mark(self, batch: DataFrame, run: str, epoch: int) -> None:
        """Marks the batch's keys as done by this epoch."""
        marks = batch.select(*self.keys, F.unix_micros(F.current_timestamp()).alias("done_us"), self._bucket())
        marks.sortWithinPartitions("bucket").write.mode("overwrite").parquet(f"{self.root}/delta/run={run}/epoch={epoch}")

    def compact(self, run: str, epoch: int, least: int | None = None) -> bool:
        """Takes the deltas into the base if there are enough of them: all of other runs, of this one those before the epoch."""
        manifest = self._manifest()
        covered = self._covered(manifest)
        deltas = [d for d in self._deltas(covered) if d[0] != run or d[1] < epoch]
        if len(deltas) < (COMPACT_EPOCHS if least is None else least):
            return False
        version = self.version() + 1
        fresh = self._read(deltas, [])
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()] if fresh is not None else []
        old = {r["bucket"]: r["version"] for r in manifest.where("bucket is not null").select("bucket", "version").collect()}
        base = f"{self.root}/base/v={version}"
        rest = manifest.where(F.col("bucket").isNotNull() & ~F.col("bucket").isin(touched))
        if touched:
            marks = self._read(deltas, [(old[b], b) for b in touched if b in old])
            marks.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(base)
            rest = rest.unionByName(self._filters(self.spark.read.parquet(base)).withColumn("version", F.lit(version)), allowMissingColumns=True)
        upto = dict(covered)
        for r, e in deltas:
            upto[r] = max(e, upto.get(r, -1))
        runs = self.spark.createDataFrame(list(upto.items()), "run string, upto long")
        rest.unionByName(runs, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")
        return True

    def _filters(self, marks: DataFrame) -> DataFrame:
        """(bucket, bits, words): a Bloom filter of each bucket's keys, sized by their number."""
        hashed = marks.select("bucket", self._hash().alias("h"))
        counts = hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * BITS_A_KEY))).cast("long")
        sized = counts.select("bucket", F.greatest(F.lit(LEAST_BITS), F.least(F.lit(MOST_BITS), wanted)).cast("long").alias("bits"))
        set_ = hashed.join(sized, "bucket").select("bucket", "bits", F.explode(F.array(*self._places(F.col("h"), F.col("bits")))).alias("p"))
        one = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
        words = set_.groupBy("bucket", "bits", F.shiftright("p", 6).alias("word")).agg(F.bit_or(one).alias("w"))
        return words.groupBy("bucket", "bits").agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("words"))
