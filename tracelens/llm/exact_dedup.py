"""Exact dedup with counting quotient filters.

1. Each text gets a 64-bit fingerprint (XXH64). Its high bits are the
   quotient, the rest the remainder.
2. Every partition builds counting quotient filters, one for each range of
   quotients: remainders in sorted runs, run ends and occupied quotients as
   bits, and a count for each remainder. Copies within a partition shrink to
   one entry, so a hot text costs one entry a partition.
3. The filters of a range merge losslessly: their sorted runs are merged and
   counts of equal remainders add up. A merged range holds about
   ``range_entries`` fingerprints, whatever the corpus holds.
4. Fingerprints with a count above one route their texts to byte
   verification. A bitmap over them (:mod:`key_filter`), the one thing
   broadcast, spares the rest the shuffle; a bit set by another fingerprint
   only costs a shuffle of that text, for the grouping compares whole texts.
5. Byte verification groups by the whole text (pre-aggregated in each
   partition), and the verified groups go back to the rows by fingerprint
   and SHA-256, without the texts.

Nulls count as empty texts. Empty texts are copies of each other. Of rows
equal in text, the one with the largest id stays; a null id is smaller than
any other; of several rows with that id exactly one stays. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .key_filter import KeyFilter, free_names

#: Fingerprints in one merged range of the filter, about.
RANGE_ENTRIES = 1 << 20
#: Fingerprints that a task holds before it emits their filters.
TASK_ENTRIES = 1 << 21


class CountingQuotientFilter:
    """Sorted remainders by quotient, with counts, over 64-bit fingerprints of one range.

    ``occupied`` has a bit for each quotient of the range, ``run_end`` a bit
    for each slot: the last of its quotient's run. With them the remainders
    alone give the fingerprints back, so merging loses nothing.
    """

    def __init__(self, low: int, quotients: int, remainder_bits: int, occupied: np.ndarray, run_end: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.low, self.quotients, self.remainder_bits = low, quotients, remainder_bits
        self.occupied, self.run_end, self.remainders, self.counts = occupied, run_end, remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray, low: int, quotients: int, remainder_bits: int) -> CountingQuotientFilter:
        """Of fingerprints in any order, repeats included."""
        values, place = np.unique(fingerprints, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(values)).astype(np.int64)
        quotient = (values >> np.uint64(remainder_bits)).astype(np.int64) - low
        occupied = np.zeros(quotients, dtype=bool)
        occupied[quotient] = True
        run_end = np.append(quotient[1:] != quotient[:-1], True) if len(values) else np.zeros(0, dtype=bool)
        return cls(low, quotients, remainder_bits, occupied, run_end, values & np.uint64((1 << remainder_bits) - 1), total)

    def fingerprints(self) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(self.run_end)[:-1]]).astype(np.int64) if len(self.remainders) else np.zeros(0, np.int64)
        quotient = np.flatnonzero(self.occupied)[run] + self.low
        return (quotient.astype(np.uint64) << np.uint64(self.remainder_bits)) | self.remainders

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both filters in one; two sorted sequences, so the stable sort below is a merge."""
        values = np.concatenate([self.fingerprints(), other.fingerprints()])
        counts = np.concatenate([self.counts, other.counts])
        order = np.argsort(values, kind="stable")
        return self.build(values[order], counts[order], self.low, self.quotients, self.remainder_bits)

    def count(self, fingerprint: int) -> int:
        quotient = (fingerprint >> self.remainder_bits) - self.low
        if not self.occupied[quotient]:
            return 0
        ends = np.flatnonzero(self.run_end)
        k = int(self.occupied[:quotient].sum())
        run = slice(int(ends[k - 1]) + 1 if k else 0, int(ends[k]) + 1)
        at = np.searchsorted(self.remainders[run], np.uint64(fingerprint & ((1 << self.remainder_bits) - 1)))
        hit = at < run.stop - run.start and int(self.remainders[run][at]) == fingerprint & ((1 << self.remainder_bits) - 1)
        return int(self.counts[run][at]) if hit else 0

    def to_columns(self) -> dict[str, bytes]:
        return {"occupied": np.packbits(self.occupied).tobytes(), "run_end": np.packbits(self.run_end).tobytes(), "remainders": self.remainders.tobytes(), "counts": self.counts.tobytes()}

    @classmethod
    def from_columns(cls, row: dict, low: int, quotients: int, remainder_bits: int) -> CountingQuotientFilter:
        bits = lambda data, n: np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
        remainders = np.frombuffer(row["remainders"], np.uint64)
        return cls(low, quotients, remainder_bits, bits(row["occupied"], quotients), bits(row["run_end"], len(remainders)), remainders, np.frombuffer(row["counts"], np.int64))


def _range_bits(rows: int) -> int:
    """Ranges (as a power of two) for so many rows: at least 16, else about RANGE_ENTRIES rows each."""
    return max(4, int(np.ceil(np.log2(max(1, rows / RANGE_ENTRIES)))))


#: Quotients in a range (a power of two). With 2^20 entries the load is about two a quotient.
RANGE_QUOTIENT_BITS = 10


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (column ``fp``, long) that occur more than once, with their counts: (fp, n)."""
    range_bits = _range_bits(rows)
    remainder_bits = 64 - range_bits - RANGE_QUOTIENT_BITS
    quotients = 1 << RANGE_QUOTIENT_BITS

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        part = (values >> np.uint64(64 - range_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        rows_out = []
        for a, b in zip(cuts, np.append(cuts[1:], len(values)), strict=True):
            built = CountingQuotientFilter.build(values[a:b], counts[a:b], int(part[a]) << RANGE_QUOTIENT_BITS, quotients, remainder_bits)
            rows_out.append({"part": int(part[a])} | built.to_columns())
        return pa.RecordBatch.from_pylist(rows_out, schema=filter_schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.asarray(batch.column(0)).astype(np.int64).view(np.uint64))
            n += batch.num_rows
            if n >= TASK_ENTRIES:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: CountingQuotientFilter | None = None
        waiting: list[CountingQuotientFilter] = []  # merged pairwise by size, so no filter is merged again and again
        for batch in batches:
            for row in batch.to_pylist():
                one = CountingQuotientFilter.from_columns(row, row["part"] << RANGE_QUOTIENT_BITS, quotients, remainder_bits)
                while waiting and len(waiting[-1].remainders) <= len(one.remainders):
                    one = one.merge(waiting.pop())
                waiting.append(one)
        while waiting:
            whole = waiting.pop() if whole is None else whole.merge(waiting.pop())
        if whole is not None:
            many = whole.counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(whole.fingerprints()[many].view(np.int64)), pa.array(whole.counts[many])], names=["fp", "n"])

    filter_schema = pa.schema([("part", pa.int64()), ("occupied", pa.binary()), ("run_end", pa.binary()), ("remainders", pa.binary()), ("counts", pa.binary())])
    filters = fingerprints.select("fp").mapInArrow(build, "part long, occupied binary, run_end binary, remainders binary, counts binary")
    return filters.groupBy("part").applyInArrow(merge, "fp long, n long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows with their keys, and the groups of two or more equal texts.

    Rows: (doc_id, fp, text_sha256, tag), a staged table; the tag tells rows
    apart. Groups: (fp, text_sha256, keep_id, keep_tag, group_size), verified
    byte by byte, a staged table too.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    rows = stage_table(keyed.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("tag")), "dedup-keys")
    repeated = KeyFilter(stage_table(repeated_fingerprints(rows, rows.count()).select("fp"), "dedup-repeated"))
    verified = repeated.split(keyed, F.col("fp"))[0].groupBy("fp", "text").agg(F.count(F.lit(1)).alias("group_size"))
    # Two different texts under one fingerprint and one SHA-256 would be mixed up on the way back: such a find is an error.
    sizes = verified.select("fp", F.sha2("text", 256).alias("text_sha256"), "group_size").groupBy("fp", "text_sha256").agg(F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    checked = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a fingerprint and a SHA-256")).cast("long")).otherwise(F.col("group_size"))
    # The row that stays: the largest id; of rows repeated with it, the one with the least tag.
    keepers = repeated.split(rows, F.col("fp"))[0].groupBy("fp", "text_sha256").agg(F.max(F.struct("doc_id", (-F.col("tag")).alias("tag"))).alias("keep"))
    groups = sizes.withColumn("group_size", checked).where("group_size > 1").join(keepers, ["fp", "text_sha256"])
    # Staged, so that the joins with it are plain ones, which Spark splits where a text is hot.
    return rows, stage_table(groups.select("fp", "text_sha256", F.col("keep.doc_id").alias("keep_id"), (-F.col("keep.tag")).alias("keep_tag"), "group_size"), "dedup-groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, groups = exact_groups(docs, id_col, text_col)
    alone = F.col("group_size").isNull()
    return rows.join(groups, ["fp", "text_sha256"], "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("tag") == F.col("keep_tag"), F.lit(True)).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without the copies that :func:`exact_dedup` drops.

    Only rows whose text can be a copy are joined; the others pass by. Copies
    leave by an anti join on id and SHA-256. Where one id stands for several
    rows of the text that stays, one of them stays: the one whose columns (but
    maps) hash lowest.
    """
    rows, groups = exact_groups(docs, id_col, text_col)
    fate = rows.join(groups, ["fp", "text_sha256"])
    sha, gone_id, gone_sha, one = free_names(docs, "own_sha", "gone_id", "gone_sha", "one")
    named = lambda df: df.select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha))
    dropped = named(fate.where("not (doc_id <=> keep_id)"))
    again = stage_table(named(fate.where("doc_id <=> keep_id").groupBy("doc_id", "text_sha256").count().where("count > 1")), "dedup-again")
    text = F.coalesce(F.col(text_col), F.lit(""))
    maybe, alone = KeyFilter(groups.select("fp")).split(docs, F.xxhash64(text))
    same = F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(sha) == F.col(gone_sha))
    left = maybe.withColumn(sha, F.sha2(text, 256)).join(dropped, same, "left_anti")
    if not again.isEmpty():
        twice = left.join(again, same, "left_semi")
        order = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
        single = twice.groupBy(id_col, sha).agg(F.min_by(F.struct(*docs.columns), order).alias(one)).select(f"{one}.*")
        return alone.unionByName(left.join(again, same, "left_anti").drop(sha)).unionByName(single)
    return alone.unionByName(left.drop(sha))
