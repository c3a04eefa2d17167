"""Set operations, balancing, folds and work selection.

Random choices are a seeded hash of the row key, never ``rand()`` or input
order, so every recomputation (after an executor loss, say) gives the same
rows.  The hash order is md5 of ``seed:key``: the same order DuckDB or any
other engine computes, which keeps these operators checkable.

Ranking inside a class uses the two-level distributed rank: a class may hold
half the rows, so it is never one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as LF
from ..session import stage_table
from .rank import ordered_positions

HASH_BUCKET_BITS = 20
# Fixed values of the reference: folds, queue cap.
DEFAULT_FOLDS = 10
QUEUE_DEPTH_LIMIT = 50


def hash_key(key: Column, seed: str | int = "") -> Column:
    """md5 hex of ``seed:key`` (order-defining string)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def _hash_prefix(h: Column, hex_digits: int = 15) -> Column:
    # First 60 bits of the md5 as a non-negative long: numeric order == string order.
    return F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("long")


def hash_rank(
    df: DataFrame,
    part_cols: Sequence[str],
    key_col: str,
    seed: str | int = "",
    pos_col: str = "rank",
    bucket_bits: int = HASH_BUCKET_BITS,
    with_totals: bool = False,
):
    """1-based rank of rows inside ``part_cols`` by md5(seed:key), then key.

    Buckets are the top ``bucket_bits`` bits of the hash (a uniform split: a
    class of 10^12 rows gives buckets of about 10^6 rows, a small one gives
    single-row buckets), ranked with the two-level scheme, so neither a large
    class nor a count pre-pass is needed.  Output adds ``pos_col`` and ``_h``
    (the md5 hex); with ``with_totals`` also returns ``(part_cols, n)``.
    """
    h = hash_key(F.col(key_col), seed)
    with_h = df.withColumn("_h", h).withColumn("_hn", _hash_prefix(F.col("_h")))
    with_b = with_h.withColumn("_hb", F.shiftright(F.col("_hn"), 60 - bucket_bits))
    res = ordered_positions(
        with_b, part_cols, ["_hn", "_h", key_col], pos_col=pos_col, bucket_col="_hb", with_totals=with_totals
    )
    if with_totals:
        ranked, totals = res
        return ranked.drop("_hn", "_hb"), totals
    return res.drop("_hn", "_hb")


def balance_classes(
    df: DataFrame, label_col: str = "label", key_col: str = "sample", seed: str | int = ""
) -> DataFrame:
    """Truncate every class to the size of the smallest one.

    Survivors are the first rows of each class in md5(seed:key) order.
    """
    ranked, totals = hash_rank(df, [label_col], key_col, seed, pos_col="_r", with_totals=True)
    # One row per class: the smallest class size over that tiny table, joined
    # back on the class (an equi-join AQE broadcasts by its measured size).
    limits = totals.select(label_col, F.min("n").over(Window.partitionBy()).alias("_n_min"))
    return ranked.join(limits, on=label_col).where(F.col("_r") <= F.col("_n_min")).drop("_r", "_h", "_n_min")


def k_fold(df: DataFrame, key_col: str, k: int = DEFAULT_FOLDS, seed: int | str = 0, method: str = "xxhash") -> DataFrame:
    """Assign every row to exactly one of ``k`` folds (U4).

    ``xxhash`` (default, fastest) or ``md5`` (same folds in any engine).
    """
    if method == "xxhash":
        fold = F.pmod(F.xxhash64(F.col(key_col), F.lit(str(seed))), F.lit(k))
    elif method == "md5":
        fold = F.pmod(F.conv(F.substring(hash_key(F.col(key_col), seed), 1, 8), 16, 10).cast("long"), F.lit(k))
    else:
        raise ValueError(f"unknown fold method {method!r}")
    return df.withColumn("fold", fold.cast("int"))


def train_test(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Train = union of the other folds (U2), test = the fold."""
    return df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)


def overlapping_subsets(
    df: DataFrame,
    n_sets: int,
    label_col: str = "label",
    key_col: str = "sample",
    fraction_den: int = 3,
    seed: str | int = "",
) -> DataFrame:
    """``n_sets`` class-balanced subsets, each ``floor(class/3)`` rows per class,
    no repeats inside a set, overlap between sets (U5).  Adds ``set_id``."""
    inside, edge = _subset_parts(df, n_sets, label_col, key_col, fraction_den, seed)
    return inside.unionByName(edge)


#: Leading bits of the hash that place a row before, in or behind the last bucket of a subset.
CUT_BITS = 12


def _subset_parts(df: DataFrame, n_sets: int, label_col: str, key_col: str, fraction_den: int, seed: str | int) -> tuple[DataFrame, DataFrame]:
    """The rows that are in a subset by their hash alone, and those of the bucket that its size cuts.

    Hash buckets of each (set, class) are counted, map-side first; where the
    running count meets the subset's size lies the cut. Rows before it are
    taken in the scan. Only rows of the cut's bucket, one in 2^CUT_BITS, are
    shuffled and ranked.
    """
    held = stage_table(df, "subset-rows")  # read three times
    exploded = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_sets - 1))).alias("set_id"))
    keyed = exploded.withColumn("_sk", F.concat_ws(":", F.col("set_id").cast("string"), F.col(key_col).cast("string")))
    keyed = keyed.withColumn("_top", F.shiftright(_hash_prefix(hash_key(F.col("_sk"), seed)), 60 - CUT_BITS))
    counts = stage_table(keyed.groupBy("set_id", label_col, "_top").agg(F.count(F.lit(1)).alias("_n")), "subset-counts")
    # Every set holds every row once: n_sets x classes rows, at most 2^CUT_BITS counts each.
    totals = counts.groupBy("set_id", label_col).agg(F.sum("_n").alias("_total"))
    size = F.floor(F.min("_total").over(Window.partitionBy("set_id")) / F.lit(fraction_den)).alias("_size")
    order = Window.partitionBy("set_id", label_col).orderBy("_top").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_upto", F.sum("_n").over(order)).join(totals.select("set_id", label_col, size), ["set_id", label_col])
    cuts = running.where("_upto >= _size").groupBy("set_id", label_col).agg(F.min(F.struct("_top", F.col("_size") - F.col("_upto") + F.col("_n"))).alias("_c"))
    cuts = stage_table(cuts.select("set_id", label_col, F.col("_c._top").alias("_cut"), F.col("_c.col2").alias("_rest")), "subset-cuts")
    placed = keyed.join(F.broadcast(cuts), ["set_id", label_col])
    columns = [*df.columns, "set_id"]
    ranked = hash_rank(placed.where("_top = _cut"), ["set_id", label_col], "_sk", seed, pos_col="_r")
    return placed.where("_top < _cut").select(columns), ranked.where("_r <= _rest").select(columns)


def in_flight_union(*id_sets: DataFrame, col: str = "sample") -> DataFrame:
    """Distinct union of id sets."""
    return reduce(lambda a, b: a.unionByName(b), [s.select(col) for s in id_sets]).distinct()


def dedup_by_content(df: DataFrame, hash_col: str = "sample", order_col: str | None = None) -> DataFrame:
    """One row per content hash (U9); survivor = smallest ``order_col``.

    A rank filtered to its first row: Spark keeps one row a hash in every task
    before the shuffle, so a hash with millions of copies is no hot group.
    """
    if order_col is None:
        return df.dropDuplicates([hash_col])
    nth = F.row_number().over(Window.partitionBy(hash_col).orderBy(order_col))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def _top_by_hash(df: DataFrame, key_col: str, n: int, seed: str | int) -> DataFrame:
    """The ``n`` rows with smallest md5(seed:key): per-partition top-n then merge."""
    return df.withColumn("_h", hash_key(F.col(key_col), seed)).orderBy("_h", key_col).limit(n)


def next_batch(
    candidates: DataFrame,
    existing_malware: int | Column,
    existing_benign: int | Column,
    queue_depth: int,
    limit: int = QUEUE_DEPTH_LIMIT,
    key_col: str = "sample",
    label_col: str = "label_value",
    seed: str | int = "",
) -> DataFrame:
    """Up to ``limit - queue_depth`` picks that move the classes toward balance.

    Each pick goes to the class with fewer existing samples (malware on a
    tie), as the reference's picker does, but picks are counted as they are
    made and never repeat (D12).  When a class runs out the other class
    continues; unlabelled candidates come last.  Within a class candidates go
    in md5(seed:key) order.  Columns: pick (1-based), sample, label.
    """
    n = max(0, limit - queue_depth)
    spark = candidates.sparkSession
    if n == 0:
        return spark.createDataFrame([], f"pick int, {key_col} string, label double")
    mal = _top_by_hash(candidates.where(F.col(label_col) == LF.MALWARE), key_col, n, seed)
    ben = _top_by_hash(candidates.where(F.col(label_col) == LF.BENIGN), key_col, n, seed)
    unl = _top_by_hash(candidates.where(~F.col(label_col).isin(LF.MALWARE, LF.BENIGN) | F.col(label_col).isNull()), key_col, n, seed)
    # At most 3n rows from here on: ranks by a window over one tiny partition.
    def ranked(df: DataFrame, cls: int, base) -> DataFrame:
        r = F.row_number().over(Window.orderBy("_h", key_col))
        lvl = (F.lit(base) if not isinstance(base, Column) else base) + r - F.lit(1)
        return df.select(key_col, F.col(label_col).alias("label"), F.lit(cls).alias("_cls"), lvl.alias("_lvl"), "_h")

    picks = (
        ranked(mal, 0, existing_malware)
        .unionByName(ranked(ben, 1, existing_benign))
        .unionByName(ranked(unl, 2, F.lit(0)).withColumn("label", F.lit(None).cast("double")))
    )
    order = Window.orderBy(
        (F.col("_cls") == 2).cast("int"), "_lvl", "_cls", "_h", key_col
    )
    return (
        picks.withColumn("pick", F.row_number().over(order))
        .where(F.col("pick") <= n)
        .select("pick", key_col, "label")
    )


def dispatch_payload(picks: DataFrame, vm: str, pack: str, arch_col: str = "arch") -> DataFrame:
    """Work item rows ``{sample, vm, extractor-pack, arch}`` (U8)."""
    return picks.select(
        "sample", F.lit(vm).alias("vm"), F.lit(pack).alias("extractor-pack"), F.col(arch_col).alias("arch")
    )
