"""Distributed ordered rank of trace rows, per access type.

Chunking needs the 1-based position of every access among the accesses of its
trace that pass the access filter (R only, W only, or both).  A plain
``row_number() over (partition by trace order by seq)`` puts a whole trace on
one task; a single trace may hold a third of all rows, so instead:

1. cut each trace into seq buckets of at most ``bucket_rows`` rows
   (``b = seq div bucket_rows``);
2. count R / W / all rows per (trace, bucket): a map-side combined aggregate
   over a scan pruned to keys, seq and access code (like the counting job of
   ``zipWithIndex``), whose result has ``rows / bucket_rows`` rows;
3. a running sum over that small table gives each bucket's offsets (and the
   trace totals);
4. hash-partition the rows on (trace, bucket) - the only exchange of whole
   trace rows - and one window per (trace, bucket) gives running counts of
   all, R and W rows inside the bucket (a sort, bounded groups);
5. position = bucket offset + running count; the small offset table is
   joined on (trace, bucket) - broadcast by AQE when its measured size is
   under the threshold, otherwise co-partitioned with the ranked rows.

The trace keys travel as one struct column, so every stage partitions on
the same expression whatever the keys are.  Positions for all three access
types come out of one shuffle of the trace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

DEFAULT_BUCKET_ROWS = 1 << 20
_NULL_BUCKET = -(1 << 62)


def _bucket(base: DataFrame, order_cols: Sequence[str], bucket_rows: int) -> Column:
    """The bucket of a row: a number, or with ``bucket_rows=1`` and a second whole-number order column a pair.

    Such a pair is (split, row div DEFAULT_BUCKET_ROWS): a file that can't be
    split, however long, lies in as many buckets as it fills. Rows without an
    order value come first, in a bucket of their own.
    """
    cut = lambda col, rows: F.coalesce(F.floor(F.col(col) / F.lit(rows)).cast("long"), F.lit(_NULL_BUCKET))
    first = cut(order_cols[0], bucket_rows)
    if bucket_rows > 1 or len(order_cols) < 2 or not isinstance(base.schema[order_cols[1]].dataType, T.IntegralType):
        return first
    return F.struct(first.alias("split"), cut(order_cols[1], DEFAULT_BUCKET_ROWS).alias("block"))


def _with_buckets(base: DataFrame, order_cols: Sequence[str], bucket_rows: int, adaptive: bool) -> DataFrame:
    """Add ``_b`` to rows keyed by ``_k``.

    Fixed: ``order_col div bucket_rows`` (see :func:`_bucket`) - right when the order column is a
    dense position such as a line number. Adaptive: the rows are dealt out by
    range of (key, order columns) into partitions of about ``bucket_rows`` rows
    and staged, and the partition is the bucket, so buckets are even whatever
    the spread of the order values.
    """
    if not adaptive:
        return base.withColumn("_b", _bucket(base, order_cols, bucket_rows))
    spark = base.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // bucket_rows))
    dealt = base.repartitionByRange(parts, "_k", *order_cols)
    return cut_lineage(dealt.withColumn("_b", F.spark_partition_id().cast("long")))


def access_positions(
    trace: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = ("seq",),
    rw_col: str = "rw",
    carry: Sequence[str] = ("tgt",),
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    adaptive: bool = False,
) -> DataFrame:
    """Rows of ``trace`` with their position per access type.

    Returns ``keys + [access, pos, n_rows] + carry``: every R/W row appears
    twice, once under its own access code with its position among same-code
    rows, once under ``'RW'`` with its position among all rows; ``n_rows`` is
    the size of that access view of the trace.  ``order_cols`` must order the
    rows of one trace totally; the first one must be numeric (it defines the
    buckets).
    """
    keys = list(keys)
    order_cols = list(order_cols)
    carry = list(carry)
    is_r = (F.col(rw_col) == "R").cast("long")

    base = _with_buckets(
        trace.where(F.col(rw_col).isin("R", "W")).select(
            F.struct(*keys).alias("_k"), *[c for c in order_cols if c not in keys], rw_col,
            *[c for c in carry if c not in order_cols],
        ),
        order_cols, bucket_rows, adaptive,
    )

    # (2) + (3): per-bucket counts and exclusive prefix sums over the small table.
    # Every row is R or W, so W counts are all minus R (one aggregate less per row).
    counts = base.groupBy("_k", "_b").agg(
        F.count(F.lit(1)).alias("_n_all"),
        F.sum(is_r).alias("_n_r"),
    ).withColumn("_n_w", F.col("_n_all") - F.col("_n_r"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_k")
    offsets = counts.select(
        "_k",
        "_b",
        F.coalesce(F.sum("_n_all").over(before), F.lit(0)).alias("_off_all"),
        F.coalesce(F.sum("_n_r").over(before), F.lit(0)).alias("_off_r"),
        F.coalesce(F.sum("_n_w").over(before), F.lit(0)).alias("_off_w"),
        F.sum("_n_all").over(whole).alias("_tot_all"),
        F.sum("_n_r").over(whole).alias("_tot_r"),
        F.sum("_n_w").over(whole).alias("_tot_w"),
    )

    # (4): running counts inside each bounded bucket.
    shuffled = base.repartition("_k", "_b")
    upto = (
        Window.partitionBy("_k", "_b")
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = shuffled.select(
        "_k",
        "_b",
        rw_col,
        *carry,
        F.row_number().over(Window.partitionBy("_k", "_b").orderBy(*order_cols)).alias("_rn_all"),
        F.sum(is_r).over(upto).alias("_rn_r"),
    )

    # (5): add offsets, emit one row per access view.
    joined = ranked.join(offsets, on=["_k", "_b"], how="inner")
    is_read = F.col(rw_col) == "R"
    own_pos = F.when(is_read, F.col("_off_r") + F.col("_rn_r")).otherwise(
        F.col("_off_w") + F.col("_rn_all") - F.col("_rn_r")
    )
    own_tot = F.when(is_read, F.col("_tot_r")).otherwise(F.col("_tot_w"))
    views = F.array(
        F.struct(F.col(rw_col).alias("access"), own_pos.alias("pos"), own_tot.alias("n_rows")),
        F.struct(
            F.lit("RW").alias("access"), (F.col("_off_all") + F.col("_rn_all")).alias("pos"),
            F.col("_tot_all").alias("n_rows"),
        ),
    )
    return joined.select(*[F.col("_k")[k].alias(k) for k in keys], F.inline(views), *carry)


def ordered_positions(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    pos_col: str = "pos",
    bucket_col: str | None = None,
    with_totals: bool = False,
    adaptive: bool = False,
):
    """``row_number() over (partition by keys order by order_cols)`` without
    putting a whole key on one task: the two-level scheme of
    :func:`access_positions` for a single view.

    The bucket is ``order_cols[0] div bucket_rows`` (the first order column
    must be numeric; rows where it is null come first; for timestamps pass epoch microseconds, for
    which ``bucket_rows`` is a time width), or the given ``bucket_col``, which
    must be monotone in the order.  With ``with_totals`` also returns the
    per-key row counts ``(keys, n)`` computed from the same exchange.

    With ``adaptive`` the rows are dealt out by range instead (see
    :func:`_with_buckets`), for order values of any type and spread.
    """
    keys = list(keys)
    order_cols = list(order_cols)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # Floating-point keys as text: Spark partitions those by another expression than the column, and would shuffle again.
    plain = [(F.col(c) + F.lit(0.0)).cast("string").alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in keys]
    base = df.withColumn("_k", F.struct(*plain))
    if bucket_col:
        base = base.withColumn("_b", F.coalesce(F.col(bucket_col).cast("long"), F.lit(_NULL_BUCKET)))
    else:
        base = _with_buckets(base, order_cols, bucket_rows, adaptive)
    counts = base.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_k", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = base.repartition("_k", "_b").withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_k", "_b").orderBy(*order_cols))
    )
    out = (
        ranked.join(offsets, on=["_k", "_b"], how="inner")
        .withColumn(pos_col, F.col("_off") + F.col("_rn"))
        .drop("_k", "_b", "_off", "_rn")
    )
    if with_totals:
        return out, counts.groupBy("_k").agg(F.sum("_n").alias("n")).select(
            *[F.col("_k")[k].cast(kinds[k]).alias(k) for k in keys], "n"
        )
    return out
