"""Which rows can match a table of keys: a bitmap over their hashes, tested row by row.

A join that takes few rows out of a large table moves all of it through a
shuffle. With the bitmap only rows that can match are joined; the others pass
by. The bitmap has about BITS_A_KEY bits a key and MOST_BITS at most, so what
is broadcast has a fixed bound (32 MB); beyond SPARSE_BITS keys a bit would tell
too little, and every row counts as one that can match. All of it is done in
Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

BITS_A_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: With more keys than MOST_BITS / SPARSE_BITS there is no filter.
SPARSE_BITS = 4
#: Bits in a row of the broadcast table, as an array of 64-bit words.
ROW_BITS = 4096


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that ``df`` has no column of, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


class KeyFilter:
    """Built once from ``keys`` (one column of 64-bit hashes); :meth:`split` may be used on any table."""

    def __init__(self, keys: DataFrame):
        name = keys.columns[0]
        n = keys.count()
        self.all_match = n * SPARSE_BITS > MOST_BITS
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, n) * BITS_A_KEY - 1).bit_length()))
        if self.all_match:
            return
        at = F.col(name).bitwiseAND(F.lit(self.bits - 1))
        word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")
        words = keys.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).select("word", F.expr("shiftleft(one, bit)").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        per_row = ROW_BITS // 64
        found = words.groupBy(F.expr(f"word div {per_row}").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % per_row).cast("int").alias("k"), "bits"))).alias("held"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(per_row - 1)), lambda k: F.coalesce(F.element_at("held", k), F.lit(0).cast("long")))
        self.table = stage_table(found.select("row", dense.alias("words")), "key-filter")

    def split(self, df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """The rows of ``df`` whose ``key`` (a 64-bit hash) can be among the keys, and the others; no row is in both."""
        if self.all_match:
            return df, df.where(F.lit(False))
        at, row, words = free_names(df, "filter_at", "filter_row", "filter_words")
        mine = F.broadcast(self.table.select(F.col("row").alias(row), F.col("words").alias(words)))
        placed = df.withColumn(at, key.bitwiseAND(F.lit(self.bits - 1))).join(mine, F.expr(f"`{at}` div {ROW_BITS}") == F.col(row), "left")
        word = F.expr(f"element_at(`{words}`, CAST((`{at}` div 64) % {ROW_BITS // 64} AS INT) + 1)")
        hit = F.coalesce(F.getbit(word, F.col(at) % 64) == 1, F.lit(False))
        return placed.where(hit).select(*_columns(df)), placed.where(~hit).select(*_columns(df))


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
