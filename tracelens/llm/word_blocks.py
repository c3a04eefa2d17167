"""Dictionary-encoded blocks of texts.

A block is up to ``most`` bytes of consecutive texts in one task. Its words
(split at ASCII white space) are numbered in order of first appearance, so
what is known of a word travels once for a block, not once for each place
where it stands. The words are dealt out to buckets by hash, packed: a row
holds a block's words of one bucket. All of a word's rows meet in its bucket,
where it is looked at once, and what was found goes back to the blocks as rows
packed alike. A word is in a block's row once, so no word is hot, and a bucket
holds its share of the distinct words, whatever the skew of the texts.

Both tables, the words and the coded texts, come from the same scan of the
same rows, so ``docs`` must give the same partitions whenever it is read: a
file scan or a staged table does (see :func:`tracelens.session.stage_table`).
Blocks are named by partition and number, carry a hash of what they hold, and
:func:`with_words` fails loudly if two reads differ.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common as C

#: Bytes of text in a block, about.
MOST = 16 << 20
#: Buckets of words for each partition of the texts, and at most.
BUCKETS, MOST_BUCKETS = 4, 1 << 16


def pack(codes: np.ndarray) -> bytes:
    """Codes as little-endian planes of bytes, compressed: mostly small numbers, so high planes vanish."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], most: int, lower: bool):
    part = TaskContext.get().partitionId() << 24
    for number, batch in enumerate(C.blocks(batches, "text", most)):
        texts = C.lowered(batch.column("text")) if lower else C.large_binary(batch.column("text"))
        words, offsets = C.split_words(texts)
        coded = words.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        check = xxhash.xxh64_intdigest(texts.buffers()[2] or b"") >> 1
        yield part + number, check, batch, coded.dictionary, np.asarray(coded.indices, dtype=np.int64), offsets


def buckets_for(docs: DataFrame) -> int:
    """Buckets that keep the words of each to a few MB, however large the input."""
    return min(MOST_BUCKETS, max(16, BUCKETS * docs.rdd.getNumPartitions()))


def block_words(docs: DataFrame, buckets: int, most: int = MOST, lower: bool = False, counted: str | None = None) -> DataFrame:
    """(bucket, block, hash, codes, words[, counts]): each block's words of each bucket, packed.

    ``counted`` names a boolean column: counts say how often each word stands
    in rows where it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, batch, words, codes, offsets in _blocks(batches, most, lower):
            distinct = words.cast(pa.large_binary()).to_pylist()
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in distinct), np.int64, len(distinct))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            counts = None
            if counted:
                rows = np.asarray(batch.column(counted).to_numpy(zero_copy_only=False), dtype=bool)
                counts = np.bincount(codes[np.repeat(rows, np.diff(offsets))], minlength=len(distinct))
            held = []
            for k in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[k] : cuts[k + 1]]
                row = {"bucket": int(k), "block": block, "hash": check, "codes": pack(mine), "words": zstandard.compress(b"\n".join([distinct[i] for i in mine]), 1)}
                held.append(row | {"counts": pack(counts[mine])} if counted else row)
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    kinds = {"bucket": pa.int32(), "block": pa.int64(), "hash": pa.int64(), "codes": pa.binary(), "words": pa.binary()}
    schema = pa.schema(kinds | ({"counts": pa.binary()} if counted else {}))
    return docs.mapInArrow(run, "bucket int, block long, hash long, codes binary, words binary" + (", counts binary" if counted else ""))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b"\n")


def block_texts(docs: DataFrame, most: int = MOST, lower: bool = False) -> DataFrame:
    """(block, hash, all columns but text, codes) of the same blocks; codes as :func:`pack` has them."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(["block long", "hash long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "codes binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, batch, _, codes, offsets in _blocks(batches, most, lower):
            n = batch.num_rows
            packed = [pack(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [pa.array(np.full(n, block)), pa.array(np.full(n, check)), *(batch.column(f.name) for f in rest), pa.array(packed, pa.binary())]
            whole = pa.RecordBatch.from_arrays(columns, names=["block", "hash", *(f.name for f in rest), "codes"])
            for start in range(0, n, 4096):
                yield whole.slice(start, 4096)

    return docs.mapInArrow(run, schema)


def with_words(texts: DataFrame, words: DataFrame, work: Callable[[pa.Table, list[dict]], pa.Table], schema: str) -> DataFrame:
    """``work`` over each block's texts and the rows of its words, one a bucket."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if len({*left.column("hash").unique().to_pylist(), *right.column("hash").unique().to_pylist()}) > 1:
            raise ValueError("the input changed between two reads; stage it as a table first")
        return work(left, right.to_pylist())

    return texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, schema)
