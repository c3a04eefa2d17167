"""Helpers shared by the training-data operators.

Every operator reads only the columns it needs, by name, so further columns
of any name ride along untouched. Texts reach Python as Arrow binary: no
decoding on the way, no pandas objects, and a null text arrives as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass inside a task works on at a time.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the corpus folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit("").cast("binary"))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id, written as text, leaves ``remainder``. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text: a memory bound whatever Spark's batches hold.

    A batch has more bytes only if a single text does.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        start = 0
        for row, n in enumerate(lengths):
            if size and size + n > most:
                if row > start:
                    held.append(batch.slice(start, row - start))
                yield _joined(held)
                held, size, start = [], 0, row
            size += int(n)
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def large_binary(column: pa.Array) -> pa.LargeBinaryArray:
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of each text, split at ASCII white space (space, tab to carriage return).

    Returns the words of all texts in a row, and for each text the place where
    its words begin (one place more at the end).
    """
    as_text = large_binary(column).view(pa.large_string())  # the ASCII kernels work on bytes, valid UTF-8 or not
    lists = pc.ascii_split_whitespace(as_text)
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not full.all():  # white space at an end leaves empty strings
        before = np.concatenate([[0], np.cumsum(full)])
        flat, offsets = flat.filter(pa.array(full)), before[offsets]
    return flat, offsets


#: Lower-cases A-Z and makes a space of every ASCII byte that is neither digit nor letter; other bytes stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def alnum_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of each text after lower-casing A-Z, as :func:`split_words` gives them."""
    binary = large_binary(column)
    return split_words(mapped(binary, WORD_BYTES))


def lowered(column: pa.Array) -> pa.LargeBinaryArray:
    """Texts with A-Z lower-cased, all else as it is."""
    return mapped(large_binary(column), bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))


def mapped(binary: pa.LargeBinaryArray, mapping: bytes) -> pa.LargeBinaryArray:
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64, count=len(binary) + 1 + binary.offset)[binary.offset :]
    data = binary.buffers()[2]
    body = data.to_pybytes()[offsets[0] : offsets[-1]].translate(mapping) if data is not None else b""
    moved = pa.py_buffer(np.ascontiguousarray(offsets - offsets[0]))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(binary), [None, moved, pa.py_buffer(body)])


def map_blocks(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text") -> DataFrame:
    """``work`` over blocks of rows; a block holds about :data:`BLOCK_BYTES` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            out = work(block)
            if out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def lists_of(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow lists out of numpy arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
