"""Benchmark decontamination with an FM-index per shard of the corpus.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A
window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window. A shard is a block of a few MB of documents inside a
task. Its index holds the runs of words that some item has: every other word,
and every end of a document, ends a run, for no window can cross it; runs
shorter than the shortest window are left out likewise. All distinct windows
are searched backwards at once, their places are found by sampled suffix
positions, and the hit words merge into removal spans.

No document is shuffled. The items' windows are built in Spark, in parts of
about ``ITEM_WORDS`` words (one part unless the benchmark is huge; a longer item
is dealt out in stretches), and staged. A pass over the documents takes one
part, which alone is broadcast and released again. With several parts, passes
leave the hits of rows that have some, which then meet by row; ``docs`` must
then give the same rows whenever it is read: a file scan or a staged table does.

Null texts have no words. A null item id hits as any other but has no name to
report; ids that repeat count once. Empty tables give no hits.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C
from .fm_index import FMIndex
from .key_filter import KeyFilter, free_names

#: Item words in one part, about, which is what a broadcast holds.
ITEM_WORDS = 1 << 21


class Windows:
    """The distinct windows of a part of the items, as numbers of the part's words (from 1), and their items."""

    def __init__(self, ids: list[str | None], texts: list[bytes], window: int):
        words, offsets = C.alnum_words(pa.array(texts, type=pa.large_binary()))
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary.cast(pa.large_binary())
        codes = np.asarray(coded.indices, dtype=np.int64) + 1
        rows: dict[bytes, int] = {}
        self.lengths, kept, pairs = [], [], set()
        for item, (a, b) in zip(ids, zip(offsets[:-1], offsets[1:], strict=True), strict=True):
            for start in range(a, max(a, b - window) + 1 if b > a else a):
                piece = codes[start : min(b, start + window)]
                k = rows.setdefault(piece.tobytes(), len(rows))
                if k == len(kept):
                    kept.append(np.concatenate([np.zeros(window - len(piece), np.int64), piece]))
                    self.lengths.append(len(piece))
                if item is not None:
                    pairs.add((k, item))
        self.phrases = np.array(kept, dtype=np.int64).reshape(-1, window)
        self.lengths = np.array(self.lengths, dtype=np.int64)
        owned = sorted(pairs)
        self.owners = [item for _, item in owned]
        self.first = np.searchsorted(np.array([k for k, _ in owned], dtype=np.int64), np.arange(len(kept) + 1))

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences in the texts: (text, first word within it, words, window); and the words of each text."""
        none = np.zeros(0, np.int64)
        words, offsets = C.alnum_words(texts)
        sizes = np.diff(offsets)
        if not len(self.phrases) or not len(words):
            return none, none, none, none, sizes
        found = pc.index_in(words.view(pa.large_binary()), value_set=self.vocabulary)
        codes = np.asarray(pc.fill_null(found, -1), dtype=np.int64) + 1
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        known = np.flatnonzero(codes)
        if not len(known):
            return none, none, none, none, sizes
        begins = np.append(True, (np.diff(known) > 1) | (np.diff(text_of[known]) > 0))
        run = np.cumsum(begins) - 1
        long = np.bincount(run) >= self.lengths.min()
        known, begins, run = known[long[run]], begins[long[run]], run[long[run]]
        if not len(known):
            return none, none, none, none, sizes
        place = np.arange(len(known)) + np.cumsum(begins) - 1
        sequence, origin = np.zeros(place[-1] + 2, np.int64), np.zeros(place[-1] + 2, np.int64)
        sequence[place], origin[place] = codes[known], known
        index = FMIndex(sequence, len(self.vocabulary))
        low, high = index.count(self.phrases, self.lengths)
        many = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(many)), many)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]
        word = origin[index.locate(rows)]
        text = text_of[word]
        return text, word - offsets[text], self.lengths[which], which, sizes


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans of words, those that overlap or touch in one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], True)].tolist(), strict=True))


def item_parts(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A staged row for each part of the items' windows: (windows), a pickled :class:`Windows`."""

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of an item in stretches that share window - 1 words, so that each window is in one."""
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = text.translate(C.WORD_BYTES).split()
                if words:
                    rows += [(name, b" ".join(part := words[a : a + ITEM_WORDS + window - 1]), len(part)) for a in range(0, max(1, len(words) - window + 1), ITEM_WORDS)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64()))], names=["id", "text", "n"])

    def build(table: pa.Table) -> pa.Table:
        windows = Windows(table.column("id").to_pylist(), table.column("text").to_pylist(), window)
        return pa.table({"windows": pa.array([pickle.dumps(windows)], pa.binary())})

    items = benchmark.select(F.col(id_col).cast("string").alias("id"), C.text_bytes(text_col).alias("text")).distinct()
    parts = stage_table(items.mapInArrow(stretch, "id string, text binary, n long"), "benchmark-stretches")
    total = parts.agg(F.sum("n")).first()[0] or 0
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, -(-total // ITEM_WORDS)))).alias("part")
    return stage_table(parts.select(part, "id", "text").groupBy("part").applyInArrow(build, "windows binary"), "benchmark-parts")


def _each_part(parts: DataFrame) -> Iterator[Broadcast]:
    """The parts one after the other, each broadcast until the next one is asked for."""
    context = parts.sparkSession.sparkContext
    for row in parts.toLocalIterator():
        shared = context.broadcast(pickle.loads(row["windows"]))
        yield shared
        shared.unpersist()


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _hits(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(row, spans, items) of the rows (row, text) that some part hits, a pass a part; staged."""
    found = None
    for shared in _each_part(parts):
        one = C.map_blocks(rows.select("row", "text"), "row long, spans array<struct<start:long,end:long>>, items array<string>", lambda batch, shared=shared: _search(batch, shared.value, "row", True))
        staged = stage_table(one, "benchmark-hits")
        found = staged if found is None else found.unionByName(staged)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for own in batch.column("spans").to_pylist():
                ends = [np.array([x[k] for x in own], np.int64) for k in ("start", "end")]
                spans.append([{"start": a, "end": b} for a, b in _merged(*ends)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, _SPANS), batch.column("items")], names=["row", "spans", "items"])

    both = found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return stage_table(both.mapInArrow(merge, found.schema), "benchmark-hit-rows")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document: doc_id, n_words, spans (merged hit words: start, end exclusive), items (sorted ids)."""
    parts = item_parts(benchmark, window, item_col)
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("doc_id"), C.text_bytes(text_col).alias("text"))
    if parts.count() < 2:
        held = parts.first()  # no items: still the words of each document
        shared = docs.sparkSession.sparkContext.broadcast(pickle.loads(held["windows"]) if held else Windows([], [], window))
        schema = f"doc_id {kind}, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
        return C.map_blocks(own, schema, lambda batch: _search(batch, shared.value, "doc_id", False))
    rows = own.withColumn("row", F.monotonically_increasing_id())
    hits = _hits(rows, parts).select(F.col("row").alias("hit_row"), "spans", "items")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, offsets = C.alnum_words(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64())], names=["row", "doc_id", "n_words"])

    counted = C.map_blocks(rows.select("row", "doc_id", "text"), f"row long, doc_id {kind}, n_words long", count)
    none = lambda c: F.coalesce(c, F.expr("array()").cast(hits.schema[c].dataType)).alias(c)
    return counted.join(hits, F.col("row") == F.col("hit_row"), "left").select("doc_id", "n_words", none("spans"), none("items"))


def _search(batch: pa.RecordBatch, windows: Windows, key: str, hit_only: bool) -> pa.RecordBatch:
    """Spans and items of each text, with its words; or of the texts that have any, without."""
    text, start, size, which, sizes = windows.hits(batch.column("text"))
    spans, items = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
    rows = np.unique(text)
    for row in rows.tolist():
        mine = order[cuts[row] : cuts[row + 1]]
        spans[row] = [{"start": x, "end": y} for x, y in _merged(start[mine], start[mine] + size[mine])]
        own: set[str] = set()
        for k in np.unique(which[mine]).tolist():
            own.update(windows.owners[windows.first[k] : windows.first[k + 1]])
        items[row] = sorted(own)
    columns = {key: batch.column(key)} | ({} if hit_only else {"n_words": pa.array(sizes, pa.int64())}) | {"spans": pa.array(spans, _SPANS), "items": pa.array(items, pa.list_(pa.string()))}
    out = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return out.take(pa.array(rows)) if hit_only else out


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given spans of words; a line end stands in for each."""
    body = np.frombuffer(text.translate(C.WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], body, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = int(ends[b - 1])
    out.append(text[at:])
    return b"\n".join(out)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs``, all columns, with the removal spans cut out of the texts, until no window occurs in any.

    Rows without hits keep their text byte for byte, null texts included.
    """
    parts = item_parts(benchmark, window, item_col)
    if parts.count() > 1:
        return _remove_in_passes(docs, parts, text_col)
    held = parts.first()
    if held is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(pickle.loads(held["windows"]))

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(text_col)
        now = C.large_binary(column.cast(pa.large_binary()))
        touched: dict[int, bytes] = {}
        look = np.arange(batch.num_rows)  # rows that can have windows: all, then those that were cut
        while len(look):
            texts = pa.array([touched[int(r)] for r in look], pa.large_binary()) if touched else now  # a cut can bring words together
            text, start, size, _, _ = shared.value.hits(texts)
            hit = np.unique(text)
            for row in hit.tolist():
                mine = text == row
                touched[int(look[row])] = cut_spans(texts[row].as_py(), _merged(start[mine], start[mine] + size[mine]))
            look = look[hit]
        if not touched:
            return batch
        values = column.to_pylist()
        for row, text in touched.items():
            values[row] = text.decode("utf-8", "replace")
        return batch.set_column(batch.schema.get_field_index(text_col), batch.schema.field(text_col), pa.array(values, column.type))

    return C.map_blocks(docs, docs.schema, clean, text=text_col)


def _remove_in_passes(docs: DataFrame, parts: DataFrame, text_col: str) -> DataFrame:
    """The same with several parts: rounds of passes over the rows that the round before cut, at first over all."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut_spans(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary())], names=["row", "text"])

    row, new_row, new_text = free_names(docs, "row", "new_row", "new_text")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    look = numbered.select(F.col(row).alias("row"), C.text_bytes(text_col).alias("text"))
    rounds: list[DataFrame] = []
    while True:
        hits = _hits(look, parts)
        if hits.isEmpty():
            break
        maybe, _ = KeyFilter(hits.select("row")).split(look, F.col("row"))  # only they are joined
        look = stage_table(maybe.join(hits.select("row", "spans"), "row").mapInArrow(cut, "row long, text binary"), "benchmark-cut")
        rounds.append(look.withColumn("round", F.lit(len(rounds))))
    if not rounds:
        return docs
    newest = reduce(DataFrame.unionByName, rounds).groupBy("row").agg(F.max_by("text", "round").alias("text"))
    newest = stage_table(newest.select(F.col("row").alias(new_row), F.col("text").cast("string").alias(new_text)), "benchmark-clean")
    maybe, rest = KeyFilter(newest.select(new_row)).split(numbered, F.col(row))
    joined = maybe.join(newest, F.col(row) == F.col(new_row), "left").withColumn(text_col, F.coalesce(F.col(new_text), F.col(text_col)))
    return rest.drop(row).unionByName(joined.drop(row, new_row, new_text))
