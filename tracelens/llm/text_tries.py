"""Filter interaction audit over radix tries of whole texts.

Which texts are copies is found with compressed radix tries:

1. Texts are dealt into ranges by adaptive prefixes: a range is all texts with
   one prefix, and a prefix that more than a bounded share of the distinct
   texts (or their bytes) begin with is replaced by longer ones, four times as
   long each time, until its texts part or end.
2. A task enters its texts into a trie of its own, whole. A terminal holds the
   least id that came by. A row with a larger id than its terminal's is a copy
   for certain and needs its text no more; of the others one entry a text and
   task goes on, however many copies the task read.
3. The entries of a range are entered into one trie; afterwards a traversal
   tells for each whether its id is the least of its text.

The other filters look at a text alone. They are applied once to each text of
a task, when its terminal is made, as bits of a mask. The masks are reduced to
counts by (part, mask, labels), and every order of the filters is replayed on
those counts alone.

A null text counts as empty; empty texts are copies of each other. A null id
has no order: its row is no copy, and makes none. Rows repeated with their id
are no copies of each other. Repeated labels of an id: one that holds is
enough. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Length in bytes of the first prefixes, and by what it grows.
PREFIX, LONGER = 16, 4
#: A prefix is too common with more distinct texts or bytes than these, or than the whole divided by RANGES.
RANGE_ROWS, RANGE_BYTES, RANGES = 512, 4 << 20, 1 << 20
#: Bytes of text that a task's own trie holds before its entries go on.
TASK_BYTES = 32 << 20

#: The filters, in the order of their bits; the last one is that of copies.
FILTERS = "ABCDE"
_UPPER, _SIGNS = bytes(range(65, 91)), b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))


def failing(text: bytes) -> int:
    """The mask of the filters that a text fails by itself. Words are split at ASCII white space.

    A: fewer than 100 words; B: less than 80 % distinct words; C: more than
    10 % capitals A-Z; D: any of ``#$%&*|``.
    """
    words = text.split()
    n = len(words)
    found = 1 if n < 100 else 0
    if 100 * len(set(words)) < 80 * n:
        found |= 2
    if 100 * (len(text) - len(text.translate(None, _UPPER))) > 10 * len(text.translate(None, _CONTINUATION)):
        found |= 4
    if len(text.translate(None, _SIGNS)) != len(text):
        found |= 8
    return found


class Node:
    """The bytes on the edge to this node, the nodes below by first byte, and what a terminal holds."""

    __slots__ = ("label", "below", "least", "held")

    def __init__(self, label: bytes):
        self.label, self.below, self.least, self.held = label, None, None, None


class TextTrie:
    """Compressed radix trie over whole texts."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def terminal(self, text: bytes) -> Node:
        """The node at which the text ends, made if there is none."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.below.get(text[at]) if node.below else None
            if child is None:
                child = Node(text[at:])
                self.size += n - at
                if node.below is None:
                    node.below = {}
                node.below[text[at]] = child
                return child
            label = child.label
            if text.startswith(label, at):
                at += len(label)
                node = child
                continue
            low, high = 1, min(len(label), n - at)  # so many bytes are equal: at least one, not the whole label
            while low < high:
                middle = (low + high + 1) // 2
                if text.startswith(label[low:middle], at + low):
                    low = middle
                else:
                    high = middle - 1
            upper = Node(label[:low])
            upper.below = {label[low]: child}
            child.label = label[low:]
            node.below[text[at]] = upper
            node, at = upper, at + low
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every node that holds something, with its text, in the order of the texts."""
        waiting = [(b"", self.root)]
        while waiting:
            before, node = waiting.pop()
            text = before + node.label
            if node.held is not None:
                yield text, node
            if node.below:
                waiting.extend((text, node.below[k]) for k in sorted(node.below, reverse=True))


def common_prefixes(docs: DataFrame) -> list[tuple[int, np.ndarray]]:
    """Lengths with the prefixes (as sorted XXH64) of that length that are too common to be a range; the last has none.

    Copies count once. At most 2 * RANGES prefixes of a length can be too
    common, which bounds what comes to the driver.
    """
    whole = docs.select(F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"), "text")
    levels: list[tuple[int, np.ndarray]] = []
    length, most = PREFIX, None
    while True:
        prefix = F.xxhash64(F.expr(f"substring(text, 1, {length})"))
        some = whole
        if levels:
            before, hot = levels[-1]
            hashes = docs.sparkSession.createDataFrame([(int(h),) for h in hot], "p long")
            some = whole.withColumn("p", F.xxhash64(F.expr(f"substring(text, 1, {before})"))).join(F.broadcast(hashes), "p", "left_semi").where(F.col("size") > before)
        texts = some.select(prefix.alias("p"), "h", "size").groupBy("p", "h").agg(F.max("size").alias("size"))
        sizes = texts.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
        if most is None:
            total = whole.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
            most = max(RANGE_ROWS, total["n"] // RANGES), max(RANGE_BYTES, (total["size"] or 0) // RANGES)
        # One text by itself can't be parted, however long.
        hot = sizes.where((F.col("n") > 1) & ((F.col("n") > most[0]) | (F.col("size") > most[1]))).select("p").toPandas()["p"].to_numpy(dtype=np.int64)
        levels.append((length, np.sort(hot)))
        if not len(hot):
            return levels
        length *= LONGER


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _range_of(text: bytes, levels: list[tuple[int, np.ndarray]]) -> int:
    for length, hot in levels:
        name = _signed(xxhash.xxh64_intdigest(text[:length], 42))
        at = int(np.searchsorted(hot, name)) if len(hot) else 0
        if len(text) <= length or at == len(hot) or hot[at] != name:
            break
    return name


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", own: Callable[[bytes], int] = failing, copy_bit: int = 1 << 4) -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id fail which filters.

    ``own`` gives the mask of a text by itself; ``copy_bit`` is added where a
    smaller id has the same text. A null part is the empty string.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), C.text_bytes(text_col).alias("text"))
    levels = docs.sparkSession.sparkContext.broadcast(common_prefixes(rows))
    id_type = rows.schema["doc_id"].dataType
    kinds = ["range long", f"doc_id {id_type.simpleString()}", "part string", "mask int", "n long"]
    id_arrow = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    out_schema = pa.schema([("doc_id", id_arrow), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])
    entry_schema = pa.schema([("range", pa.int64()), *out_schema, ("text", pa.binary())])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, settled = TextTrie(), Counter()

        def entries() -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for text, node in trie.terminals():
                name, mask = _range_of(text, levels.value), node.held[0]
                for part, n in node.held[1].items():
                    held.append((name, node.least, part, mask, n, text))
                    size += len(text)
                if size >= C.BLOCK_BYTES:
                    yield _batch(held, entry_schema)
                    held, size = [], 0
            for k, ((i, part, mask), n) in enumerate(settled.items()):
                held.append((k, i, part, mask, n, None))  # needs no text and may go anywhere
            if held:
                yield _batch(held, entry_schema)

        for block in C.blocks(batches):
            for i, part, text in zip(*(block.column(c).to_pylist() for c in ("doc_id", "part", "text")), strict=True):
                node = trie.terminal(text)
                if node.held is None:
                    node.held = own(text), {}
                mask, tied = node.held
                if i is None:
                    settled[None, part, mask] += 1
                elif node.least is None or i < node.least:
                    for other, n in tied.items():
                        settled[node.least, other, mask | copy_bit] += n
                    tied.clear()
                    node.least, tied[part] = i, 1
                elif i == node.least:
                    tied[part] = tied.get(part, 0) + 1
                else:
                    settled[i, part, mask | copy_bit] += 1
            if trie.size >= TASK_BYTES:
                yield from entries()
                trie, settled = TextTrie(), Counter()
        yield from entries()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, waiting, now = TextTrie(), [], None
        out: list[tuple] = []

        def flush() -> None:
            out.extend((i, part, mask | (copy_bit if i > node.least else 0), n) for i, part, mask, n, node in waiting)

        for block in C.blocks(batches):
            for name, i, part, mask, n, text in zip(*(c.to_pylist() for c in block.columns), strict=True):
                if text is None:
                    out.append((i, part, mask, n))
                    continue
                if name != now:  # the range before is whole
                    flush()
                    trie, waiting, now = TextTrie(), [], name
                node = trie.terminal(text)
                node.least = i if node.least is None else min(node.least, i)
                waiting.append((i, part, mask, n, node))
            if out:
                yield _batch(out, out_schema)
                out = []
        flush()
        if out:
            yield _batch(out, out_schema)

    entries = rows.mapInArrow(settle, ", ".join([*kinds, "text binary"]))
    return entries.repartition("range").sortWithinPartitions("range").mapInArrow(decide, ", ".join(kinds[1:]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): the masks of :func:`failure_masks`, reduced. No row without id has a label."""
    marks = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    per_id = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = per_id.join(marks, "doc_id", "left").select("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    return marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def order_audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All orders of the filters, replayed on the counts: one row per part, filter_order and step.

    kept: documents that pass up to this step; removed: those that fail here
    first; redundant: those that fail here and were removed before;
    unique_fails: those that fail this filter alone; good_lost and toxic_lost:
    of the removed, those so labelled; shapley: the filter's removed, summed
    over all orders.
    """
    bit = {f: 1 << k for k, f in enumerate(filters)}
    orders = ["".join(p) for p in permutations(filters)]
    steps = [(o, k + 1, bit[f], sum(bit[g] for g in o[:k])) for o in orders for k, f in enumerate(o)]
    column = lambda k: F.element_at(F.lit([s[k] for s in steps]), F.col("i") + 1)
    each = counts.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))))
    each = each.withColumns({"bit": column(2), "before": column(3)})
    here, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda holds, name: F.sum(F.when(holds, F.col("n")).otherwise(0)).alias(name)
    found = each.groupBy("part", "i", "bit").agg(
        total(~here & ~earlier, "kept"), total(here & ~earlier, "removed"), total(here & earlier, "redundant"), total(F.col("mask") == F.col("bit"), "unique_fails"),
        total(here & ~earlier & F.col("good"), "good_lost"), total(here & ~earlier & F.col("toxic"), "toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit"))
    return found.select("part", column(0).alias("filter_order"), column(1).alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of :data:`FILTERS` in every order, by language."""
    return order_audit(mask_counts(failure_masks(docs), labels))
