"""SimHash near-dedup with the pigeonring filter.

Fingerprint: words `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased,
shingles of ``shingle`` words (repeats included; a shorter text is one
shingle), XXH64 of each with seed 42; a bit is 1 if more than half of the
hashes have it. No word: zero, linked like any other.

Links at ``distance`` d or fewer differing bits, over the distinct
fingerprints: cut the bits into m = d + 1 segments in a ring. If two
fingerprints differ in at most d bits, some segment starts a chain in which
the first l segments differ in at most l * d / m bits, for every l. So that
start segment is equal, the next one differs in at most one bit (one of its
halves is equal), and of the next one and a half segments, in at most two bits
(one of their three parts is equal). These 24 equalities (for d = 3) of 32 bits
are the join keys: no pair within the distance can miss all of them, and two
unrelated fingerprints rarely share one. Within a key, pairs are pruned by the
chain condition before the full Hamming check.

A key that holds more than ``CELL`` fingerprints is dealt out as a grid of
cells, each pair of chunks in one task, so no group is ever gathered in one
task. A cell emits the stars of its links, not its pairs: components stay
whole, and the rows stay linear. Components come from :mod:`components`.

Null counts as empty; an empty table gives an empty result; a null id is
ignored as a component's name unless all of the component's ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C
from .components import connected_components
from .key_filter import KeyFilter, free_names

BITS = 64
#: Fingerprints in a chunk of a large key; a cell holds two chunks at most.
CELL = 512


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of one text (lower-casing and splitting as the module says), as unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
    else:
        whole = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = xxhash.xxh64_intdigest
        hashes = np.array([h(whole[a:b], 42) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        block = hashes[part : part + (1 << 16)]
        ones += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): a hash that tells texts of one id apart, and the fingerprint as signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, shingle) for t in C.large_binary(batch.column("text")).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(values.view(np.int64))], names=["doc_id", "text_key", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), _text_key(text_col).alias("text_key"), C.text_bytes(text_col).alias("text"))
    return C.map_blocks(rows, f"doc_id {kind}, text_key long, fp long", work)


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit from below, width) of each of the distance + 1 segments."""
    m = distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _halves(segment: tuple[int, int]) -> list[tuple[int, int]]:
    at, width = segment
    return [(at, width // 2), (at + width // 2, width - width // 2)]


def ring_keys(distance: int) -> list[list[tuple[int, int]]]:
    """Sets of bit fields; fingerprints within the distance agree on all fields of one set at least."""
    ring = segments(distance)
    m = len(ring)
    if m == 1:
        return [ring]
    keys = []
    for i in range(m):
        following = _halves(ring[(i + 1) % m])
        for j in range(2):
            if m == 2:
                keys.append([ring[i], following[j]])
                continue
            for part in [following[1 - j], *_halves(ring[(i + 2) % m])]:
                keys.append([ring[i], following[j], part])
    return keys


def _key(fields: list[tuple[int, int]], name: int) -> Column:
    """The fields' bits side by side, under the number of their set."""
    out = F.lit(name).cast("long")
    for at, width in fields:
        bits = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))
        out = F.shiftleft(out, width).bitwiseOR(bits)
    return out


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs (broadcast against each other) are within the distance: the chain condition, then the Hamming check."""
    x = a ^ b
    if distance == 0:
        return x == 0
    ring = segments(distance)
    m = len(ring)
    diffs = [np.bitwise_count((x >> np.uint64(at)) & np.uint64((1 << width) - 1)) for at, width in ring]
    chained = np.zeros(x.shape, dtype=bool)
    for i in range(m):
        total = diffs[i].astype(np.int16)
        fits = total <= distance / m
        for step in range(1, m):
            total = total + diffs[(i + step) % m]
            fits &= total * m <= (step + 1) * distance
        chained |= fits
    found = np.zeros(x.shape, dtype=bool)
    found[chained] = np.bitwise_count(x[chained]) <= distance
    return found


def stars(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct fingerprints of one cell, as edges from each linked one to the first of its component."""
    n = len(values)
    close = near(values[:, None], values[None, :], distance)
    root = np.arange(n)
    while True:
        new = np.where(close, root[None, :], n).min(axis=1)
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = np.flatnonzero(root != np.arange(n))
    return values[linked], values[root[linked]]


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """``fps``: distinct fingerprints (fp). Returns edges (u, v) whose components are those of all links."""
    if distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    sets = ring_keys(distance)
    keyed = fps.select("fp", F.explode(F.array(*[_key(f, i) for i, f in enumerate(sets)])).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    grid = F.ceil(F.col("n") / F.lit(CELL)).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("grid")).cast("int")
    # Spark takes the exploded keys for as small as the fingerprints and would broadcast them: 24 rows each, through the driver.
    shared = keyed.join(sizes.hint("merge"), "key").select("key", "fp", grid.alias("grid")).withColumn("chunk", chunk)
    other = F.explode(F.when(F.col("grid") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("grid") - 1), lambda c: c != F.col("chunk"))))
    cells = shared.withColumn("other", other).select("key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [np.zeros(0, np.int64) for _ in range(4)]

        def edges(cols: list[np.ndarray], upto: int) -> pa.RecordBatch:
            name = np.stack(cols[:3])[:, :upto]
            fp = cols[3][:upto].view(np.uint64)
            cut = np.concatenate([[0], np.flatnonzero((name[:, 1:] != name[:, :-1]).any(axis=0)) + 1, [upto]])
            sizes = np.diff(cut)
            two = cut[:-1][sizes == 2]
            hit = near(fp[two], fp[two + 1], distance)
            left, right = [fp[two][hit]], [fp[two + 1][hit]]
            for k in np.flatnonzero(sizes > 2):
                u, v = stars(fp[cut[k] : cut[k + 1]], distance)
                left.append(u)
                right.append(v)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["u", "v"])

        for batch in batches:
            cols = [np.concatenate([c, np.asarray(batch.column(i)).astype(np.int64)]) for i, c in enumerate(carried)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1])) if len(cols[0]) else []
            upto = int(last[-1]) + 1 if len(last) else 0
            if upto:
                yield edges(cols, upto)
            carried = [c[upto:] for c in cols]
        if len(carried[0]):
            yield edges(carried, len(carried[0]))

    dealt = cells.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return dealt.mapInArrow(work, "u long, v long")


def _grouped(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, fp, component_id)."""
    prints = stage_table(fingerprints(docs, shingle, id_col, text_col), "simhash")
    named = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    parts = connected_components(links(named.select("fp"), distance))
    members = parts.join(named.select(F.col("fp").alias("node"), "least"), "node")
    names = members.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = members.join(names, "component").select(F.col("node").alias("fp"), "component_id")
    # Documents alone with their fingerprint name themselves; the others' names are staged, so that Spark can split a hot fingerprint in the join.
    shared = named.join(linked, "fp", "left").where("n > 1 or component_id is not null").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("shared"))
    joined = prints.join(stage_table(shared, "simhash-shared"), "fp", "left")
    return joined.select("doc_id", "text_key", "fp", F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def simhash_groups(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest id reachable over links)."""
    return _grouped(docs, shingle, distance, id_col, text_col).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one document a component stays: the one that names it.

    Rows that share an id are told apart by their texts (equal ones stay or
    go together). Rows without id go if their component has a name, else they stay.
    """
    groups = _grouped(docs, shingle, distance, id_col, text_col)
    gone_id, gone_key = free_names(docs, "gone_id", "gone_key")
    gone = stage_table(groups.where("not (doc_id <=> component_id)").select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct(), "simhash-gone")
    # Only rows that can be among them are joined; the others pass by.
    maybe, stay = KeyFilter(gone.select(gone_key)).split(docs, _text_key(text_col))
    return stay.unionByName(maybe.join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (_text_key(text_col) == F.col(gone_key)), "left_anti"))
