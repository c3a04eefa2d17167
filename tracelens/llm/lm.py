"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are the words of a text (A-Z lower-cased, split at ASCII white space)
and one end. Counts of all words come from all training rows, through buckets
of words (:mod:`word_blocks`); no vocabulary is gathered anywhere.

The most frequent tokens (the end and up to ``FREQUENT - 1`` words) fall into
classes of ``SLOTS`` by rank; class 0 is every other word. A token's
probability is that of its class times that of its slot in the class, both
softmaxes over the summed weights of the active features: a bias, the word
before, the two words before, and as skips the second and the third word
before, hashed to ``ROWS`` rows of weights. The words of class 0, however many,
and one unknown are the leaves of a tree: its root has a child for each of up
to ``WAYS`` bands of counts, and in a band the words' numbers, digit by digit,
lead to the word. Each node is a softmax of its own, with the features of
slots hashed with the node to ``NODE_ROWS`` rows. A word is a context as
itself. All words, the unknown included, sum to one.

The numbers need no list of words: a bucket ranks its words by count, and the
driver adds up how many words of each band the buckets before it have.

Training takes one pass over the training tokens in ``UPDATES`` parts. In each
update, tasks sum the gradient of the log likelihood (observed less expected
feature counts) and the expected counts over all tokens of their rows; the
sums of all tasks meet in a grouped sum, first over groups of tasks; the
driver takes a step scaled by the expected counts and broadcasts the weights.
Weights and gradients have ``ROWS`` and ``NODE_ROWS`` rows, whatever the corpus
holds; words, nodes of the tree and contexts grow with it and share them.

Scoring runs over the encoded texts in sparse numpy batches: row numbers of
active features pick rows of weights.

Null counts as empty (one token, the end). Without training rows every count
is 0, the one unknown word is all there is, and both scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C
from . import word_blocks as W

#: Tokens with a class of their own, slots in a class, and classes (class 0 is all other words).
FREQUENT, SLOTS = 2016, 32
CLASSES = FREQUENT // SLOTS + 1
#: Children of a node of the tree of other words, as bits; digits of a word's number; levels of counts (half octaves).
WAY_BITS, DIGITS, LEVELS = 4, 8, 64
WAYS = 1 << WAY_BITS
#: Rows of weights of classes and slots and of nodes, and the number of updates.
ROW_BITS, NODE_BITS = 13, 15
ROWS, NODE_ROWS = 1 << ROW_BITS, 1 << NODE_BITS
UPDATES = 3
#: Step and smoothing of an update.
STEP, SMOOTH = 0.5, 2.0
#: Least weight beside the largest of its row: with the biases, products of exponentials stay in single precision.
LEAST = -15.0
#: Tokens in a numpy batch of training, where more share a row, and of scoring.
BATCH, SCORE_BATCH = 1 << 16, 1 << 15
#: Numbers in a piece of softmaxes that is worked on at once: two of them stay in a core's cache.
PIECE = 1 << 17
#: Rows of weights in one row of the gradient table, and groups of tasks whose sums meet first.
PART_ROWS, TASK_GROUPS = 256, 64

_START = (1 << 32) - 1  # what stands before a text; no word has this number
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _row(values: np.ndarray, kind: int, bits: int = ROW_BITS) -> np.ndarray:
    """Hashed row of a feature."""
    x = (values.astype(np.uint64) * np.uint64(16) + np.uint64(kind)) * _MIX
    x ^= x >> np.uint64(29)
    return ((x * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _level(counts: np.ndarray) -> np.ndarray:
    """Level of a count: half octaves."""
    return np.minimum(2 * np.log2(np.maximum(counts, 1)) + 1e-9, LEVELS - 1).astype(np.int64)


class Tree:
    """The other words and the unknown, the last, as leaves: numbers from ``starts[b]`` on are band ``b``, of so many tokens (``masses``)."""

    def __init__(self, starts: np.ndarray, masses: np.ndarray):
        self.starts, sizes = starts, np.diff(starts)
        self.depths = np.array([next(d for d in range(DIGITS + 1) if WAYS**d >= n) for n in sizes.tolist()])
        # a level of a band has one node that may lack leaves, its last; in all others the children are alike
        self.last = np.full((WAYS, DIGITS), -1)
        leaves = np.ones((2 + WAYS * DIGITS, WAYS))
        leaves[0] = masses / masses.sum()
        for b, (n, d) in enumerate(zip(sizes.tolist(), self.depths.tolist(), strict=True)):
            for level in range(d):
                each = WAYS ** (d - level - 1)
                self.last[b, level] = (n - 1) // (each * WAYS)
                leaves[2 + b * DIGITS + level] = np.clip(n - self.last[b, level] * each * WAYS - each * np.arange(WAYS), 0, each) / each
        with np.errstate(divide="ignore"):
            self.bias = np.log(leaves).astype(np.float32)

    def paths(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All nodes on the way to each number: its place in ``numbers``, the node, the row of its bias, and the child taken."""
        band = np.searchsorted(self.starts, numbers, side="right") - 1
        inside, depth = numbers - self.starts[band], self.depths[band]
        steps = [(np.arange(len(numbers)), np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64), band)]
        for level in range(int(depth.max(initial=0))):
            at = np.flatnonzero(depth > level)
            b = band[at]
            down = inside[at] >> WAY_BITS * (depth[at] - level - 1)
            node = down >> WAY_BITS
            steps.append((at, (b * DIGITS + level + 1 << 32) + node, np.where(node == self.last[b, level], 2 + b * DIGITS + level, 1), down & WAYS - 1))
        return tuple(np.concatenate(x) for x in zip(*steps, strict=True))


@dataclass
class Others:
    """Numbers of the other words: a word's rank in its bucket plus the shift of bucket and band; the first ``frequent`` of a bucket have none."""

    tree: Tree
    bands: np.ndarray
    shifts: np.ndarray
    frequent: np.ndarray

    def numbers(self, bucket: int, totals: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        return np.where(totals > 0, ranks + self.shifts[bucket, self.bands[_level(totals)]], self.tree.starts[-1] - 1)


def other_words(words: np.ndarray, tokens: np.ndarray, best: list[tuple[int, bytes]]) -> Others:
    """The tree and numbers, out of the words of each bucket and level, the tokens of each level, and the frequent words."""
    bucket = np.array([W.zlib.crc32(w) % len(words) for _, w in best], np.int64)
    count = np.array([-n for n, _ in best], np.int64)
    level = _level(count)
    left, tokens = words.copy(), tokens.copy()
    np.subtract.at(left, (bucket, level), 1)
    np.subtract.at(tokens, level, count)
    groups = [[k] for k in reversed(range(LEVELS)) if left[:, k].any()] or [[0]]
    while len(groups) > WAYS:
        k = min(range(len(groups) - 1), key=lambda k: tokens[groups[k] + groups[k + 1]].sum())
        groups[k : k + 2] = [groups[k] + groups[k + 1]]
    frequent = np.bincount(bucket, minlength=len(words))
    bands, masses, sizes = np.zeros(LEVELS, np.int64), np.zeros(WAYS), np.zeros(WAYS, np.int64)
    shifts = np.zeros((len(words), WAYS), np.int64)
    for b, levels in enumerate(groups):
        bands[levels], masses[b] = b, tokens[levels].sum()
        here = left[:, levels].sum(axis=1)
        before = np.maximum(frequent, words[:, max(levels) + 1 :].sum(axis=1))
        shifts[:, b] = sizes[:b].sum() + np.cumsum(here) - here - before
        sizes[b] = here.sum()
    sizes[len(groups) - 1] += 1  # the unknown
    masses[len(groups) - 1] += 1
    return Others(Tree(np.concatenate([[0], np.cumsum(sizes)]), masses), bands, shifts, frequent)


@dataclass
class Counts:
    """What the corpus says: tokens, distinct tokens, and the frequent words in order (the end is number 0)."""

    tokens: int
    distinct: int
    words: list[bytes]
    word_counts: list[int]
    ends: int
    others: Others | None = None

    def other_tokens(self) -> int:
        return self.tokens - self.ends - sum(self.word_counts)


@dataclass
class Weights:
    """Bias and feature weights of classes, of slots and, where there is a tree, of its nodes."""

    class_bias: np.ndarray
    slot_bias: np.ndarray
    classes: np.ndarray
    slots: np.ndarray
    nodes: np.ndarray = field(default_factory=lambda: np.zeros((NODE_ROWS, WAYS), np.float32))
    tree: Tree | None = None
    learned: bool = False
    factors: dict[str, np.ndarray] = field(default_factory=dict)

    def factor(self, name: str) -> np.ndarray:
        """Exponentials of a table, made once: a softmax of sums is a product of these over its sum."""
        if name not in self.factors:
            self.factors[name] = np.exp(self.tree.bias if name == "tree" else getattr(self, name), dtype=np.float32)
        return self.factors[name].reshape(-1, self.factors[name].shape[-1])


def first_weights(counts: Counts) -> Weights:
    """Biases from the counts; no feature says anything yet."""
    of = np.zeros(FREQUENT)
    each = np.array([counts.ends, *counts.word_counts], dtype=np.float64)
    of[: len(each)] = each
    grid = of.reshape(-1, SLOTS)
    classes = np.concatenate([[counts.other_tokens() + 1.0], grid.sum(axis=1)])
    with np.errstate(divide="ignore"):
        slot_bias = np.where(grid > 0, np.log(np.maximum(grid, 1)), -np.inf)
        class_bias = np.where(classes > 0, np.log(np.maximum(classes, 1e-9)), -np.inf)
    slot_bias[~np.isfinite(slot_bias).any(axis=1)] = 0  # classes without words are never asked for
    class_bias -= class_bias.max()
    slot_bias -= slot_bias.max(axis=1, keepdims=True)
    tree = counts.others.tree if counts.others else None
    return Weights(class_bias.astype(np.float32), slot_bias.astype(np.float32), np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, SLOTS), np.float32), tree=tree)


class Room:
    """Arrays that are used again: fresh ones of some MB cost more, page by page, than what is computed in them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def array(self, name: str, rows: int, width: int) -> np.ndarray:
        """``rows`` by ``width`` single-precision numbers, whatever they are; valid until the name is asked for again."""
        size = rows * width
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size + size // 4, np.float32)
        return self.held[name][:size].reshape(rows, width)


def _shares(x: np.ndarray) -> np.ndarray:
    x /= np.einsum("ij->i", x)[:, None]
    return x


def _row_sums(rows: np.ndarray, values: np.ndarray, room: Room, few: int = 16, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct rows and the sums of their values, in parts that share no row; a part is valid until the next is asked for.

    All groups are summed at once, member by member. Larger ones than ``few`` are cut into runs first, whose sums are the next values.
    """
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ranked = rows[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sizes = np.diff(np.append(start, len(rows)))
    small = sizes <= few
    if small.any():
        yield _sums(ranked, order, start[small], sizes[small], values, room, 0)
    if not small.all():
        start, sizes = start[~small], sizes[~small]
        runs = (sizes + few - 1) // few
        nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        first, left = np.repeat(start, runs) + nth * few, np.repeat(sizes, runs) - nth * few
        yield from _row_sums(*_sums(ranked, order, first, np.minimum(left, few), values, room, depth + 1), room, few, depth + 1)


def _sums(ranked: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray, values: np.ndarray, room: Room, depth: int) -> tuple[np.ndarray, np.ndarray]:
    falling = np.argsort(int(sizes.max()) - sizes.astype(np.uint8), kind="stable")  # groups of more than k members come first
    first, sizes = first[falling], sizes[falling]
    sums = np.take(values, order[first], axis=0, out=room.array(f"sums {depth}", len(first), values.shape[1]), mode="clip")
    more = np.bincount(sizes)[::-1].cumsum()[::-1].tolist()
    for member in range(1, len(more) - 1):
        n = more[member + 1]
        sums[:n] += np.take(values, order[first[:n] + member], axis=0, out=room.array("row", n, values.shape[1]), mode="clip")
    return ranked[first], sums


def _count(table: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
    np.add.at(table.reshape(-1), rows * table.shape[1] + columns, table.dtype.type(1))


@dataclass
class Part:
    """Softmaxes of one kind: the names of their weights and biases, each one's row of bias, the rows of its features, and what it hits."""

    name: str
    bias: str
    of: np.ndarray
    rows: list[np.ndarray]
    hit: np.ndarray
    room: Room

    def products(self, w: Weights, start: int, out: np.ndarray) -> np.ndarray:
        """Exponentials of bias plus the weights of all features, of the softmaxes from ``start`` on."""
        part = slice(start, start + len(out))
        row, table, bias = self.room.array("row", *out.shape), w.factor(self.name), w.factor(self.bias)
        np.take(table, self.rows[0][part], axis=0, out=out, mode="clip")
        out *= bias[0] if self.bias == "class_bias" else np.take(bias, self.of[part], axis=0, out=row, mode="clip")
        for rows in self.rows[1:]:
            out *= np.take(table, rows[part], axis=0, out=row, mode="clip")
        return out

    def _pieces(self, w: Weights) -> tuple[int, Iterator[tuple[int, int]]]:
        n, width = len(self.of), w.factor(self.name).shape[1]
        step = max(1, PIECE // width)
        return width, ((k, min(step, n - k)) for k in range(0, n, step))

    def shares(self, w: Weights) -> np.ndarray:
        """Probabilities; valid until the batch's next ones."""
        width, pieces = self._pieces(w)
        x = self.room.array("shares", len(self.of), width)
        for start, n in pieces:
            _shares(self.products(w, start, x[start : start + n]))
        return x

    def log10(self, w: Weights) -> np.ndarray:
        width, pieces = self._pieces(w)
        out = np.empty(len(self.of), np.float32)
        for start, n in pieces:
            x = self.products(w, start, self.room.array("piece", n, width))
            np.divide(x[np.arange(n), self.hit[start : start + n]], np.einsum("ij->i", x), out=out[start : start + n])
        return np.log10(np.maximum(out, np.finfo(np.float32).tiny)).astype(np.float64)


class Batch:
    """Features of a run of tokens, given with the three tokens before it."""

    def __init__(self, ids: np.ndarray, before: np.ndarray, room: Room | None = None):
        one, two, three = before
        self.ids, self.room = ids, room or Room()
        pair = one * 0x100000001B3 + two
        self.class_rows = [_row(one, 1), _row(pair, 2), _row(two, 3), _row(three, 4)]
        self.classes = np.where(ids < FREQUENT, ids // SLOTS + 1, 0)
        self.inner = np.flatnonzero(ids < FREQUENT)
        own = self.classes[self.inner]
        self.slot_rows = [_row(f[self.inner] * CLASSES + own, k) for k, f in ((5, one), (6, pair), (7, two))]
        self.own, self.slots = own, ids[self.inner] % SLOTS
        self.contexts = (8, one), (9, pair), (10, two)

    def _class_part(self) -> Part:
        return Part("classes", "class_bias", np.zeros(len(self.ids), np.int64), self.class_rows, self.classes, self.room)

    def _slot_part(self) -> Part:
        return Part("slots", "slot_bias", self.own - 1, self.slot_rows, self.slots, self.room)

    def _node_part(self, tree: Tree) -> tuple[Part, np.ndarray]:
        """The nodes on the ways to the other words, and the token of each."""
        other = np.flatnonzero(self.ids >= FREQUENT)
        at, node, bias, child = tree.paths(self.ids[other] - FREQUENT)
        token, salt = other[at], node * 0x9E3779B1
        return Part("nodes", "tree", bias, [_row(f[token] + salt, k, NODE_BITS) for k, f in self.contexts], child, self.room), token

    def _parts(self, w: Weights) -> list[Part]:
        return [self._class_part(), self._slot_part(), *([self._node_part(w.tree)[0]] if w.tree else [])]

    def class_probabilities(self, w: Weights) -> np.ndarray:
        return self._class_part().shares(w).copy()

    def log10(self, w: Weights) -> np.ndarray:
        """log10 probability of each token: of its class and, for frequent tokens, slot, for others, way through the tree."""
        out = self._class_part().log10(w)
        out[self.inner] += self._slot_part().log10(w)
        if w.tree:
            part, token = self._node_part(w.tree)
            out += np.bincount(token, part.log10(w), len(out))
        return out

    def add_expected(self, w: Weights, observed: Weights, expected: Weights) -> None:
        """Adds this batch's feature counts, as they are and as the model expects them."""
        for part in self._parts(w):
            p, seen, due = part.shares(w), getattr(observed, part.name), getattr(expected, part.name)
            for r in part.rows:
                for distinct, sums in _row_sums(r, p, self.room) if len(r) else ():
                    sums += np.take(due, distinct, axis=0, out=self.room.array("row", *sums.shape), mode="clip")  # much faster than by index
                    due[distinct] = sums
                _count(seen, r, part.hit)

    def add_observed(self, w: Weights, observed: Weights, of_bias: Weights) -> None:
        """The same while no feature says anything: counts of features by row of bias will do, see :func:`expected_by_bias`."""
        for part in self._parts(w):
            for r in part.rows:
                _count(getattr(observed, part.name), r, part.hit)
                _count(getattr(of_bias, part.name), r, part.of)


def expected_by_bias(w: Weights, of_bias: Weights) -> Weights:
    """Feature counts as the biases alone expect them: so many tokens of a row have these probabilities."""
    none = np.zeros(0)
    return Weights(none, none, *(counts @ _shares(w.factor(bias).copy()) for counts, bias in ((of_bias.classes, "class_bias"), (of_bias.slots, "slot_bias"), (of_bias.nodes, "tree"))))


def batches(texts: list[np.ndarray], most: int = BATCH, room: Room | None = None) -> Iterator[tuple[Batch, np.ndarray]]:
    """The tokens of texts in batches, with the number of the text of each token."""
    ids = np.concatenate(texts)
    sizes = np.array([len(t) for t in texts])
    at = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = np.repeat(np.arange(len(texts)), sizes)
    before = [np.where(at >= k, np.concatenate([np.full(k, _START), ids])[: len(ids)], _START) for k in (1, 2, 3)]
    room = room or Room()
    for start in range(0, len(ids), most):
        part = slice(start, start + most)
        yield Batch(ids[part], np.array([b[part] for b in before]), room), of[part]


def _grouped_texts(rows: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with their unpacked ids, about ``most`` tokens at a time."""
    for batch in rows:
        start, held, n = 0, [], 0
        for i, data in enumerate(batch.column("ids").to_pylist()):
            held.append(W.unpack(data))
            n += len(held[-1])
            if n >= most:
                yield batch.slice(start, i + 1 - start), held
                start, held, n = i + 1, [], 0
        if held:
            yield batch.slice(start), held


def count_words(words: DataFrame) -> DataFrame:
    """Rows of block_words with counts over all rows: (block, hash, codes, words, totals, ranks), ranks by count in the bucket.

    Block -1 sums up the bucket ``hash``: words and totals are its most frequent, codes the words and the tokens of each level of counts.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lists, parts = [W.unpack_words(r["words"]) for r in rows], [W.unpack(r["counts"]) for r in rows]
        total: dict[bytes, int] = {}
        for x, n in zip(lists, parts, strict=True):
            for w, k in zip(x, n.tolist(), strict=True):
                total[w] = total.get(w, 0) + k
        known = sorted(((-n, w) for w, n in total.items() if n))
        top = known[:FREQUENT]
        rank = {w: k for k, (_, w) in enumerate(known)}
        out = [
            {"block": r["block"], "hash": r["hash"], "codes": r["codes"], "words": r["words"], "totals": W.pack(np.array([total[w] for w in x])), "ranks": W.pack(np.array([rank.get(w, 0) for w in x])), "tokens": 0, "distinct": 0}
            for r, x in zip(rows, lists, strict=True)
        ]
        each = np.array([-n for n, _ in known], np.int64)
        levels = np.zeros((2, LEVELS), np.int64)
        np.add.at(levels[0], _level(each), 1)
        np.add.at(levels[1], _level(each), each)
        out.append({"block": -1, "hash": rows[0]["bucket"], "codes": levels.tobytes(), "words": W.zstandard.compress(b"\n".join([w for _, w in top]), 1), "totals": W.pack(each[:FREQUENT]), "ranks": b"", "tokens": -sum(n for n, _ in known), "distinct": len(known)})
        return pa.Table.from_pylist(out, schema=schema)

    schema = pa.schema({"block": pa.int64(), "hash": pa.int64(), "codes": pa.binary(), "words": pa.binary(), "totals": pa.binary(), "ranks": pa.binary(), "tokens": pa.int64(), "distinct": pa.int64()})
    return words.groupBy("bucket").applyInArrow(run, "block long, hash long, codes binary, words binary, totals binary, ranks binary, tokens long, distinct long")


def corpus_counts(counted: DataFrame, ends: int, buckets: int) -> Counts:
    """Totals, the frequent words and the numbers of the others, merged over the buckets a few at a time."""
    tokens = distinct = ends
    distinct = int(ends > 0)
    best: list[tuple[int, bytes]] = []
    levels, level_tokens = np.zeros((buckets, LEVELS), np.int64), np.zeros(LEVELS, np.int64)
    for row in counted.where("block = -1").select("hash", "codes", "words", "totals", "tokens", "distinct").toLocalIterator():
        here = np.frombuffer(row["codes"], np.int64).reshape(2, LEVELS)
        levels[row["hash"]] = here[0]
        level_tokens += here[1]
        tokens, distinct = tokens + row["tokens"], distinct + row["distinct"]
        n = W.unpack(row["totals"])
        if len(n):
            best = sorted(best + [(-k, w) for k, w in zip(n.tolist(), W.unpack_words(row["words"]), strict=True)])[: FREQUENT - 1]
    return Counts(tokens, distinct, [w for _, w in best], [-n for n, _ in best], ends, other_words(levels, level_tokens, best))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Counts]:
    """A staged row per document: doc_id, held_out, n_tokens, n_known, base_score, ids; and the counts."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), C.held_out(id_col, 7, 2).alias("held_out"), (~C.held_out(id_col, 7, 2)).alias("train"), C.text_bytes(text_col).alias("text"))
    buckets = W.buckets_for(own)
    words = W.block_words(own, buckets, lower=True, counted="train")
    counted = stage_table(count_words(words), "lm-words")
    counts = corpus_counts(counted, own.where("train").count(), buckets)
    shared = spark.sparkContext.broadcast(counts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, others = {w: i + 1 for i, w in enumerate(shared.value.words)}, shared.value.others
        for batch in batches:
            numbers = []
            for x, totals, ranks in zip(*(batch.column(n).to_pylist() for n in ("words", "totals", "ranks")), strict=True):
                own, totals, ranks = W.unpack_words(x), W.unpack(totals), W.unpack(ranks)
                bucket = W.zlib.crc32(own[0]) % buckets
                number = FREQUENT + others.numbers(bucket, totals, ranks)
                for i in np.flatnonzero((ranks < others.frequent[bucket]) & (totals > 0)).tolist():
                    number[i] = ids[own[i]]
                numbers.append(W.pack(number))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("hash"), batch.column("codes"), batch.column("totals"), pa.array(numbers, pa.binary())], names=["block", "hash", "codes", "totals", "ids"])

    numbered = counted.where("block >= 0").select("block", "hash", "codes", "words", "totals", "ranks").mapInArrow(number, "block long, hash long, codes binary, totals binary, ids binary")

    def work(texts: pa.Table, rows: list[dict]) -> pa.Table:
        c = shared.value
        none = [np.zeros(0, np.int64)]
        order = np.concatenate([W.unpack(r["codes"]) for r in rows] or none)
        total, ids = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        total[order] = np.concatenate([W.unpack(r["totals"]) for r in rows] or none)
        ids[order] = np.concatenate([W.unpack(r["ids"]) for r in rows] or none)
        base = np.log10((total + 1) / (c.tokens + c.distinct + 1))
        end = np.log10((c.ends + 1) / (c.tokens + c.distinct + 1))
        out = {"n_tokens": [], "n_known": [], "base_score": [], "ids": []}
        for data in texts.column("codes"):
            codes = W.unpack(data.as_py())
            out["n_tokens"].append(len(codes) + 1)
            out["n_known"].append(int((total[codes] > 0).sum()) + (c.ends > 0))
            out["base_score"].append(float(base[codes].sum() + end))
            out["ids"].append(W.pack(np.append(ids[codes], 0)))
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "ids": pa.binary()}
        return pa.table([texts.column("doc_id"), texts.column("held_out"), *(pa.array(out[k], t) for k, t in kinds.items())], names=["doc_id", "held_out", *kinds])

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = W.with_words(W.block_texts(own.drop("train"), lower=True), numbered, work, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, ids binary")
    return stage_table(encoded, "lm-texts"), counts


def _gradient(rows: DataFrame, weights: Weights) -> list:
    """Observed and expected feature counts over all tokens of ``rows``, as parts of the weight rows: of classes and slots, then of nodes."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, none, some = shared.value, np.zeros(0), False
        zero = lambda *widths: Weights(none, none, *(np.zeros((n, k), np.float32) for n, k in zip((ROWS, ROWS, NODE_ROWS), widths, strict=True)))
        seen = zero(CLASSES, SLOTS, WAYS)
        due = zero(CLASSES, SLOTS, WAYS) if w.learned else zero(1, len(w.slot_bias), len(w.tree.bias))
        room = Room()
        for _, texts in _grouped_texts(batches_):
            for batch, _ in batches(texts, room=room):
                (batch.add_expected if w.learned else batch.add_observed)(w, seen, due)
                some = True
        if some:
            due = due if w.learned else expected_by_bias(w, due)
            group = TaskContext.get().partitionId() % TASK_GROUPS
            parts = [t[k : k + PART_ROWS] for t in (np.concatenate([seen.classes, due.classes, seen.slots, due.slots], axis=1), np.concatenate([seen.nodes, due.nodes], axis=1)) for k in range(0, len(t), PART_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(np.full(len(parts), group)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "group", "sums"])

    def add(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part = group = None
        for batch in batches_:
            for data in batch.column("sums").to_pylist():
                sums = np.frombuffer(data, np.float32)
                total = sums.copy() if total is None else np.add(total, sums, out=total)
            part, group = batch.column("part")[0].as_py(), batch.column("group")[0].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([group]), pa.array([total.tobytes()], pa.binary())], names=["part", "group", "sums"])

    schema = "part long, group long, sums binary"
    tasks = rows.select("ids").mapInArrow(run, schema)
    return tasks.groupBy("part", "group").applyInArrow(add, schema).groupBy("part").applyInArrow(add, schema).collect()  # (ROWS + NODE_ROWS) / PART_ROWS rows


def train(encoded: DataFrame, counts: Counts, updates: int = UPDATES) -> Weights:
    """One pass over the training rows, a part of them in each update."""
    weights = first_weights(counts)
    rows = encoded.where("not held_out")
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // max(updates, 1))  # each sends whole tables
    for k in range(updates):
        part = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(updates)) == k).coalesce(tasks)
        for row in _gradient(part, weights):
            first = row["part"] * PART_ROWS
            sums = np.frombuffer(row["sums"], np.float32).reshape(PART_ROWS, -1)
            a, b, c = CLASSES, 2 * CLASSES, 2 * CLASSES + SLOTS
            if first < ROWS:
                tables = ((weights.classes, first, sums[:, :a], sums[:, a:b]), (weights.slots, first, sums[:, b:c], sums[:, c:]))
            else:
                tables = ((weights.nodes, first - ROWS, sums[:, :WAYS], sums[:, WAYS:]),)
            for table, start, seen, due in tables:
                of = table[start : start + PART_ROWS]
                of += STEP * np.log1p((seen - due) / (due + SMOOTH))  # the gradient in units of the expected counts
                of -= of.max(axis=1, keepdims=True)  # a softmax stays the same
                np.maximum(of, LEAST, out=of)
        weights.learned = True
    return weights


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", updates: int = UPDATES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10 probabilities)."""
    encoded, counts = encode(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(train(encoded, counts, updates))
    kind = docs.schema[id_col].dataType.simpleString()
    learned = counts.tokens > 0

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = Room()
        for batch, texts in _grouped_texts(rows):
            score = np.zeros(len(texts))
            for part, of in batches(texts, SCORE_BATCH, room) if learned else ():
                score += np.bincount(of, part.log10(shared.value), len(texts))
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(score)], names=[*names, "score"])

    scored = encoded.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(counts.tokens).cast("long").alias("train_tokens"), "base_score", "score")
