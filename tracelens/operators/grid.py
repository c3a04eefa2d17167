"""Every model of a grid at once: statistics that add up over folds, trees a level and SVMs a step at a time.

A grid has a model for each feature, classifier, normaliser and fold, each
learned from the rows outside its fold. Fitting them one after the other costs
a handful of jobs a model; here all of them advance together over one staged
table of sparse vectors, packed in blocks:

- *Scaling*: sums of each (feature, dimension, fold). A fold's training sums are
  the total less its own. A scaled tree splits where the raw one does, as
  scaling keeps the order of values and moves thresholds along, so both
  normalisers share their trees.
- *Split candidates* of each (feature, fold, dimension) as Spark ML finds them:
  midpoints of neighbouring values, or quantiles where there are more values
  than bins; from all rows of a feature, or from some 10,000 by hash if it has more.
- *Trees*: a level is one aggregate of label counts over (feature, model, node,
  dimension, bin), from which the best split of every open node is taken.
  Decision trees equal Spark ML's, pruning included. A forest's trees draw rows
  with Poisson weights and dimensions for each node, both by seeded hashes.
- *SVMs*: a step is one pass that adds up hinge-loss gradients of all models;
  tasks pre-add theirs, and a second stage adds those up where tasks are many.
  Features small enough for one task take all their steps in it.

To the driver come split candidates, best splits, gradient sums and weights:
their size follows from the number of models, nodes and dimensions, not of
rows. Jobs: some two a level and one a step, whatever the number of models.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

#: Rows of a block, and partial sums that the driver adds up itself.
BLOCK_ROWS, DRIVER_SUMS = 2048, 32
#: A feature of no more rows takes all its gradient steps in one task.
TASK_ROWS = 16_384
#: Rows of a feature, about, that split candidates are looked for in (a fixed value of Spark ML).
SPLIT_ROWS = 10_000
#: Nodes with an impurity below this are pure.
EPSILON = 2.0**-52


@dataclass(frozen=True)
class Settings:
    """What the learners do; the defaults are the reference's."""

    k: int = 10
    seed: int = 0
    max_depth: int = 5
    max_bins: int = 32
    trees: int = 6
    iterations: int = 100
    step: float = 1.0
    reg: float = 0.01
    tol: float = 1e-3
    batch_fraction: float = 1.0


# --- blocks -------------------------------------------------------------------

_BLOCK = "feature string, n int, dims int, label binary, fold binary, key binary, row binary, index binary, value binary"


@dataclass
class Block:
    """Rows of one feature: labels, folds, hashes, and the values other than zero as (row, dimension, value)."""

    feature: str
    dims: int
    label: np.ndarray
    fold: np.ndarray
    key: np.ndarray
    row: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self.label), self.dims))
        out[self.row, self.index] = self.value
        return out


def vector_blocks(rows: DataFrame) -> DataFrame:
    """Staged blocks of rows (feature, sample, fold, label 0/1, feature_data). A feature's vectors are equally long."""
    spark = rows.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = F.when(F.col("label").cast("double").isin(0.0, 1.0), F.col("label").cast("double")).otherwise(F.raise_error(F.lit("labels are 0 or 1")).cast("double"))
    own = rows.select(F.coalesce(F.col("feature"), F.lit("")).alias("feature"), F.xxhash64("sample").alias("key"), F.col("fold").cast("int").alias("fold"), label.alias("label"), F.col("feature_data").cast("array<double>").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n, now, dims = 0, None, 0

        def packed() -> pa.RecordBatch:
            starts = np.cumsum([0, *(len(h[0]) for h in held)])
            label, fold, key, row, index, value = (np.concatenate(c) for c in zip(*((*h[:3], h[3] + start, *h[4:]) for h, start in zip(held, starts)), strict=True))
            parts = [label, fold, key, row.astype(np.int32), index, value]
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([n], pa.int32()), pa.array([dims], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            label, fold, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "key"))
            if batch.column("fold").null_count:
                raise ValueError("a row without fold")
            names = batch.column("feature").dictionary_encode()
            runs = np.flatnonzero(np.diff(names.indices.to_numpy())) + 1
            for a, z in zip([0, *runs.tolist()], [*runs.tolist(), batch.num_rows], strict=True):
                feature = names[a].as_py()
                while a < z:
                    if held and (feature != now or n == BLOCK_ROWS):
                        yield packed()
                        held, n = [], 0
                    b = min(z, a + BLOCK_ROWS - n)
                    data = batch.column("data").slice(a, b - a)
                    lengths = pc.unique(pc.fill_null(pc.list_value_length(data), 0)).to_pylist()
                    if len(lengths) > 1 or (held and lengths[0] != dims):
                        raise ValueError(f"vectors of feature {feature!r} differ in length")
                    now, dims = feature, lengths[0]
                    whole = data.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(b - a, dims)
                    row, index = np.nonzero(whole)
                    held.append((label[a:b].astype(np.float64), fold[a:b].astype(np.int32), key[a:b].astype(np.int64), row, index.astype(np.int32), whole[row, index]))
                    n, a = n + b - a, b
        if held:
            yield packed()

    dealt = own.repartition("feature", F.pmod("key", F.lit(spread))).sortWithinPartitions("feature")
    return stage_table(dealt.mapInArrow(run, _BLOCK), "grid-blocks")


_KINDS = (("label", np.float64), ("fold", np.int32), ("key", np.int64), ("row", np.int32), ("index", np.int32), ("value", np.float64))


def _block(row: dict) -> Block:
    return Block(row["feature"], row["dims"], **{c: np.frombuffer(row[c], t) for c, t in _KINDS})


def _each(blocks: DataFrame, work: Callable[[Iterator[Block]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(_block(r) for batch in batches for r in batch.to_pylist())

    return blocks.mapInArrow(run, schema)


def _spread(blocks: DataFrame, features: int) -> int:
    """Partitions that deal features out: a number of its own, so that small features don't meet in one task."""
    return min(max(1, 2 * features), max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks.sparkSession.sparkContext.defaultParallelism))


# --- what folds add up to -----------------------------------------------------


@dataclass
class Facts:
    """Of one feature: dimensions, rows by fold, and 1 / standard deviation by (fold, dimension) of the rows outside the fold."""

    dims: int
    rows: np.ndarray
    inverse: np.ndarray | None = None
    #: By fold: dimensions with split candidates, and these, padded with infinity.
    split_dims: list[np.ndarray] = field(default_factory=list)
    splits: list[np.ndarray] = field(default_factory=list)

    @property
    def train(self) -> np.ndarray:
        return self.rows.sum() - self.rows

    @property
    def usable(self) -> np.ndarray:
        return (self.rows > 0) & (self.train > 0)


def _found(rows: DataFrame) -> Iterator[dict]:
    """Rows on the driver, from all partitions at once (``toLocalIterator`` runs one task after the other)."""
    for batch in rows.toArrow().to_batches():
        yield from batch.to_pylist()


def fold_facts(blocks: DataFrame, k: int, scaled: bool) -> dict[str, Facts]:

    def sizes(given: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        for b in given:
            n = np.bincount(b.fold, minlength=k)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"feature": [b.feature] * len(at), "dims": [b.dims] * len(at), "fold": at.tolist(), "n": n[at].tolist()})

    found: dict[str, Facts] = {}
    counted = _each(blocks, sizes, "feature string, dims long, fold long, n long").groupBy("feature", "dims", "fold").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        f = found.setdefault(r["feature"], Facts(r["dims"], np.zeros(k, np.int64)))
        if f.dims != r["dims"]:
            raise ValueError(f"vectors of feature {r['feature']!r} differ in length")
        f.rows[r["fold"]] = r["n"]
    if not scaled:
        return found

    def moments(center: dict[str, np.ndarray] | None):
        """Sums of (x - center) and of its square over the values other than zero, by (feature, fold, dimension)."""
        shared = blocks.sparkSession.sparkContext.broadcast(center)

        def run(given: Iterator[Block]) -> Iterator[pa.RecordBatch]:
            for b in given:
                key = b.fold[b.row].astype(np.int64) * b.dims + b.index
                x = b.value - shared.value[b.feature][b.index] if shared.value else b.value
                keys, at = np.unique(key, return_inverse=True)
                n, s, q = (np.bincount(at, weights=w, minlength=len(keys)) for w in (np.ones(len(x)), x, x * x))
                if len(keys):
                    yield pa.RecordBatch.from_pydict({"feature": [b.feature] * len(keys), "fold": keys // b.dims, "dim": keys % b.dims, "n": n, "s": s, "q": q})

        sums = _each(blocks, run, "feature string, fold long, dim long, n double, s double, q double").groupBy("feature", "fold", "dim")
        out = {f: np.zeros((3, k, facts.dims)) for f, facts in found.items()}
        for r in _found(sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))):
            out[r["feature"]][:, r["fold"], r["dim"]] = r["n"], r["s"], r["q"]
        shared.unpersist()
        return out

    center = {f: m[1].sum(axis=0) / max(1, found[f].rows.sum()) for f, m in moments(None).items()}
    for f, (n, s, q) in moments(center).items():
        facts, c = found[f], center[f]
        zeros = facts.rows[:, None] - n
        s, q = s - zeros * c, q + zeros * c * c
        train = np.maximum(facts.train, 1)[:, None].astype(float)
        s, q = s.sum(axis=0) - s, q.sum(axis=0) - q
        variance = np.maximum(q - s * s / train, 0.0) / np.maximum(train - 1, 1)
        variance[variance <= 1e-30 * (1 + c * c)] = 0.0  # what rounding leaves of a constant
        facts.inverse = np.divide(1.0, np.sqrt(variance), out=np.zeros_like(variance), where=variance > 0)
    return found


# --- trees --------------------------------------------------------------------


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """A seeded hash of 64-bit hashes (the finaliser of splitmix64), as numbers from 0 to 1."""
    z = key.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) / 2.0**64


#: Cumulative probabilities of a Poisson draw with mean 1.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 20.0)])))


def _candidates(values: np.ndarray, counts: np.ndarray, splits: int) -> np.ndarray:
    """Thresholds between sorted distinct values: all midpoints, or the midpoints nearest to equal shares of the rows."""
    if len(values) <= 1:
        return np.zeros(0)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(values) - 1 <= splits:
        return middle
    stride = counts.sum() / (splits + 1.0)
    target, running, out = stride, np.cumsum(counts), []
    for i in range(1, len(values)):
        if abs(running[i - 1] - target) < abs(running[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def add_split_candidates(blocks: DataFrame, facts: dict[str, Facts], s: Settings) -> None:
    most = max(s.max_bins**2, SPLIT_ROWS)
    shared = blocks.sparkSession.sparkContext.broadcast({f: (min(1.0, most / max(1, x.rows.sum())), x.train.tolist()) for f, x in facts.items()})

    def some(given: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        for b in given:
            keep = np.flatnonzero(_mixed(b.key, s.seed + 1) < shared.value[b.feature][0])
            for start in range(0, len(keep), 256):
                part = keep[start : start + 256]
                data = b.dense()[part]
                yield pa.RecordBatch.from_pydict({"feature": [b.feature] * len(part), "fold": b.fold[part].astype(np.int64), "data": [x.tobytes() for x in data]})

    def find(key: tuple, table: pa.Table) -> pa.Table:
        """Candidates of one feature; its rows here are bounded by what ``some`` keeps."""
        feature = key[0].as_py()
        whole = np.stack([np.frombuffer(x.as_py(), np.float64) for x in table.column("data")])
        fold = table.column("fold").to_numpy()
        rows: list[dict] = []
        for dim in np.flatnonzero((whole != whole[0]).any(axis=0)):
            values, at = np.unique(whole[:, dim], return_inverse=True)
            counts = np.zeros((s.k, len(values)))
            np.add.at(counts, (fold, at), 1.0)
            for k, left in enumerate(counts.sum(axis=0) - counts):
                found = _candidates(values[left > 0], left[left > 0], min(s.max_bins, int(shared.value[feature][1][k])) - 1)
                if len(found):
                    rows.append({"feature": feature, "fold": k, "dim": int(dim), "splits": found.tolist()})
        return pa.Table.from_pylist(rows, schema=pa.schema([("feature", pa.string()), ("fold", pa.int64()), ("dim", pa.int64()), ("splits", pa.list_(pa.float64()))]))

    kept = _each(blocks, some, "feature string, fold long, data binary")
    held: dict[tuple[str, int], list] = {}
    for r in _found(kept.repartition(_spread(blocks, len(facts)), "feature").groupBy("feature").applyInArrow(find, "feature string, fold long, dim long, splits array<double>")):
        held.setdefault((r["feature"], r["fold"]), []).append((r["dim"], r["splits"]))
    for f, x in facts.items():
        for k in range(s.k):
            mine = sorted(held.get((f, k), []))
            padded = np.full((len(mine), s.max_bins - 1), np.inf)
            for at, (_, splits) in enumerate(mine):
                padded[at, : len(splits)] = splits
            x.split_dims.append(np.array([d for d, _ in mine], dtype=np.int64))
            x.splits.append(padded)
    shared.unpersist()


@dataclass
class Forest:
    """All trees of a feature: (model, node) arrays, the root is node 1 and the children of i are 2i and 2i + 1."""

    dim: np.ndarray
    threshold: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls, models: int, depth: int) -> Forest:
        nodes = 1 << (depth + 1)
        return cls(np.full((models, nodes), -1, np.int64), np.zeros((models, nodes)), np.zeros((models, nodes, 2)))

    def place(self, x: np.ndarray, depth: int) -> np.ndarray:
        """(row, model) -> the node that the row comes to."""
        node = np.ones((len(x), len(self.dim)), np.int64)
        models, rows = np.arange(len(self.dim))[None, :], np.arange(len(x))[:, None]
        for _ in range(depth):
            dim = self.dim[models, node]
            right = x[rows, np.maximum(dim, 0)] > self.threshold[models, node]
            node = np.where(dim >= 0, 2 * node + right, node)
        return node

    def prune(self) -> None:
        """A node whose children are leaves with one prediction is a leaf."""
        for node in range(self.dim.shape[1] // 2 - 1, 0, -1):
            a, b = 2 * node, 2 * node + 1
            says = self.counts[:, :, 1] > self.counts[:, :, 0]
            same = (self.dim[:, node] >= 0) & (self.dim[:, a] < 0) & (self.dim[:, b] < 0) & (says[:, a] == says[:, b])
            self.dim[same, node] = -1


class TreeKinds:
    """The trees of each fold: one over all rows and dimensions for ``dt``, ``trees`` drawn ones for ``rf``."""

    def __init__(self, classifiers: Sequence[str], s: Settings):
        self.s, self.each = s, [t for t in (-1, *range(s.trees)) if ("dt" if t < 0 else "rf") in classifiers]
        #: (fold, tree) of each model
        self.models = [(k, t) for k in range(s.k) for t in self.each]

    def weights(self, b: Block) -> np.ndarray:
        """(row, model) -> how often the row counts in the model's training."""
        drawn = {t: np.ones(len(b.key)) if t < 0 else np.searchsorted(_POISSON, _mixed(b.key, 1000 * self.s.seed + t + 7)).astype(float) for t in self.each}
        return np.stack([np.where(b.fold == k, 0.0, drawn[t]) for k, t in self.models], axis=1)

    def drawn_dims(self, model: int, node: int, dims: int) -> np.ndarray | None:
        """Which dimensions a forest's node may split at: the square root of their number."""
        k, t = self.models[model]
        if t < 0:
            return None
        out = np.zeros(dims, bool)
        out[np.random.default_rng([self.s.seed, k, t, node]).choice(dims, int(np.ceil(np.sqrt(dims))), replace=False)] = True
        return out


def _impurity(zero, one):
    n = zero + one
    return F.lit(1.0) - (zero / n) * (zero / n) - (one / n) * (one / n)


def _node_counts(blocks: DataFrame, facts, forests, open_, kinds: TreeKinds, depth: int) -> DataFrame:
    """Weighted label counts by (feature, model, node, dim, bin) of the open nodes. Zeros are not counted: ``zero`` marks
    the bin that they fall into, and the row with dim -1 has the node's totals."""
    schema = "feature string, model int, node int, dim int, bin int, zero int, n0 double, n1 double"
    arrow = pa.schema([("feature", pa.string()), *((c, pa.int32()) for c in ("model", "node", "dim", "bin", "zero")), ("n0", pa.float64()), ("n1", pa.float64())])
    shared = blocks.sparkSession.sparkContext.broadcast((facts, forests, open_))

    def run(given: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        all_facts, all_forests, all_open = shared.value
        for b in given:
            mine = all_open.get(b.feature)
            if not mine:
                continue
            f = all_facts[b.feature]
            node, weight, label = all_forests[b.feature].place(b.dense(), depth), kinds.weights(b), b.label.astype(np.int64)
            by_dim = np.argsort(b.index, kind="stable")
            dims, first = np.unique(b.index[by_dim], return_index=True)
            same_dim = list(zip(dims.tolist(), np.split(by_dim, first[1:]))) if len(dims) else []
            bins, zero, known = {}, {}, {}
            for k in {kinds.models[m][0] for m in mine}:
                at = np.full(b.dims, -1)
                at[f.split_dims[k]] = np.arange(len(f.split_dims[k]))
                known[k] = at[b.index] >= 0
                bins[k] = np.zeros(len(b.index), np.int64)
                for dim, places in same_dim:
                    if at[dim] >= 0:
                        bins[k][places] = np.searchsorted(f.splits[k][at[dim]], b.value[places])
                bins[k][np.isnan(b.value)] = 0  # no threshold is below it
                zero[k] = (at, (f.splits[k] < 0.0).sum(axis=1))
            for model, nodes in mine.items():
                k = kinds.models[model][0]
                w, own = weight[:, model], np.full(2 << depth, -1)
                own[nodes] = np.arange(len(nodes))
                place = np.where(w > 0, own[np.minimum(node[:, model], len(own) - 1)], -1)
                here = place >= 0
                if not here.any():
                    continue
                total = np.bincount(place[here] * 2 + label[here], weights=w[here], minlength=2 * len(nodes)).reshape(-1, 2)
                filled = np.unique(place[here])
                v, none = np.array(nodes), np.zeros(len(filled), np.int64)
                rows: list[tuple] = [(v[filled], none - 1, none, none, total[filled, 0], total[filled, 1])]
                use = here[b.row] & known[k]
                if kinds.models[model][1] >= 0:
                    drawn = np.stack([kinds.drawn_dims(model, x, b.dims) for x in nodes])
                    use &= drawn[place[b.row], b.index]
                if use.any():
                    key = (place[b.row[use]] * b.dims + b.index[use]) * kinds.s.max_bins + bins[k][use]
                    keys, at = np.unique(key, return_inverse=True)
                    side, ww = label[b.row[use]], w[b.row[use]]
                    n1 = np.bincount(at, weights=ww * side, minlength=len(keys))
                    n0 = np.bincount(at, weights=ww * (1 - side), minlength=len(keys))
                    cells = np.unique(keys // kinds.s.max_bins)
                    split, zero_bin = zero[k]
                    none = np.zeros(len(cells))
                    rows.append((v[keys // kinds.s.max_bins // b.dims], keys // kinds.s.max_bins % b.dims, keys % kinds.s.max_bins, np.zeros(len(keys), np.int64), n0, n1))
                    rows.append((v[cells // b.dims], cells % b.dims, zero_bin[split[cells % b.dims]], np.ones(len(cells), np.int64), none, none))
                cols = [np.concatenate(c) for c in zip(*rows)]
                n = len(cols[0])
                yield pa.RecordBatch.from_arrays([pa.array([b.feature] * n), pa.array(np.full(n, model, np.int32)), *(pa.array(c.astype(np.int32)) for c in cols[:4]), *(pa.array(c.astype(np.float64)) for c in cols[4:])], schema=arrow)

    cell = ["feature", "model", "node", "dim", "bin"]
    return _each(blocks, run, schema).groupBy(*cell).agg(F.max("zero").alias("zero"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def best_splits(counts: DataFrame) -> DataFrame:
    """The totals (t0, t1) of each (feature, model, node) and its best split: gain, dim, bin, and the counts left of it.

    Of equal gains the least dimension, then the least bin wins. A node that can't be split has a null gain.
    """
    node = ["feature", "model", "node"]
    # Read twice: staged, so that the pass over the blocks runs once.
    held = stage_table(counts, "grid-counts")
    totals = held.where("dim = -1").select(*node, F.col("n0").alias("t0"), F.col("n1").alias("t1"))
    dim = Window.partitionBy(*node, "dim")
    entries = held.where("dim >= 0").join(totals, node)
    with_zeros = entries.select(
        *node, "dim", "bin", "t0", "t1",
        *((F.col(f"n{c}") + F.col("zero") * (F.col(f"t{c}") - F.sum(f"n{c}").over(dim))).alias(f"n{c}") for c in (0, 1)),
    )
    upto = dim.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sided = with_zeros.select(*node, "dim", "bin", "t0", "t1", F.sum("n0").over(upto).alias("l0"), F.sum("n1").over(upto).alias("l1"))
    left, right = F.col("l0") + F.col("l1"), F.col("t0") + F.col("t1") - F.col("l0") - F.col("l1")
    both = sided.where((left > 0) & (right > 0))
    all_ = F.col("t0") + F.col("t1")
    gain = _impurity(F.col("t0"), F.col("t1")) - (left / all_) * _impurity(F.col("l0"), F.col("l1")) - (right / all_) * _impurity(F.col("t0") - F.col("l0"), F.col("t1") - F.col("l1"))
    best = both.groupBy(*node).agg(F.max(F.struct(gain.alias("gain"), (-F.col("dim")).alias("dim"), (-F.col("bin")).alias("bin"), "l0", "l1")).alias("best"))
    return totals.join(best, node, "left").select(*node, "t0", "t1", "best.gain", (-F.col("best.dim")).alias("dim"), (-F.col("best.bin")).alias("bin"), "best.l0", "best.l1")


def grow_trees(blocks: DataFrame, facts: dict[str, Facts], classifiers: Sequence[str], s: Settings) -> tuple[TreeKinds, dict[str, Forest]]:
    kinds = TreeKinds(classifiers, s)
    add_split_candidates(blocks, facts, s)
    forests = {f: Forest.empty(len(kinds.models), s.max_depth) for f in facts}
    open_ = {f: {m: [1] for m, (k, _) in enumerate(kinds.models) if x.usable[k]} for f, x in facts.items()}
    for depth in range(s.max_depth):
        following: dict[str, dict[int, list[int]]] = {}
        for r in _found(best_splits(_node_counts(blocks, facts, forests, open_, kinds, depth))):
            forest, model, node = forests[r["feature"]], r["model"], r["node"]
            total = np.array([r["t0"], r["t1"]])
            forest.counts[model, node] = total
            if r["gain"] is None or r["gain"] <= 0:
                continue
            x, k = facts[r["feature"]], kinds.models[model][0]
            at = int(np.searchsorted(x.split_dims[k], r["dim"]))
            forest.dim[model, node], forest.threshold[model, node] = r["dim"], x.splits[k][at, r["bin"]]
            left = np.array([r["l0"], r["l1"]])
            for child, counts in ((2 * node, left), (2 * node + 1, total - left)):
                forest.counts[model, child] = counts
                share = counts / counts.sum()
                if depth + 1 < s.max_depth and 1.0 - (share**2).sum() > EPSILON:
                    following.setdefault(r["feature"], {}).setdefault(model, []).append(child)
        open_ = following
        if not open_:
            break
    for forest in forests.values():
        forest.prune()
    return kinds, forests


# --- SVMs ---------------------------------------------------------------------


@dataclass
class Descent:
    """The SVMs of one feature on their way: a weight vector for each (normaliser, fold left out)."""

    folds: np.ndarray
    #: Factors of the dimensions that a model sees, and how many rows it learns from, on average, in a step.
    scale: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    #: Models that still move.
    live: np.ndarray

    @classmethod
    def start(cls, x: Facts, models: Sequence[tuple[str | None, int]], s: Settings) -> Descent:
        scale = np.stack([np.ones(x.dims) if n is None or k < 0 else x.inverse[k] for n, k in models])
        rows = np.array([float(x.rows.sum() if k < 0 else x.train[k]) for _, k in models]) * s.batch_fraction
        live = np.array([k < 0 or bool(x.usable[k]) for _, k in models])  # without rows to learn from, weights stay zero
        return cls(np.array([k for _, k in models]), scale, rows, np.zeros(scale.shape), live)

    def open_models(self) -> tuple[np.ndarray, np.ndarray]:
        """Folds and weights, as they apply to vectors that are not scaled, of the models that still move."""
        return self.folds[self.live], (self.weights * self.scale)[self.live]

    def advance(self, i: int, gradient: np.ndarray, s: Settings) -> None:
        """Step ``i`` of the models that still move, by their sums of gradients."""
        rate, which = s.step / np.sqrt(i), np.flatnonzero(self.live)
        old = self.weights[which]
        new = old * (1.0 - rate * s.reg) - rate * (gradient * self.scale[which] / self.rows[which][:, None])
        self.weights[which] = new
        moved = np.sqrt(((new - old) ** 2).sum(axis=1))
        if i > 1:  # the first step has nothing to be held against
            self.live[which[moved < s.tol * np.maximum(np.sqrt((new**2).sum(axis=1)), 1.0)]] = False


def gradients(b: Block, i: int, folds: np.ndarray, weights: np.ndarray, s: Settings) -> np.ndarray:
    """Sums over the block's rows of the hinge loss's gradients, by (model, dimension)."""
    sign = 2.0 * b.label - 1.0
    starts = np.searchsorted(b.row, np.arange(len(sign)))
    margin = np.zeros((len(sign), len(weights)))
    some = np.append(starts[1:], len(b.row)) > starts
    if some.any():
        margin[some] = np.add.reduceat(weights.T[b.index] * b.value[:, None], starts[some], axis=0)
    learns = (b.fold[:, None] != folds[None, :]) & (sign[:, None] * margin < 1.0)
    if s.batch_fraction < 1.0:
        learns &= (_mixed(b.key, s.seed + 31 * i) < s.batch_fraction)[:, None]
    coefficient = np.where(learns, -sign[:, None], 0.0)
    out = np.zeros(weights.shape)
    order = np.argsort(b.index, kind="stable")
    if len(order):
        dims, first = np.unique(b.index[order], return_index=True)
        out[:, dims] = np.add.reduceat(coefficient[b.row[order]] * b.value[order][:, None], first, axis=0).T
    return out


_SUMS = pa.schema([("feature", pa.string()), ("part", pa.int64()), ("grad", pa.binary())])


def _add_up(sums: DataFrame, tasks: int) -> DataFrame:
    """Sums (feature, part, grad) of few tasks as they are; of many, added up in Spark first, in stages of DRIVER_SUMS."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("grad"):
                one = np.frombuffer(data.as_py(), np.float64)
                total = one.copy() if total is None else total + one
        yield pa.RecordBatch.from_pydict({"feature": [key[0].as_py()], "part": [key[1].as_py()], "grad": [total.tobytes()]}, schema=_SUMS)

    while tasks > DRIVER_SUMS:
        sums = sums.groupBy("feature", F.expr(f"part div {DRIVER_SUMS}").alias("part")).applyInArrow(add, "feature string, part long, grad binary")
        tasks = -(-tasks // DRIVER_SUMS)
    return sums


def _descend_in_tasks(blocks: DataFrame, given: dict[str, Descent], s: Settings) -> None:
    """All steps of small features, each in the task that holds its blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(given)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        feature = key[0].as_py()
        own, held = shared.value[feature], [_block(r) for r in table.to_pylist()]
        for i in range(1, s.iterations + 1):
            if not own.live.any():
                break
            folds, weights = own.open_models()
            own.advance(i, sum(gradients(b, i, folds, weights, s) for b in held), s)
        return pa.table({"feature": [feature], "part": [0], "grad": [own.weights.tobytes()]}, schema=_SUMS)

    mine = blocks.where(F.col("feature").isin(list(given)))
    for r in _found(mine.repartition(_spread(blocks, len(given)), "feature").groupBy("feature").applyInArrow(run, "feature string, part long, grad binary")):
        own = given[r["feature"]]
        own.weights = np.frombuffer(r["grad"], np.float64).reshape(own.weights.shape)
    shared.unpersist()


def _step(blocks: DataFrame, tasks: int, i: int, given: dict[str, Descent], s: Settings) -> None:
    """One step of large features: every task adds up the gradients of its blocks."""
    models = {f: d.open_models() for f, d in given.items()}
    shared = blocks.sparkSession.sparkContext.broadcast(models)

    def run(some: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums: dict[str, np.ndarray] = {}
        for b in some:
            if b.feature in shared.value:
                found = gradients(b, i, *shared.value[b.feature], s)
                sums[b.feature] = sums[b.feature] + found if b.feature in sums else found
        part = TaskContext.get().partitionId()
        for f, total in sums.items():
            yield pa.RecordBatch.from_pydict({"feature": [f], "part": [part], "grad": [total.tobytes()]}, schema=_SUMS)

    total = {f: np.zeros(w.shape) for f, (_, w) in models.items()}
    for r in _add_up(_each(blocks, run, "feature string, part long, grad binary"), tasks).collect():
        total[r["feature"]] += np.frombuffer(r["grad"], np.float64).reshape(total[r["feature"]].shape)
    shared.unpersist()
    for f, gradient in total.items():
        given[f].advance(i, gradient, s)


def descend(blocks: DataFrame, facts: dict[str, Facts], normalizers: Sequence[str | None], s: Settings, folds: Sequence[int] | None = None) -> dict[str, np.ndarray]:
    """Weights (normaliser, fold, dimension) of each feature's SVMs, for vectors as they are (not scaled).

    The steps of plain gradient descent on hinge loss: no intercept, step /
    sqrt(i), weights shrunk by the L2 term first, until a step moves the
    weights by less than ``tol`` of their length. ``folds`` are those left
    out, one model each (-1: none). A batch of less than all rows is drawn by
    a seeded hash of row and step. A feature of up to TASK_ROWS rows takes all
    its steps in one task; of a larger one, every step is a pass over all tasks.
    """
    folds = list(range(s.k)) if folds is None else list(folds)
    models = [(n, k) for n in normalizers for k in folds]
    all_ = {f: Descent.start(x, models, s) for f, x in facts.items()}
    small = {f: d for f, d in all_.items() if facts[f].rows.sum() <= TASK_ROWS}
    large = {f: d for f, d in all_.items() if f not in small}
    if small:
        _descend_in_tasks(blocks, small, s)
    tasks = blocks.rdd.getNumPartitions() if large else 0
    for i in range(1, s.iterations + 1):
        moving = {f: d for f, d in large.items() if d.live.any()}
        if not moving:
            break
        _step(blocks, tasks, i, moving, s)
    return {f: (d.weights * d.scale).reshape(len(normalizers), len(folds), -1) for f, d in all_.items()}


# --- the grid -----------------------------------------------------------------


def grid_predictions(rows: DataFrame, classifiers: Sequence[str], normalizers: Sequence[str | None], settings: Settings) -> DataFrame:
    """(feature, classifier, normaliser, fold, label, prediction, score): every row by the models of the other folds.

    ``rows``: (feature, sample, fold, label, feature_data). The score is the
    probability of label 1, or an SVM's margin. A fold without rows, or with
    all rows of its feature, has no predictions.
    """
    for c in classifiers:
        if c not in ("svm", "dt", "rf"):
            raise ValueError(f"unknown classifier {c!r}")
    blocks = vector_blocks(rows)
    svm, trees = "svm" in classifiers, "dt" in classifiers or "rf" in classifiers
    facts = fold_facts(blocks, settings.k, svm and "std" in normalizers)
    kinds, forests = grow_trees(blocks, facts, classifiers, settings) if trees else (TreeKinds((), settings), {})
    weights = descend(blocks, facts, normalizers, settings) if svm else {}
    usable = {f: x.usable for f, x in facts.items()}
    shared = blocks.sparkSession.sparkContext.broadcast((forests, weights, usable))
    depth = settings.max_depth
    schema = "feature string, classifier string, normaliser string, fold int, label double, prediction double, score double"
    arrow = pa.schema([("feature", pa.string()), ("classifier", pa.string()), ("normaliser", pa.string()), ("fold", pa.int32()), ("label", pa.float64()), ("prediction", pa.float64()), ("score", pa.float64())])

    def run(given: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        all_forests, all_weights, all_usable = shared.value
        for b in given:
            keep = np.flatnonzero(all_usable[b.feature][b.fold])
            if not len(keep):
                continue
            x, fold, label = b.dense()[keep], b.fold[keep], b.label[keep]
            found: list[tuple[str, str | None, np.ndarray, np.ndarray]] = []
            if trees:
                forest = all_forests[b.feature]
                node = forest.place(x, depth)
                counts = forest.counts[np.arange(node.shape[1])[None, :], node]
                share = counts[:, :, 1] / np.maximum(counts.sum(axis=2), 1e-300)
                by_fold = share.reshape(len(x), settings.k, len(kinds.each))[np.arange(len(x)), fold]
                for c, own in (("dt", [i for i, t in enumerate(kinds.each) if t < 0]), ("rf", [i for i, t in enumerate(kinds.each) if t >= 0])):
                    if own:
                        score = by_fold[:, own].mean(axis=1)
                        found += [(c, n, (score > 0.5).astype(float), score) for n in normalizers]
            if svm:
                for i, n in enumerate(normalizers):
                    score = (x * all_weights[b.feature][i][fold]).sum(axis=1)
                    found.append(("svm", n, (score > 0.0).astype(float), score))
            for c, n, prediction, score in found:
                size = len(fold)
                yield pa.RecordBatch.from_arrays([pa.array([b.feature] * size), pa.array([c] * size), pa.array([n] * size, pa.string()), pa.array(fold), pa.array(label), pa.array(prediction), pa.array(score)], schema=arrow)

    return _each(blocks, run, schema)
