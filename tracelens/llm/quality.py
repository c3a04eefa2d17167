"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

1. Every text gives two streams of tokens: its words (A-Z lower-cased, split
   at what is neither letter nor digit) and the shapes of its white-space
   separated words (runs of capitals, other letters, digits and each further
   byte, as ``A!`` for ``IT!!``). Tokens fall on a fixed number of hashed rows.
2. Random indexing over all documents: each row has a sparse ternary index
   vector, and a row's word vector is the sum of the index vectors of its
   tokens' left and right neighbours in the stream. Tasks add up their own
   sums; a grouped sum merges them. The table has ``ROWS`` rows, whatever the
   corpus holds, and is broadcast.
3. A text's features are, of either stream, the mean unit word vector, the
   logarithm of its length, and the share of tokens that repeat the one before.
4. The network (one tanh layer, one logistic output) learns from at most
   ``sample_rows`` labelled rows, those with the smallest hash of their id,
   which is a bound on the labelled sample alone. A fifth of them is set
   aside to choose the epoch and the temperature.
5. Scoring is one pass without a shuffle, whole texts in blocks.

Rows whose held-out remainder is 0 never teach labels. Null texts count as
empty; an empty text has zero vectors and gets the network's answer to those.
A document with several labels counts as its lowest. Without labels of
both kinds the score is the smoothed share of label 1 (0.5 without any).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Hashed rows for words and, after them, for shapes; both powers of two.
WORD_ROWS, SHAPE_ROWS = 1 << 14, 1 << 11
ROWS = WORD_ROWS + SHAPE_ROWS
#: Size of a word vector, and nonzeros of an index vector.
DIM, NONZERO = 32, 4
#: Labelled rows that the network learns from, at most.
SAMPLE_ROWS = 20_000
#: Score from which a document counts as good.
THRESHOLD = 0.3

_SHAPES = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)


def _hashed(words: pa.Array, rows: int) -> np.ndarray:
    """The hashed row of each word; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    of = np.fromiter((zlib.crc32(w) & (rows - 1) for w in distinct), np.int64, len(distinct))
    return of[np.asarray(coded.indices, dtype=np.int64)] if len(distinct) else np.zeros(0, np.int64)


def _shapes(texts: pa.Array) -> pa.LargeBinaryArray:
    """Texts as classes of bytes, each run of one class shortened to one byte."""
    binary = C.mapped(C.large_binary(texts), _SHAPES)
    offsets = np.frombuffer(binary.buffers()[1], np.int64, len(binary) + 1)
    body = np.frombuffer(binary.buffers()[2], np.uint8)[: offsets[-1]]
    keep = np.ones(len(body), bool)
    keep[1:] = body[1:] != body[:-1]
    keep[offsets[:-1][offsets[:-1] < len(body)]] = True
    moved = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(binary), [None, pa.py_buffer(moved), pa.py_buffer(np.ascontiguousarray(body[keep]))])


def streams(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words and for shapes: the rows of all tokens, and where each text's tokens begin."""
    words, word_at = C.alnum_words(texts)
    shapes, shape_at = C.split_words(_shapes(texts))
    return [(_hashed(words, WORD_ROWS), word_at), (_hashed(shapes, SHAPE_ROWS) + WORD_ROWS, shape_at)]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzeros of each row's index vector, from a fixed seed."""
    rng = np.random.default_rng(20)
    return rng.integers(0, DIM, (ROWS, NONZERO)), rng.choice([-1, 1], (ROWS, NONZERO)).astype(np.int64)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit word vectors of all rows, by random indexing over all documents (ROWS x DIM; zero where no token fell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(ROWS * DIM, np.int64)
        for batch in C.blocks(batches):
            for rows, at in streams(batch.column("text")):
                joined = np.ones(max(0, len(rows) - 1), bool)
                inner = at[1:-1]
                joined[inner[(inner > 0) & (inner < len(rows))] - 1] = False  # neighbours are of one text
                left, right = rows[:-1][joined], rows[1:][joined]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(a * DIM + places[b, k], signs[b, k], ROWS * DIM).astype(np.int64)
        table = total.reshape(ROWS, DIM)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(table[used, d]) for d in range(DIM))], names=["row", *(f"v{d}" for d in range(DIM))])

    dims = [f"v{d}" for d in range(DIM)]
    sums = docs.select(C.text_bytes(text_col).alias("text")).mapInArrow(run, ", ".join(["row long", *(f"{d} long" for d in dims)]))
    got = sums.groupBy("row").agg(*(F.sum(d).alias(d) for d in dims)).toPandas()  # at most ROWS rows
    table = np.zeros((ROWS, DIM), np.float32)
    if len(got):
        table[got["row"].to_numpy(np.int64)] = got[dims].to_numpy(np.float32)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norm > 0, norm, 1)


def pooled(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """Features of texts: for words and for shapes the mean vector, the logarithm of their number, and the share equal to their left neighbour."""
    parts = []
    for rows, at in streams(texts):
        sizes = np.diff(at)
        sums = np.zeros((len(sizes), DIM), np.float64)
        full = np.flatnonzero(sizes)
        of = np.repeat(np.arange(len(sizes)), sizes)
        for start in range(0, len(rows), 1 << 16):
            piece = of[start : start + (1 << 16)]
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            sums[piece[first]] += np.add.reduceat(table[rows[start : start + (1 << 16)]], first, axis=0)
        sums[full] /= sizes[full, None]
        again = np.zeros(len(sizes))
        if len(rows):
            again = np.bincount(of[1:], (rows[1:] == rows[:-1]) & (of[1:] == of[:-1]), len(sizes)) / np.maximum(sizes, 1)
        parts += [sums, np.log1p(sizes)[:, None], again[:, None]]
    return np.concatenate(parts, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """x -> sigmoid((tanh(((x - mean) / scale) a + b) c + d) / temperature)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4, seed: int = 3) -> Network:
    """Adam on the log loss; a fifth of the rows chooses the epoch and then the temperature."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    aside, learn = order[: len(x) // 5], order[len(x) // 5 :]
    if len(set(y[aside])) < 2:
        aside = learn
    scale = x[learn].std(axis=0)
    net = Network(x[learn].mean(axis=0), np.where(scale > 1e-6, scale, 1), [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)])
    z = (x - net.mean) / net.scale
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    best, kept, step = np.inf, [w.copy() for w in net.weights], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 256)):
            a, b, c, d = net.weights
            h = np.tanh(z[rows] @ a + b)
            error = (_sigmoid(h @ c + d[0]) - y[rows]) / len(rows)
            back = error[:, None] * c * (1 - h * h)
            slopes = [z[rows].T @ back + decay * a, back.sum(axis=0), h.T @ error + decay * c, np.array([error.sum()])]
            step += 1
            for w, g, m, v in zip(net.weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        if (now := _loss(net.logits(x[aside]), y[aside])) < best:
            best, kept = now, [w.copy() for w in net.weights]
    net.weights = kept
    logits = net.logits(x[aside])
    net.temperature = float(min(np.exp(np.linspace(-1.5, 2.5, 161)), key=lambda t: _loss(logits / t, y[aside])))
    return net


@dataclass
class QualityModel:
    table: np.ndarray
    network: Network | None
    prior: float

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        return self.network.score(pooled(texts, self.table))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Word vectors from all of ``docs``; the network from a bounded sample of labelled rows that aren't held out."""
    table = word_vectors(docs, text_col)
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"))
    marked = marked.where(~C.held_out("_id", 5, 0))
    known = marked.join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(batch.column("text"), shared.value)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), C.lists_of(list(x), pa.float64())], names=["id", "label", "x"])

    texts = docs.select(F.col(id_col).alias("_id"), C.text_bytes(text_col).alias("text")).join(F.broadcast(sample), "_id")  # at most sample_rows
    rows = C.map_blocks(texts.select(F.col("_id").cast("string").alias("id"), F.col("_label").cast("double").alias("label"), "text"), "id string, label double, x array<double>", run)
    got = rows.orderBy("id", "x").limit(2 * sample_rows).toArrow()  # ids that repeat give a row each
    y = (np.asarray(got.column("label"), dtype=np.float64) > 0).astype(np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y.tolist())) < 2:
        return QualityModel(table, None, prior)
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(len(y), -1)
    return QualityModel(table, fit_network(x, y), prior)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.score(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), C.held_out(id_col, 5, 0).alias("held_out"), C.text_bytes(text_col).alias("text"))
    return C.map_blocks(rows, f"doc_id {kind}, held_out boolean, score double, predicted int", run)


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.score(batch.column(text_col).cast(pa.large_binary()))
        return batch.filter(pa.array(score >= threshold))

    return C.map_blocks(docs, docs.schema, run, text=text_col)
