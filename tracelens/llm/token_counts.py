"""Token counts by a linear longest-match automaton.

A vocabulary has pieces that begin a word and pieces that go on with one. A
word's tokens are the longest piece that begins it, then the longest
continuing piece at each next place; a word with a place where none fits is
one unknown token. The automaton has a trie for either kind. Each node has a
failure link, to the node for what is left once the longest pieces are cut off
the front, and the number of pieces so cut off, known beforehand. So a word's
count comes from one pass over its characters, without building pieces.

Words are split at ASCII white space, texts taken as they are. Each distinct
word of a block is counted once, and a task remembers counts of up to
``REMEMBERED`` words (fewer only cost time). The vocabulary is broadcast; the
automaton is built once in a Python worker. Null counts as empty.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

REMEMBERED = 1 << 19
_UNKNOWN = -1
_built: dict[int, LongestMatch] = {}


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model that begin a word, and those that go on with one; bytes and control pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    mark = "▁"  # this stands for the space before a word
    begin = [p[1:] for p in pieces if p.startswith(mark) and len(p) > 1 and mark not in p[1:]]
    return begin, [p for p in pieces if mark not in p]


class LongestMatch:
    """The automaton; nodes 0 and 1 are the roots of pieces that begin a word and that go on with one."""

    def __init__(self, begin: list[str], go_on: list[str]):
        self.child: dict[tuple[int, str], int] = {}
        whole, children = {}, [[], []]
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    if (node, c) not in self.child:
                        self.child[node, c] = len(children)
                        children[node].append(c)
                        children.append([])
                    node = self.child[node, c]
                if node != root:
                    whole[node] = True
        self.fail = [_UNKNOWN] * len(children)
        self.popped = [0] * len(children)
        queue = deque([0, 1])  # by length of the nodes' strings: failure links lead to shorter ones
        while queue:
            node = queue.popleft()
            for c in children[node]:
                child = self.child[node, c]
                if child in whole:
                    self.fail[child], self.popped[child] = 1, 1
                else:
                    back, popped = self.fail[node], self.popped[node]
                    while back != _UNKNOWN and (back, c) not in self.child:
                        popped += self.popped[back]
                        back = self.fail[back]
                    if back != _UNKNOWN:
                        self.fail[child], self.popped[child] = self.child[back, c], popped
                queue.append(child)

    def count(self, word: str) -> int:
        """Tokens of a word, -1 if it is unknown; 0 for the empty word."""
        child, fail, popped = self.child, self.fail, self.popped
        node, total = 0, 0
        for c in word:
            while (following := child.get((node, c))) is None:
                total += popped[node]
                node = fail[node]
                if node == _UNKNOWN:
                    return _UNKNOWN
            node = following
        while node > 1:
            total += popped[node]
            node = fail[node]
        return total if node != _UNKNOWN else _UNKNOWN


def token_counts(docs: DataFrame, begin: list[str], go_on: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens (an unknown word is one), n_unknown."""
    shared = docs.sparkSession.sparkContext.broadcast((begin, go_on))
    name = hash((tuple(begin), tuple(go_on)))
    kind = docs.schema[id_col].dataType.simpleString()
    remembered: dict[bytes, int] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if name not in _built:
            _built.clear()
            _built[name] = LongestMatch(*shared.value)
        automaton = _built[name]
        words, offsets = C.split_words(batch.column("text"))
        coded = words.dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        if len(remembered) > REMEMBERED:
            remembered.clear()
        for w in distinct:
            if w not in remembered:
                remembered[w] = automaton.count(w.decode("utf-8", "replace"))
        counts = np.fromiter(map(remembered.__getitem__, distinct), np.int64, len(distinct))
        each = counts[np.asarray(coded.indices, dtype=np.int64)] if len(distinct) else np.zeros(0, np.int64)
        tokens = np.concatenate([[0], np.cumsum(np.abs(each))])
        unknown = np.concatenate([[0], np.cumsum(each < 0)])
        a, b = offsets[:-1], offsets[1:]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(b - a), pa.array(tokens[b] - tokens[a]), pa.array(unknown[b] - unknown[a])], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_bytes(text_col).alias("text"))
    return C.map_blocks(rows, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long", work)
