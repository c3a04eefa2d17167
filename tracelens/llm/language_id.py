"""Language identification by cross-parsing entropy.

A text is parsed against labelled text of each language: from each place the
longest match anywhere in the reference is one phrase, and the parse goes on
behind it (a letter the reference lacks is a phrase by itself). The suffix
automaton of a reference has a state for each distinct substring's ending
places, so a longest match is a walk that ends where no transition is left.
Phrases times log2 of the reference's length, over the text's length, estimate
the cross entropy; the language that needs least wins.

References: of each language at most ``REFERENCE_ROWS`` labelled rows that
aren't held out, those with the smallest hash of their id, rows of at most
``REFERENCE_BYTES`` bytes first; rows are added whole while they fit in
``REFERENCE_BYTES`` (the first always is). This bounds the labelled sample
alone; every text is parsed whole.

The automata become tables of transitions, and many texts are walked at once
in numpy, a byte each step, in segments of ``SEGMENT`` bytes whose states are
carried on, so that a match may cross a cut. Text is compared in lower case, all but letters as
single spaces.

A text that is null or has no letter is ``und`` with score 0, and so is
every text when no language could be learned. Ties go to the language first in
alphabetical order. The score is 1 - least / second least entropy (1 with
one language).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

REFERENCE_ROWS = 200
REFERENCE_BYTES = 64 << 10
SEGMENT = 2048

#: Unicode category L; numerals such as ½ or Ⅷ are none.
_letter = regex.compile(r"\p{L}")
#: ASCII letters, bytes of other characters and the space stay.
_KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_built: dict[int, Parser] = {}


def normal(text: str) -> bytes:
    """Lower case, each run of ASCII that isn't a letter as one space; a space at both ends."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_KEPT).split()) + b" "


class SuffixAutomaton:
    """States with transitions by byte; state 0 is the empty match."""

    def __init__(self, text: bytes):
        self.next: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        for c in text:
            now = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = now
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now


class Parser:
    """All languages' automata as one table: by state and byte, the following state and the phrases that end."""

    def __init__(self, references: dict[str, bytes]):
        self.languages = sorted(references)
        seen = sorted({b for r in references.values() for b in r})
        self.symbol = np.zeros(256, np.uint8)  # 0 stands for bytes that no reference has
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        self.weight = np.array([np.log2(len(references[k]) + 1) for k in self.languages])
        tables, self.roots, base = [], [], 0
        for k in self.languages:
            following = SuffixAutomaton(references[k]).next
            restart = np.full(self.width, (base << 2) + 2, np.int64)  # the match ends, and the byte is a phrase too
            for c, to in following[0].items():
                restart[self.symbol[c]] = ((base + to) << 2) + 1
            table = np.tile(restart, (len(following), 1))
            for state, moves in enumerate(following):
                for c, to in moves.items():
                    table[state, self.symbol[c]] = (base + to) << 2
            table[0] = np.where(table[0] & 3 == 2, table[0] - 1, table[0])  # no match has begun
            tables.append(table.astype(np.int32))
            self.roots.append(base)
            base += len(following)
        self.table = np.concatenate(tables).reshape(-1)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text in each language."""
        sizes = np.array([len(t) for t in texts])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(texts), axis=1)
        total = np.zeros(state.shape, np.int64)
        for at in range(0, int(sizes[0]), SEGMENT):  # states go on from segment to segment
            widths = np.minimum(sizes[: np.searchsorted(-sizes, -at, side="left")] - at, SEGMENT)
            symbols = np.zeros((len(widths), int(widths[0])), np.uint8)
            for i, k in enumerate(order[: len(widths)]):
                symbols[i, : widths[i]] = self.symbol[np.frombuffer(texts[k], np.uint8, widths[i], at)]
            symbols = np.ascontiguousarray(symbols.T)
            live = np.searchsorted(-widths, -np.arange(symbols.shape[0]), side="left")  # lanes longer than each step
            for step in range(symbols.shape[0]):
                n = live[step]
                moved = self.table[state[:, :n] * self.width + symbols[step, :n]]
                total[:, :n] += moved & 3
                state[:, :n] = moved >> 2
        total += state != roots  # the last match
        out = np.zeros((len(texts), len(roots)), np.int64)
        out[order] = total.T
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        plain = [normal(t) for t in texts]
        letters = np.array([bool(_letter.search(t)) for t in texts])
        entropy = self.phrases(plain) * self.weight / np.array([len(t) for t in plain])[:, None]
        best = entropy.argmin(axis=1)
        ranked = np.sort(entropy, axis=1)
        score = 1 - ranked[:, 0] / ranked[:, 1] if len(self.languages) > 1 else np.ones(len(texts))
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, np.clip(score, 0, 1), 0.0)


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = REFERENCE_ROWS, most: int = REFERENCE_BYTES) -> dict[str, bytes]:
    """Labelled text of each language, from rows that aren't held out."""
    size = F.octet_length(text_col)
    thin = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~C.held_out(id_col, 5, 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("hash"), size.alias("size")
    )
    order = Window.partitionBy("lang").orderBy(F.col("size") > most, F.when(F.col("size") > most, F.col("size")), "hash", "id", "text")
    drawn = thin.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= rows)  # pruned in each task before the shuffle
    so_far = F.sum("size").over(Window.partitionBy("lang").orderBy("nth"))
    out: dict[str, bytes] = {}
    for row in drawn.withColumn("so_far", so_far).where(f"nth = 1 or so_far <= {most}").orderBy("lang", "nth").select("lang", "text").toLocalIterator():
        out[row["lang"]] = out.get(row["lang"], b"") + normal(row["text"])
    return out


def identify(docs: DataFrame, learned: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    name = hash(tuple(sorted(learned.items())))
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.decode("utf-8", "replace") for t in C.large_binary(batch.column("text")).to_pylist()]
        if not shared.value:
            names, score = ["und"] * len(texts), np.zeros(len(texts))
        else:
            if name not in _built:
                _built.clear()
                _built[name] = Parser(shared.value)
            names, score = _built[name].predict(texts)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), C.held_out(id_col, 5, 0).alias("held_out"), C.text_bytes(text_col).alias("text"))
    return C.map_blocks(rows, f"doc_id {kind}, held_out boolean, lang_pred string, score double", work)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the labelled rows of ``docs`` and predicts all of them."""
    return identify(docs, references(docs, id_col, text_col, lang_col), id_col, text_col)
