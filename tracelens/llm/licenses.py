"""License scans: an exact set-similarity join of text blocks with license templates.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A
template is the set of its words with a containment threshold: a text block
meets it if it holds at least the threshold's share of those words. Blocks are
windows of a text, twice as long as the template (a power of two, 16 words at
least) at steps of half their length, so any passage as long as the template
lies whole in some block, whatever the length of the text.

The join, over all blocks of all documents:

* words are ordered by how often they stand in all documents, rarest first;
  the counts of the templates' words come from a pass over the corpus;
* prefix filter: with a set of n words of which a must be met, one of the
  n - a + 1 rarest is there; only blocks around such places are built;
* length filter: a block must hold a template words at least;
* positional filter: the first common word's places in both ordered sets bound
  what the rest can still add;
* blocks that pass are counted exactly.

Phrases are templates that must be met whole; their blocks are then checked
for the words standing in order, which gives every place once.

Templates and phrases are parameters, broadcast with their words; no row is
shuffled but the word counts. Null counts as an empty text. A text with
no words has no blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

# Phrases and their labels, as the task states them.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# Sentences of public licenses, their labels and containment thresholds.
TEMPLATES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit", 0.8),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache-2", 0.8),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd", 0.8),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gpl-3", 0.8),
    ("General Public License, version 3", "gpl-3", 1.0),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc", 0.8),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "isc", 0.8),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mpl-2", 0.8),
]


@dataclass
class Template:
    label: str
    words: list[bytes]  # in order, repeats included
    share: float
    phrase: bool

    def block(self) -> int:
        return max(16, 1 << (2 * len(self.words) - 1).bit_length())

    def needed(self) -> int:
        return int(np.ceil(self.share * len(set(self.words)) - 1e-9))


def _template(text: str, label: str, share: float, phrase: bool) -> Template:
    words = text.encode().translate(C.WORD_BYTES).split()
    if not words:
        raise ValueError(f"the template of {label!r} has no words")
    return Template(label, words, share, phrase)


def _index(words: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """The place of each word in the vocabulary, -1 for others."""
    return np.asarray(pc.fill_null(pc.index_in(words.view(pa.large_binary()), value_set=vocabulary), -1), dtype=np.int64)


def corpus_counts(docs: DataFrame, words: list[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each of the given words stands in all documents."""
    vocabulary = pa.array(words, pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in C.blocks(batches):
            found = _index(C.alnum_words(batch.column("text"))[0], vocabulary)
            total += np.bincount(found[found >= 0], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total)], names=["word", "n"])

    counts = docs.select(C.text_bytes(text_col).alias("text")).mapInArrow(run, "word long, n long")
    got = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # a row for each given word
    return {w: got.get(i, 0) for i, w in enumerate(words)}


class Scanner:
    """The join of the blocks of some texts with the templates."""

    def __init__(self, templates: list[Template], counts: dict[bytes, int]):
        ordered = sorted({w for t in templates for w in t.words}, key=lambda w: (counts[w], w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.vocabulary = pa.array(ordered, pa.large_binary())
        self.scales: dict[int, list[Template]] = {}
        for t in templates:
            self.scales.setdefault(t.block(), []).append(t)

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]], list[list[dict]]]:
        """For each text: its number of words, the places of phrases, and the blocks that meet a template."""
        words, offsets = C.alnum_words(texts)
        sizes = np.diff(offsets)
        places: list[list[dict]] = [[] for _ in sizes]
        found: list[list[dict]] = [[] for _ in sizes]
        codes = _index(words, self.vocabulary)
        known = np.flatnonzero(codes >= 0)
        text_of = np.repeat(np.arange(len(sizes)), sizes)[known]
        for width, templates in self.scales.items():
            step = width // 2
            blocks = np.where(sizes > 0, np.maximum(0, -(-(sizes - width) // step)) + 1, 0)
            first = np.cumsum(blocks) - blocks
            keys = self._entries(templates, codes[known], known - offsets[text_of], text_of, step, blocks, first)
            block, rank = np.divmod(keys, len(self.rank))
            begins = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
            held = np.diff(np.append(begins, len(block)))  # template words in each block
            for t in templates:
                for at, share in self._met(t, rank, begins, held):
                    name = int(block[begins[at]])
                    text = int(np.searchsorted(first, name, side="right") - 1)
                    start = (name - int(first[text])) * step
                    end = min(start + width, int(sizes[text]))
                    if t.phrase:
                        places[text] += [{"start": p, "label": t.label} for p in self._stand(t, codes[offsets[text] : offsets[text + 1]], start, end)]
                    else:
                        found[text].append({"label": t.label, "start": start, "end": end, "containment": share})
        for own in places:  # blocks overlap
            own[:] = [dict(x) for x in sorted({tuple(sorted(p.items())) for p in own}, key=lambda x: (dict(x)["start"], dict(x)["label"]))]
        return sizes, places, found

    def _entries(self, templates, codes, at, text_of, step, blocks, first) -> np.ndarray:
        """Distinct (block, word) pairs, as block * words + rank, of the blocks that hold a prefix word of a template."""
        words, prefix = np.zeros(len(self.rank), bool), np.zeros(len(self.rank), bool)
        for t in templates:
            ranks = sorted({self.rank[w] for w in t.words})
            words[ranks] = True
            prefix[ranks[: len(ranks) - t.needed() + 1]] = True

        def of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own, text = at[mask] // step, text_of[mask]
            pairs = [(first[text] + k, codes[mask], (k >= 0) & (k < blocks[text])) for k in (own, own - 1)]
            return np.concatenate([b[ok] for b, _, ok in pairs]), np.concatenate([c[ok] for _, c, ok in pairs])

        marked = np.zeros(int(blocks.sum()), bool)
        marked[of(prefix[codes])[0]] = True
        block, rank = of(words[codes])
        return np.unique((block * len(self.rank) + rank)[marked[block]])

    def _met(self, t: Template, rank, begins, held) -> Iterator[tuple[int, float]]:
        ranks = sorted({self.rank[w] for w in t.words})
        place = np.full(len(self.rank), -1)
        place[ranks] = np.arange(len(ranks))
        size, need = len(ranks), t.needed()
        mine = np.flatnonzero(place[rank] >= 0)
        if not len(mine):
            return
        of = np.searchsorted(begins, mine, side="right") - 1
        firsts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        block, i, j = of[firsts], mine[firsts] - begins[of[firsts]], place[rank[mine[firsts]]]
        fits = (held[block] >= need) & (j <= size - need) & (i <= held[block] - need)  # length, prefixes
        fits &= 1 + np.minimum(size - j - 1, held[block] - i - 1) >= need  # positions
        common = np.bincount(of, minlength=len(begins))
        for b in block[fits & (common[block] >= need)]:
            yield int(b), float(common[b] / size)

    def _stand(self, t: Template, codes: np.ndarray, start: int, end: int) -> list[int]:
        """Places within a block where the phrase's words stand in a row."""
        n = len(t.words)
        if end - start < n:
            return []
        there = np.ones(end - start - n + 1, bool)
        for k, w in enumerate(t.words):
            there &= codes[start + k : end - n + 1 + k] == self.rank[w]
        return (np.flatnonzero(there) + start).tolist()


def license_scan(docs: DataFrame, templates: list[tuple[str, str, float]] | None = None, phrases: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, places (start word, label) of phrases, blocks (label, start, end, containment)."""
    own = [_template(text, label, share, False) for text, label, share in (TEMPLATES if templates is None else templates)]
    own += [_template(text, label, 1.0, True) for text, label in (PHRASES if phrases is None else phrases)]
    counts = corpus_counts(docs, sorted({w for t in own for w in t.words}), text_col)
    shared = docs.sparkSession.sparkContext.broadcast((own, counts))
    kind = docs.schema[id_col].dataType.simpleString()
    place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*shared.value)
        for batch in C.blocks(batches):
            sizes, places, found = scanner.scan(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(places, place), pa.array(found, block)], names=["doc_id", "n_words", "places", "blocks"])

    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, places array<struct<start:long,label:string>>, blocks array<struct<label:string,start:long,end:long,containment:double>>")
