"""BPE encoding and decoding through a table of distinct words.

1. Texts are split at ASCII white space into words. The tokenizer drops white
   space and no piece, normal form or special token crosses it, so a text's
   ids are its words' ids in a row.
2. The distinct words of all texts are encoded, each once, in the bucket to
   which it hashes.
3. Ids go back by position: a block's texts are arrays of word numbers
   (:mod:`word_blocks`), and the block's words, joined with their ids, turn
   them into ids.
4. Decoding joins ids with the vocabulary's id-to-piece table, by position in
   it; a text's decoded form is its pieces joined by a space, as the
   tokenizer, which has no decoder of its own, gives them. Other kinds of
   tokenizer are refused (:func:`check_supported`).

A word is in a block once whatever the skew of texts or words. The tokenizer
and its piece table are broadcast: they are as large as the vocabulary file.
Null texts count as empty; a word that is only exotic white space has no ids.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import word_blocks as W

#: Words sent to the tokenizer at once.
BATCH = 4096
#: Bytes of text in a block: a task holds the forms of one block's words at a time.
BLOCK = 8 << 20


#: The tokenizer that this Python process has built: building one costs time and memory, and a worker runs many groups.
_built: dict[int, object] = {}


def _encoder(content: str):
    name = hash(content)
    if name not in _built:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _built.clear()
        _built[name] = tokenizer
    return _built[name]


def drop_encoder() -> None:
    """Gives back the memory of this process's tokenizer (some 90 MB with its cache): a reused worker would hold it through the next stage."""
    if _built:
        _built.clear()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
        if trim:
            trim(0)


#: Texts that tell a tokenizer of the supported kind from others.
PROBES = ["Hello world  two", " a\tb\r\nc ", "it's 12 x-y, isn't it?", "Éa é 日本 語 😀 ½", "\u00a0x \u3000y", "one", ""]


def check_supported(content: str) -> None:
    """Raises ValueError unless a text's ids are its words' ids in a row, and it decodes to its pieces joined by a space."""
    if json.loads(content).get("decoder") is not None:
        raise ValueError("a tokenizer with a decoder of its own is not supported: see merge_replay for byte-level ones")
    tokenizer, table = _encoder(content), pieces(content)
    if any(t.content.split() != [t.content] or t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values()):
        raise ValueError("a tokenizer whose added tokens take in white space is not supported")
    for text in PROBES:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        by_word = [i for w in text.encode().split() for i in tokenizer.encode(w.decode(), add_special_tokens=False).ids]
        if ids != by_word or tokenizer.decode(ids, skip_special_tokens=False).encode() != b" ".join([table[i] for i in ids]):
            raise ValueError(f"not a tokenizer that drops white space: it parts {text!r} otherwise than word by word")


def pieces(content: str) -> list[bytes]:
    """The id-to-piece table: the piece of id i, special tokens included, at place i."""
    vocabulary = _encoder(content).get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        table[i] = piece.encode()
    return table


def encode_words(words: DataFrame, content: str) -> DataFrame:
    """The rows of :func:`word_blocks.block_words` with each word's ids: (block, hash, codes, sizes, ids), packed.

    A bucket has all rows of its words, so every distinct word is encoded once.
    """
    shared = words.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _encoder(shared.value)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            rows = batch.to_pylist()
            lists = [W.unpack_words(r["words"]) for r in rows]
            new = [w for w in dict.fromkeys(w for x in lists for w in x) if w not in known]
            for start in range(0, len(new), BATCH):
                part = new[start : start + BATCH]
                found = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
                known.update(zip(part, [x.ids for x in found], strict=True))
            sizes = [W.pack(np.array([len(known[w]) for w in x])) for x in lists]
            ids = [W.pack(np.array([i for w in x for i in known[w]], dtype=np.int64)) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("hash"), batch.column("codes"), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], names=["block", "hash", "codes", "sizes", "ids"])

    return words.groupBy("bucket").applyInArrow(run, "block long, hash long, codes binary, sizes binary, ids binary")


class BlockIds:
    """Ids and decoded forms of a block's words, by code."""

    def __init__(self, rows: list[dict], table: list[bytes]):
        codes = [W.unpack(r["codes"]) for r in rows]
        sizes = [W.unpack(r["sizes"]) for r in rows]
        none = [np.zeros(0, np.int64)]
        order, size = np.concatenate(codes or none), np.concatenate(sizes or none)
        self.flat = np.concatenate([W.unpack(r["ids"]) for r in rows] or none)
        self.first, self.size = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        self.first[order], self.size[order] = np.cumsum(size) - size, size
        self.forms = [b" ".join([table[i] for i in self.flat[a : a + n].tolist()]) for a, n in zip(self.first.tolist(), self.size.tolist(), strict=True)]

    def ids(self, codes: np.ndarray) -> np.ndarray:
        size = self.size[codes]
        return self.flat[np.arange(size.sum()) + np.repeat(self.first[codes] - np.cumsum(size) + size, size)]

    def decoded(self, codes: np.ndarray) -> bytes:
        return b" ".join([f for f in map(self.forms.__getitem__, codes.tolist()) if f])


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, ``carry``, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers,
    decoded_sha256 over the decoded text in UTF-8. ``docs`` must be a scan or
    a staged table.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    check_supported(content)
    names_of = {f"carry{i}": c for i, c in enumerate(carry)}  # so that no carried name meets one used here
    own = docs.select(F.col(id_col).alias("doc_id"), *(F.col(c).alias(k) for k, c in names_of.items()), C.text_bytes(text_col).alias("text"))
    kept = [f for f in own.schema.fields if f.name != "text"]
    words = encode_words(W.block_words(own, W.buckets_for(own), BLOCK), content)
    table = docs.sparkSession.sparkContext.broadcast(pieces(content))
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] * with_ids + ["decoded string"] * with_text

    def work(texts: pa.Table, words: list[dict]) -> pa.Table:
        drop_encoder()
        block = BlockIds(words, table.value)
        n, shas, back, ids_out, text_out = [], [], [], [], []
        for data in texts.column("codes"):
            codes = W.unpack(data.as_py())
            ids, whole = block.ids(codes), block.decoded(codes)
            n.append(len(ids))
            shas.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            back.append(hashlib.sha256(whole).hexdigest())
            if with_ids:
                ids_out.append(ids.astype(np.int32))
            if with_text:
                text_out.append(whole.decode())
        columns = [*(texts.column(f.name) for f in kept), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]
        names = [*(f.name for f in kept), "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns, names = [*columns, C.lists_of(ids_out, pa.int32())], [*names, "ids"]
        if with_text:
            columns, names = [*columns, pa.array(text_out, pa.string())], [*names, "decoded"]
        return pa.table(columns, names=names)

    return W.with_words(W.block_texts(own, BLOCK), words, work, ", ".join(fields)).withColumnsRenamed(names_of)
