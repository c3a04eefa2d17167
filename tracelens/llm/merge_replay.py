"""Byte-level BPE through a corpus-level replay of the merges.

1. Texts are cut before spaces into units, places that no match of the
   tokenizer's pattern crosses. A block of texts (up to ``MOST`` bytes in one
   task) numbers its distinct units and deals them out to buckets by hash,
   packed; every distinct unit of the corpus meets in one bucket, once for
   each block that holds it, so none is hot. There it is split by the pattern
   into words.
2. A bucket's distinct words lie behind each other as one sequence of byte
   tokens with links to the left and right neighbour. An inverted index leads
   from a merge (the token that a pair of tokens makes) to the places where
   that pair stands. Merges are replayed in rank order over all words at once;
   a merge visits its places alone, and only the pairs with the touched
   neighbours are looked up and entered in the index anew.
3. Ids go back to the blocks by position in their unit tables. A text's ids
   are those of its units in a row; decoding joins ids with the id-to-bytes
   table.

Merging all places of one rank at once equals merging word by word, leftmost
first, as long as no merge on the way makes a pair of a lower rank. Tokens
with which that can happen are known from the table; for these a word's
places are replayed up to the first such pair, the rest when its turn comes.
A word that is itself a token is that token.

Null texts count as empty; an empty text has no ids and decodes to nothing.
Rows repeat in the result as they do in the input, rows without id included;
an empty table gives an empty result. The rank table is broadcast: it is as
large as the vocabulary file. ``docs`` must give the same partitions whenever
it is read: a file scan or a staged table does.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import word_blocks as W

#: Bytes of text in a block, about.
MOST = 16 << 20
#: Buckets of units for each partition of the texts: a bucket holds the distinct units of a fixed amount of text.
BUCKETS = 4
#: Bytes of distinct words that one replay holds; a bucket with more is replayed in parts.
REPLAY_BYTES = 4 << 20
#: Places of one merge from which numpy beats a plain loop.
VECTOR = 64
#: Characters that the pattern is matched against at a time.
SPLIT_CHARS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ranks, from a file of lines "base64 rank"."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class MergeTable:
    """Which pairs of tokens merge, into what: every cut of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.width = ranks, max(ranks.values()) + 1
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.byte_token = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.bytes_of = [b""] * self.width
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        #: Tokens that can form a pair of a lower rank than their own.
        self.overtaken = {t for k, r in pairs.items() for t in divmod(k, self.width) if r < t}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks that the pairs make, -1 for those that don't merge; a negative token makes none."""
        if not len(self.keys):
            return np.full(len(left), -1, dtype=np.int64)
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values (none negative)."""
    cuts = np.append(np.flatnonzero(np.diff(values, prepend=-1)), len(values)).tolist()
    return list(zip(cuts, cuts[1:]))


def replay(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the distinct ``words`` in a row, and how many each word has."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    n = int(lengths.sum())
    # Place n stands for "no neighbour": its token is -1 and no pair with it merges.
    tokens = array("i", np.append(table.byte_token[np.frombuffer(b"".join(words), np.uint8)], np.int32(-1)).tobytes())
    after = array("i", np.arange(1, n + 2, dtype=np.int32).tobytes())
    before = array("i", np.arange(-1, n, dtype=np.int32).tobytes())
    tok, nxt, prv = (np.frombuffer(a, dtype=np.int32) for a in (tokens, after, before))
    ends = np.cumsum(lengths)
    full = lengths > 0
    nxt[ends[full] - 1] = n
    prv[(ends - lengths)[full]] = n
    nxt[n] = prv[n] = n
    made_at = array("i", np.full(n + 1, -1, dtype=np.int32).tobytes())  # what the pair that begins here makes
    made = np.frombuffer(made_at, dtype=np.int32)
    made[:n] = table.lookup(tok[:n], tok[nxt[:n]])
    index: dict[int, list[int]] = {}
    order = np.argsort(made[:n], kind="stable")
    order = order[np.searchsorted(made[order], 0) :]
    for a, b in _runs(made[order]):
        index[int(made[order[a]])] = order[a:b].tolist()
    queue = list(index)
    heapq.heapify(queue)
    gone = np.zeros(n + 1, dtype=bool)
    pairs, width = table.pairs.get, table.width

    def enter(rank: int, place: int) -> None:
        if rank not in index:
            index[rank] = [place]
            heapq.heappush(queue, rank)
        else:
            index[rank].append(place)

    def one(rank: int, place: int) -> int:
        """Merge at one place; the lowest rank of the pairs that arise there."""
        second = after[place]
        right, left = after[second], before[place]
        tokens[place], after[place], gone[second], made_at[second] = rank, right, True, -1
        before[right] = place if right != n else n
        r = pairs(rank * width + tokens[right], -1) if right != n else -1
        made_at[place] = r
        low = r if r >= 0 else width
        if r >= 0:
            enter(r, place)
        if left != n:
            r = pairs(tokens[left] * width + rank, -1)
            made_at[left] = r
            if r >= 0:
                enter(r, left)
                low = min(low, r)
        return low

    def many(rank: int, places: np.ndarray) -> None:
        """Merge at all places; no two of them overlap."""
        second = nxt[places]
        right, left = nxt[second], prv[places]
        tok[places] = rank
        nxt[places] = right
        prv[right] = places
        prv[n] = n
        gone[second], made[second] = True, -1
        left = prv[places]  # a neighbour that was itself merged has moved
        made[places] = table.lookup(tok[places], tok[right])
        had = left[left != n]
        made[had] = table.lookup(tok[had], tok[nxt[had]])
        touched = np.unique(np.concatenate([places, had]))
        new = made[touched]
        touched, new = touched[new >= 0], new[new >= 0]
        by = np.argsort(new, kind="stable")
        touched, new = touched[by], new[by]
        flat = touched.tolist()
        for a, b in _runs(new):
            r = int(new[a])
            if r in index:
                index[r].extend(flat[a:b])
            else:
                index[r] = flat[a:b]
                heapq.heappush(queue, r)

    while queue:
        rank = heapq.heappop(queue)
        held = index.pop(rank)
        if rank in table.overtaken:
            places = sorted({p for p in held if made_at[p] == rank})
            stopped = -1  # up to this end of a word, places wait
            for k, p in enumerate(places):
                if p < stopped:
                    enter(rank, p)
                elif made_at[p] == rank and one(rank, p) < rank and k + 1 < len(places):
                    stopped = int(ends[np.searchsorted(ends, p, side="right")])
        elif len(held) < VECTOR:
            for p in sorted(set(held)):
                if made_at[p] == rank:
                    one(rank, p)
        else:
            places = np.unique(np.array(held, dtype=np.int64))
            places = places[made[places] == rank]
            if len(places):
                # In a run of overlapping places every other one merges, from the left.
                joined = np.append(False, nxt[places[:-1]] == places[1:])
                start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(places))))
                many(rank, places[(np.arange(len(places)) - start) % 2 == 0])
    alive = ~gone[:n]
    counts = np.concatenate([[0], np.cumsum(alive)])
    return tok[:n][alive].astype(np.int64), counts[ends] - counts[ends - lengths]


def encode_distinct(words: list[bytes], table: MergeTable) -> list[bytes]:
    """Ids of each word, as little-endian 32-bit integers."""
    out: list[bytes] = [b""] * len(words)
    waiting: list[int] = []
    size = 0

    def flush() -> None:
        ids, sizes = replay([words[i] for i in waiting], table)
        data, at = ids.astype("<u4").tobytes(), (np.cumsum(sizes) - sizes).tolist()
        for i, a, k in zip(waiting, at, sizes.tolist(), strict=True):
            out[i] = data[4 * a : 4 * (a + k)]

    for i, word in enumerate(words):
        whole = table.ranks.get(word)
        if whole is not None:
            out[i] = whole.to_bytes(4, "little")
            continue
        waiting.append(i)
        size += len(word)
        if size >= REPLAY_BYTES:
            flush()
            waiting, size = [], 0
    if waiting:
        flush()
    return out


def split(text: str, pattern: regex.Pattern, most: int = SPLIT_CHARS) -> Iterator[list[str]]:
    """Matches of the pattern, in lists of those of about ``most`` characters.

    A match that touches the end of its stretch might go on, so it is matched
    again from its own start with more text behind it. Text between matches
    has no token, as in the tokenizer itself.
    """
    at, step = 0, most
    while at < len(text):
        end = min(len(text), at + step)
        spans = [m.span() for m in pattern.finditer(text, at, end)] if end < len(text) else None
        if spans is None:
            yield pattern.findall(text, at)
            return
        # The last match, and one whose lookahead met the end, are left for the next stretch.
        kept = [s for s in spans[:-1] if s[1] < end - 1]
        if not kept and spans:
            step *= 2
            continue
        yield [text[a:b] for a, b in kept]
        at, step = (kept[-1][1] if kept else end), most


#: Patterns and tables that this Python process has built.
_built: dict[str, object] = {}


def _once(name: str, build):
    if name not in _built:
        _built[name] = build()
    return _built[name]


def units(texts: pa.LargeBinaryArray, cut: bool = True) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The units of all texts in a row, and where each text's begin (one place more at the end).

    Texts are cut before a space that follows a character which is certainly
    no white space: an ASCII sign, or a two-byte character from U+00C0 on.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    body = np.frombuffer(data if data is not None else b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    begins = np.zeros(len(body), dtype=bool)
    begins[ends[:-1][np.diff(ends) > 0]] = True
    if cut:
        spaces = np.flatnonzero(body == 32)
        spaces = spaces[spaces > 1]
        before, lead = body[spaces - 1], body[spaces - 2]
        sure = ((before > 32) & (before < 127)) | ((before >= 128) & (lead >= 0xC3) & (lead <= 0xDF))
        begins[spaces[sure]] = True
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(body)).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])
    return found, np.searchsorted(starts, ends)


def _blocks(batches: Iterator[pa.RecordBatch], cut: bool, most: int):
    """Each block: its name, a hash of what it holds, its rows, distinct units, their codes in a row and where each text's begin."""
    part = TaskContext.get().partitionId() << 24
    for number, batch in enumerate(C.blocks(batches, "text", most)):
        texts = C.large_binary(batch.column("text"))
        found, offsets = units(texts, cut)
        coded = found.dictionary_encode()
        check = xxhash.xxh64(found.buffers()[2])
        check.update(offsets.tobytes())
        yield part + number, check.intdigest() >> 1, batch, coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64), offsets


def block_units(docs: DataFrame, buckets: int, cut: bool = True, most: int = MOST) -> DataFrame:
    """(bucket, block, hash, codes, sizes, units): each block's distinct units of each bucket, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, _, distinct, _, _ in _blocks(batches, cut, most):
            bucket = np.fromiter((zlib.crc32(u) % buckets for u in distinct), np.int64, len(distinct))
            order = np.argsort(bucket, kind="stable")
            rows = []
            for a, b in _runs(bucket[order]):
                mine = [distinct[i] for i in order[a:b].tolist()]
                rows.append({"bucket": int(bucket[order[a]]), "block": block, "hash": check, "codes": W.pack(order[a:b]), "sizes": W.pack(np.array([len(u) for u in mine])), "units": zstandard.compress(b"".join(mine), 1)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("hash", pa.int64()), ("codes", pa.binary()), ("sizes", pa.binary()), ("units", pa.binary())])
    return docs.mapInArrow(run, "bucket int, block long, hash long, codes binary, sizes binary, units binary")


def block_texts(docs: DataFrame, cut: bool = True, most: int = MOST) -> DataFrame:
    """(block, hash, all columns but text, codes) of the same blocks."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(["block long", "hash long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "codes binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, batch, _, codes, offsets in _blocks(batches, cut, most):
            n = batch.num_rows
            packed = [W.pack(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [pa.array(np.full(n, block)), pa.array(np.full(n, check)), *(batch.column(f.name) for f in rest), pa.array(packed, pa.binary())]
            whole = pa.RecordBatch.from_arrays(columns, names=["block", "hash", *(f.name for f in rest), "codes"])
            for start in range(0, n, 4096):
                yield whole.slice(start, 4096)

    return docs.mapInArrow(run, schema)


def encode_units(distinct: list[bytes], pattern: regex.Pattern, table: MergeTable) -> list[bytes]:
    """Ids of each unit, as little-endian 32-bit integers: those of its words, of which each distinct one is encoded once."""
    code: dict[str, int] = {}
    flat, sizes = array("q"), []
    for unit in distinct:
        n = len(flat)
        for found in split(unit.decode("utf-8", "replace"), pattern):
            flat.extend([code.setdefault(w, len(code)) for w in found])
        sizes.append(len(flat) - n)
    known = encode_distinct([w.encode() for w in code], table)
    words = flat.tolist()
    out, at = [], 0
    for n in sizes:
        out.append(known[words[at]] if n == 1 else b"".join([known[i] for i in words[at : at + n]]))
        at += n
    return out


def replay_units(packed: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The rows of :func:`block_units` with each unit's ids: (block, hash, codes, sizes, ids), packed."""
    shared = packed.sparkSession.sparkContext.broadcast(ranks)
    name = hashlib.sha256(repr(list(ranks.items())).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _once(f"table {name}", lambda: MergeTable(shared.value))
        compiled = _once(f"pattern {pattern}", lambda: regex.compile(pattern))
        known: dict[bytes, bytes] = {}
        for batch in batches:
            rows = batch.to_pylist()
            lists = []
            for r in rows:
                data, ends = zstandard.decompress(r["units"]), np.cumsum(W.unpack(r["sizes"])).tolist()
                lists.append([data[a:b] for a, b in zip([0, *ends], ends)])
            new = [u for u in dict.fromkeys(u for x in lists for u in x) if u not in known]
            known.update(zip(new, encode_units(new, compiled, table), strict=True))
            sizes = [W.pack(np.array([len(known[u]) // 4 for u in x])) for x in lists]
            ids = [W.pack(np.frombuffer(b"".join([known[u] for u in x]), "<u4")) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("hash"), batch.column("codes"), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], names=["block", "hash", "codes", "sizes", "ids"])

    return packed.groupBy("bucket").applyInArrow(run, "block long, hash long, codes binary, sizes binary, ids binary")


class UnitForms:
    """Of a block's units, by code: ids, their decimal form and the bytes they decode to."""

    def __init__(self, rows: list[dict], bytes_of: list[bytes]):
        none = [np.zeros(0, np.int64)]
        order = np.concatenate([W.unpack(r["codes"]) for r in rows] or none)
        size = np.concatenate([W.unpack(r["sizes"]) for r in rows] or none)
        self.flat = np.concatenate([W.unpack(r["ids"]) for r in rows] or none)
        self.first, self.size = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        self.first[order], self.size[order] = np.cumsum(size) - size, size
        ids = self.flat.tolist()
        spans = [ids[a : a + n] for a, n in zip(self.first.tolist(), self.size.tolist(), strict=True)]
        self.decimal = [" ".join(map(str, x)).encode() for x in spans]
        self.decoded = [b"".join([bytes_of[i] for i in x]) for x in spans]

    def ids(self, codes: np.ndarray) -> np.ndarray:
        size = self.size[codes]
        return self.flat[np.arange(size.sum()) + np.repeat(self.first[codes] - np.cumsum(size) + size, size)]


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True, cut: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    ids_sha256 is over the decimal ids joined by one space, decoded_sha256
    over the decoded bytes; ``decoded`` is those bytes. Without ``cut`` a text
    is one unit, for patterns that match across a space within a word.
    """
    ranks = read_ranks(ranks_path)
    own = docs.select(F.col(id_col).alias("doc_id"), C.text_bytes(text_col).alias("text"))
    encoded = replay_units(block_units(own, max(16, BUCKETS * own.rdd.getNumPartitions()), cut), ranks, pattern)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = docs.sparkSession.sparkContext.broadcast(table)
    id_type = own.schema["doc_id"].dataType.simpleString()
    fields = [f"doc_id {id_type}", "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] * with_ids + ["decoded binary"] * with_text

    def work(texts: pa.Table, packed: list[dict]) -> pa.Table:
        forms = UnitForms(packed, shared.value)
        n, shas, back, ids_out, text_out = [], [], [], [], []
        for data in texts.column("codes"):
            codes = W.unpack(data.as_py())
            each = codes.tolist()
            whole = b"".join(map(forms.decoded.__getitem__, each))
            n.append(int(forms.size[codes].sum()))
            shas.append(hashlib.sha256(b" ".join(map(forms.decimal.__getitem__, each))).hexdigest())
            back.append(hashlib.sha256(whole).hexdigest())
            if with_ids:
                ids_out.append(forms.ids(codes).astype(np.int32))
            if with_text:
                text_out.append(whole)
        columns = [texts.column("doc_id"), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns, names = [*columns, C.lists_of(ids_out, pa.int32())], [*names, "ids"]
        if with_text:
            columns, names = [*columns, pa.array(text_out, pa.binary())], [*names, "decoded"]
        return pa.table(columns, names=names)

    return W.with_words(block_texts(own, cut), encoded, work, ", ".join(fields))
