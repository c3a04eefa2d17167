import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tracelens.llm import decontaminate as D
from tracelens.llm.fm_index import FMIndex, suffix_array

from .cases import TEXTS, empty, frame

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts, items, window):
    windows = {}
    for name, text in items:
        w = WORD.findall((text or "").encode().lower())
        for s in range(max(len(w) - window + 1, 1) if w else 0):
            windows.setdefault(tuple(w[s : s + window]), set()).add(name)
    out = []
    for text in texts:
        w, hit, names = WORD.findall((text or "").encode().lower()), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if (k := tuple(w[s : s + size])) in windows:
                    hit.update(range(s, s + size))
                    names |= windows[k]
        out.append((len(w), sorted(hit), sorted(str(n) for n in names if n is not None)))
    return out


def test_suffix_order_counts_and_places():
    rng = np.random.default_rng(0)
    for _ in range(40):
        text = np.append(rng.integers(0, 4, rng.integers(1, 80)), 0)

        def key(i, text=text):
            end = i + int(np.flatnonzero(text[i:] == 0)[0])
            return [int(x) + len(text) for x in text[i:end]] + [end]

        order = sorted(range(len(text)), key=key)
        assert suffix_array(text).tolist() == order
        index = FMIndex(text, 3, rate=4)
        assert index.locate(np.arange(len(text))).tolist() == order
        phrases = rng.integers(1, 4, (20, 3))
        low, high = index.count(phrases, np.full(20, 3))
        for p, a, b in zip(phrases, low, high, strict=True):
            places = [i for i in range(len(text) - 2) if (text[i : i + 3] == p).all()]
            assert max(0, b - a) == len(places)
            if places:
                assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_long_sequences_sort_without_packing(monkeypatch):
    import tracelens.llm.fm_index as M

    text = np.append(np.random.default_rng(1).integers(0, 3, 300), 0)
    packed = suffix_array(text)
    monkeypatch.setattr(M, "PACKED", 10)
    assert (suffix_array(text) == packed).all()


def _rows(found):
    return {r.doc_id: (r.n_words, [w for s in r.spans for w in range(s.start, s.end)], list(r["items"])) for r in found.collect()}


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    for limit in (1 << 21, 12):  # the benchmark in one block, and in many
        monkeypatch.setattr(D, "ITEM_WORDS", limit)
        word = ["a", "B", "c", "dd", "é"]
        texts = [" ".join(rng.choice(word) for _ in range(rng.randint(0, 60))) for _ in range(40)]
        items = [(i, "; ".join(rng.choice(word) for _ in range(rng.randint(0, 8)))) for i in range(6)] + [(None, "a B c"), (3, None), (3, "dd dd"), (9, "")]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        bench = spark.createDataFrame(items, "item_id long, text string")
        want = brute(texts, items, 4)
        assert _rows(D.contamination(docs, bench, window=4)) == dict(enumerate(want))
        clean = {r.doc_id: r.text for r in D.remove_contamination(docs, bench, window=4).collect()}
        assert not any(h for _, h, _ in brute(clean.values(), items, 4))
        assert all(clean[i] == t for i, t in enumerate(texts) if not want[i][1])


def test_edges(spark):
    items = [(1, " ".join((TEXTS[7][1]).split()[500:520])), (2, "Nothing of THIS"), (7, "the ALPHA of"), (8, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = _rows(D.contamination(docs, bench, window=10))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == {i: w for (i, _), w in zip(rows, brute([t for _, t in rows], items, 10), strict=True)}
    assert got[4] == got[5] == (0, [], [])
    none = bench.limit(0)
    assert all(not r.spans and not r["items"] for r in D.contamination(docs, none).collect())
    assert D.remove_contamination(docs, none).orderBy("doc_id").collect() == docs.orderBy("doc_id").collect()
    assert D.contamination(empty(spark), bench).count() == D.remove_contamination(empty(spark), bench).count() == 0
    assert D.remove_contamination(frame(spark), bench).where(F.col("text").isNull()).count() == 1


def test_cut_spans_keeps_what_is_between():
    assert D.cut_spans(b"One, two three -- four. Five", [(1, 3)]) == b"One, \n -- four. Five"
    assert pa.array([D.cut_spans(b"a b", [(0, 2)])]).to_pylist() == [b"\n"]
