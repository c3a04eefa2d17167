import random
from itertools import permutations

import duckdb
import pytest

from tracelens.llm import queries
from tracelens.llm import text_tries as T

from .cases import SCHEMA, TEXTS, empty, frame

SPACE = " \t\n\r\x0b\x0c"


def _fails(text):
    words = text.translate(str.maketrans(SPACE, " " * 6)).split(" ")
    words = [w for w in words if w]
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""
    return found + ("D" if set(text) & set("#$%&*|") else "")


def _audit(rows, labels):
    """Every document walks through every order by itself."""
    docs = []
    for i, part, text in rows:
        text = text or ""
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in rows)
        good = i is not None and any(j == i and q == 1 for j, q, _ in labels)
        toxic = i is not None and any(j == i and x == 1 for j, _, x in labels)
        docs.append((part or "", _fails(text) + ("E" if copy else ""), good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                before = len([d for d in mine if f in d[1]]) - len(gone)
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, k + 1] = [len(left), len(gone), before, sum(d[1] == f for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def _got(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (5, 1, None), (None, 1, 1), (12, 1, 0), (99, 1, 1)]


def test_cases_equal_brute_force(spark):
    docs = frame(spark)
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    assert _got(T.filter_audit(docs, _labels(spark, LABELS))) == _audit(rows, LABELS)
    assert T.filter_audit(empty(spark), _labels(spark, LABELS)).count() == 0
    assert _got(T.filter_audit(docs, _labels(spark, []))) == _audit(rows, [])


@pytest.mark.parametrize("seed", [1, 2])
def test_small_ranges_and_tries(spark, monkeypatch, seed):
    """Shared prefixes of every length, hot copies, ties, flushes within a task."""
    monkeypatch.setattr(T, "RANGE_ROWS", 3)
    monkeypatch.setattr(T, "RANGE_BYTES", 300)
    monkeypatch.setattr(T, "PREFIX", 2)
    monkeypatch.setattr(T, "LONGER", 2)
    monkeypatch.setattr(T, "TASK_BYTES", 400)
    rng = random.Random(seed)
    stems = ["", "aa", "aab", "Été # " * 30, "long shared beginning " * 40]
    texts = [rng.choice(stems) + "".join(rng.choice("ab Z") for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None, ""]
    rows = [(rng.choice([None, *range(80)]), rng.choice([None, "", "en", "fr"]), rng.choice(texts)) for _ in range(400)] + [(k, "en", texts[0]) for k in range(200)]
    marks = [(rng.randint(0, 90), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, p, None, None, "x", "y", 0, None, None, 1) for i, p, t in rows], SCHEMA).repartition(5)
    assert len(T.common_prefixes(docs.select("doc_id", "lang", T.C.text_bytes().alias("text")))) > 3
    assert _got(T.filter_audit(docs, _labels(spark, marks))) == _audit(rows, marks)


def test_trie_holds_whole_texts():
    rng = random.Random(3)
    texts = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(500)}
    trie = T.TextTrie()
    for t in [*texts, *texts]:
        trie.terminal(t).held = t
    assert [t for t, _ in trie.terminals()] == sorted(texts)
    assert all(node.held == t for t, node in trie.terminals())
    assert trie.size < sum(map(len, texts))


def test_sql_equals_brute_force(spark):
    import pandas as pd

    con = duckdb.connect()
    rows = [(r.doc_id, r.lang, r.text) for r in frame(spark).collect() if "\0" not in (r.text or "")]
    con.register("documents", pd.DataFrame([(i, p, t) for i, p, t in rows], columns=["doc_id", "lang", "text"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame([x for x in LABELS if x[0] is not None], columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    got = {tuple(r[:3]): tuple(r[3:]) for r in con.execute(queries.ORACLE["op11_filter_audit"]).fetchall()}
    assert got == _audit(rows, LABELS)
    assert len(TEXTS) > len(rows) > 5
