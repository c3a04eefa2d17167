import random
import re

import numpy as np
import pyarrow as pa

from tracelens.llm import licenses as L
from tracelens.llm import pii as P

from .cases import TEXTS, empty, frame

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_scan(text, templates):
    w, places, blocks = WORD.findall((text or "").encode().lower()), set(), set()
    for t in templates:
        if t.phrase:
            places |= {(p, t.label) for p in range(len(w) - len(t.words) + 1) if w[p : p + len(t.words)] == t.words}
            continue
        width, at = t.block(), 0
        while w:
            common = len(set(t.words) & set(w[at : at + width]))
            if common >= t.needed():
                blocks.add((t.label, at, min(at + width, len(w)), round(common / len(set(t.words)), 9)))
            if at + width >= len(w):
                break
            at += width // 2
    return len(w), places, blocks


def _found(n, places, blocks):
    assert len(places) == len({(p["start"], p["label"]) for p in places})
    return n, {(p["start"], p["label"]) for p in places}, {(b["label"], b["start"], b["end"], round(b["containment"], 9)) for b in blocks}


def test_join_finds_every_block():
    for seed in range(200):
        rng = random.Random(seed)
        word = list("abcdefghijk")
        own = [L._template(" ".join(rng.choice(word) for _ in range(rng.randint(1, 30))), f"t{i}", rng.choice([0.5, 0.8, 1.0]), False) for i in range(4)]
        own += [L._template(" ".join(rng.choice(word[:4]) for _ in range(rng.randint(1, 5))), f"p{i}", 1.0, True) for i in range(3)]
        texts = [" ".join(rng.choice(word + ["z"] * 20) for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(5)]
        scanner = L.Scanner(own, {w: rng.randint(0, 9) for t in own for w in t.words})
        got = scanner.scan(pa.array([t.encode() for t in texts], pa.binary()))
        assert [_found(int(n), p, b) for n, p, b in zip(*got, strict=True)] == [brute_scan(t, own) for t in texts]


def test_scan_edges(spark):
    mit = L.TEMPLATES[0][0].split()
    changed = " ".join(w for i, w in enumerate(mit) if i % 9)  # a ninth of the words is gone
    rows = [*TEXTS, (20, "x " * 300 + changed), (21, "Under the MIT License, under the mit license"), (22, "CC-BY/NC")]
    own = [L._template(t, label, s, False) for t, label, s in L.TEMPLATES] + [L._template(t, label, 1.0, True) for t, label in L.PHRASES]
    got = L.license_scan(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), *map(str, map(sorted, _found(r.n_words, r.places, r.blocks)[1:]))) for r in got) == sorted((str(i), *map(str, map(sorted, brute_scan(t, own)[1:]))) for i, t in rows)
    by_id = {r.doc_id: r for r in got}
    assert {b.label for b in by_id[20].blocks} == {"mit"} and [p.start for p in by_id[21].places] == [0, 4] and len(by_id[22].places) == 1
    assert L.license_scan(empty(spark)).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(d) * 2 - 9 * (int(d) > 4) if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def brute_pii(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if _passes(k, m.group())]


def test_base_spans(spark):
    rng = random.Random(5)
    texts = ["é a@b.c é 1.2.3.4 255.255.255.256 010.2.3.4 x", "a@b.c_d@e.f.g@h.i..@j.k", "+1 (882) 555-3834. call +12 ", "4111111111111111 4111-1111-1111-1111, 4111 1111 1111 1112"]
    texts += ["".join(rng.choice("a1.@+- (5)4é_\n") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += ["1" * 1000, "a" * 2000, "1." * 600, "a@b" + ".c" * 500, "1 " * 700, "4111111111111111x " * 300, "+1" + " " * 1000]
    rows = [*TEXTS, *((100 + k, t) for k, t in enumerate(texts))]
    got = [(r.doc_id, [tuple(s) for s in r.base]) for r in P.find_pii(frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(str((i, brute_pii(t))) for i, t in rows)
    assert P.find_pii(empty(spark)).count() == 0


def test_long_runs_neither_stall_nor_overflow(spark):
    rows = [(1, "1" * 200_000), (2, "a" * 200_000), (3, "a@b" + ".c" * 60_000), (4, "+1" + " " * 200_000), (5, "1 " * 20_000)]
    assert {r.doc_id: len(r.base) for r in P.find_pii(frame(spark, rows)).collect()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(k, f"note {k} contact email u{k}@ex.com please") for k in range(30)]
    rows += [(100, "blah contact email joe7[at]ex.com please"), (101, "room 12 on floor 3 please")]
    got = {r.doc_id: [tuple(s) for s in r.found] for r in P.find_pii(frame(spark, rows)).collect()}
    assert got[100] == [("email", 19, 33)] and got[101] == []
    assert all(got[k] == brute_pii(t) for k, t in rows[:30])


def _brute_patterns(text, start, end):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    l2, l1 = (["^", "^"] + words(text[:start]))[-2:]
    return [f"{l2} {l1} _", f"{l1} _ {(words(text[end:]) + ['$'])[0]}"]


def test_contexts_come_from_the_text_itself(spark):
    rng = random.Random(8)
    word = ["ipv4", "address", "addr", "443", "a@b.c", "1.2.3.4", "x7[at]y", "(no", "4111111111111111", "+1 (882) 555-3834", "end.", "é1", "-" * 100, "\n", "日本"]
    rows = [(k, " ".join(rng.choice(word) for _ in range(rng.choice([1, 5, 30, 150])))) for k in range(120)]
    rows += [(200, "use ipv4 address 1.2.3.4 443"), (201, "use ipv4 address 1.2.3[.]4 443"), (202, "@"), (203, "a@b" + ".c" * 300 + " tail")]
    got = {r.doc_id: r.entities for r in P.entities(frame(spark, rows)).collect()}
    for k, text in rows:
        assert [list(e.patterns) for e in got[k]] == [_brute_patterns(text, e.start, e.end) for e in got[k]]
    assert {tuple(e.patterns) for k in (200, 201) for e in got[k] if e.found.startswith("1.2")} == {("ipv4 address _", "address _ 443")}


def test_finds_back_further_contexts(spark):
    rows = [(k, f"note {k} contact email u{k}@ex.com please") for k in range(100)]
    rows += [(200 + k, f"blah contact email joe{k}[at]ex.com please") for k in range(20)]
    rows += [(300 + k, f"just reach mailbox joe{k}[at]ex.com today") for k in range(20)]  # no seed stands here
    rows += [(400, "or reach mailbox zed9[at]ex.com today"), (401, "room mailbox 12 on floor 3 today")]
    got = {r.doc_id: [tuple(s) for s in r.found] for r in P.find_pii(frame(spark, rows)).collect()}
    assert got[400] == [("email", 17, 31)] and got[401] == [] and all(len(got[300 + k]) == 1 for k in range(20))
    first = {r.doc_id: [tuple(s) for s in r.found] for r in P.find_pii(frame(spark, rows), rounds=1).collect()}
    assert first[200] and not first[300] and not first[400]


def test_card_digits_are_checked_by_luhn(spark):
    rng = np.random.default_rng(6)
    rows = [(k, "".join(map(str, rng.integers(0, 10, rng.integers(14, 21))))) for k in range(300)]
    got = {r.doc_id: len(r.base) for r in P.find_pii(frame(spark, rows)).collect()}
    assert got == {k: len(brute_pii(t)) for k, t in rows} and 0 < sum(got.values()) < 100


def test_overlaps_with_seeds_of_any_kind(spark):
    """Tokens beside, inside and across base spans, many in one text: none that overlaps one is an entity of its own."""
    rng = random.Random(8)
    parts = ["a@b.co", "x9", "10.0.0.1", "+49 170 1234567", "4111 1111 1111 1111", "(a@b.co,c@d.io)", "7", "word", "id:10.0.0.1/24", "+1-202-555-0143x"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 400))) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in P.entities(docs).collect():
        seeds = [(e.start, e.end) for e in r.entities if e.kind]
        tokens = {(e.start, e.end) for e in r.entities if not e.kind}
        want = set()
        for m in re.finditer(r"(?<!\S)(?=\S*[0-9@])\S+", texts[r.doc_id]):
            body = m.group().lstrip("".join(c for c in set(m.group()) if not c.isalnum() and c not in "+@"))
            start = m.end() - len(body)
            end = start + len(body.rstrip("".join(c for c in set(body) if not c.isalnum())))
            if start < end and not any(a < end and start < b for a, b in seeds):
                want.add((start, end))
        assert tokens == want and len(seeds) == sum(len(getattr(r, k)) for k in P.KINDS)
