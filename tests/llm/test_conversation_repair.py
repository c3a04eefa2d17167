import hashlib
import heapq
import random
import zlib

import pytest

from tracelens.llm import conversation_repair as V
from tracelens.llm import role_glr as G

SCHEMA = "conv_id long, turn long, role string, text string, n long, part int, seg int, audit string, first string"
SPACE = " \t\n\r\x0b\x0c"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _cheapest(rows):
    """Shortest path over (rows read, place in ``(s?(ua)+)?``); a path's length is (cost, audit)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, place = heapq.heappop(heap)
        if (i, place) in seen:
            continue
        seen.add((i, place))
        if i == len(rows) and place in (0, 3):
            return cost, audit
        for t in "ua":
            if (place, t) in MOVES:
                heapq.heappush(heap, (cost + 3, audit + "I", i, MOVES[place, t]))
        if i < len(rows):
            initial, state = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, place))
            for t in "sua" if state != G.BAD else "":
                if (place, t) in MOVES and (t == initial or t in "ua"):
                    price = 3 * (state == G.CUT) + 3 * (t != initial)
                    heapq.heappush(heap, (cost + price, audit + ("K" if t == initial else "R"), i + 1, MOVES[place, t]))


def _damaged(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(x for x in text if x not in ".!?")
        if k != 0:
            out += [(c, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def _repaired(rows):
    """One conversation: its summary and its repaired rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    states, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        body, fault = text.strip(SPACE), None
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif body[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        states.append((role[:1], {None: G.FINE, "truncated": G.CUT}.get(fault, G.BAD)))
    turns = {r[1] for r in rows if r[1] is not None}
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(states, states[1:]))
    cost, audit = _cheapest(states)
    size = len(audit) - audit.count("D")
    left, out = iter(rows), []
    for action in audit:
        row = None if action == "I" else next(left)
        if action == "D":
            continue
        made = ["user", "assistant"][(len(out) - size % 2) % 2]
        out.append((action, row[2] if action == "K" else made, row[3] if row else ""))
    text = "\n".join(f"{r}:{t}" for _, r, t in out)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, 1, 2, "x", "y") for r in rows], SCHEMA).repartition(parts)


def _check(spark, rows, damage=True):
    frame = _frame(spark, rows)
    faulty = V.damaged(frame) if damage else frame
    after = _damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got = V.repair(faulty, all_ids=frame, count_col="n" if damage else None)
    summary = {r.conv_id: tuple(r)[1:] for r in got.summary.collect()}
    want = {c: _repaired([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert summary == {c: x[0] for c, x in want.items()}
    assert got.summary.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    repaired = V.repaired_rows(got.segments).collect()
    assert {(r.conv_id, r.place): (r.action, r.role, r.text) for r in repaired} == {(c, k): x for c, (_, rows_) in want.items() for k, x in enumerate(rows_)}


def _random_rows(rng, n, conversations):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "uploader"]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Really?  ", "é", "one.\ntwo?", "x" * 300 + "."]
    return [(rng.choice(conversations), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_equals_brute_force(spark):
    rng = random.Random(4)
    _check(spark, _random_rows(rng, 600, [None, *range(60)]))
    _check(spark, [(c, t, r, x) for c in range(50) for t, (r, x) in enumerate([("system", "Be kind."), ("user", "Hi!"), ("assistant", "Hello."), ("user", "Bye?"), ("assistant", "Bye.")])])


@pytest.mark.parametrize("segment, chars", [(1, 10**6), (3, 10**6), (64, 20)])
def test_segments_of_hot_conversations(spark, monkeypatch, segment, chars):
    """A third of all rows in one conversation, cut at every place; its rows lie in many tasks."""
    monkeypatch.setattr(V, "SEGMENT", segment)
    monkeypatch.setattr(V, "SEGMENT_CHARS", chars)
    rng = random.Random(segment)
    hot = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", ""]) + rng.choice(["", f" {t}."])) for t in range(150)] + [(5, None, "user", "a.")] * 30
    _check(spark, _random_rows(rng, 200, [None, *range(10)]) + hot, damage=segment != 3)


def test_empty_and_all_dropped(spark):
    assert V.repair(_frame(spark, []), keep_rows=False).summary.count() == 0
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    _check(spark, [(*gone, "user", "Hi."), (-1, 1, "user", "x")])
    assert [r.audit for r in V.repair(_frame(spark, [(1, 1, "user", "Hi.")]), keep_rows=False).summary.collect()] == ["KI"]


def test_parser_equals_shortest_paths():
    parser = G.RoleParser()
    rng = random.Random(1)
    for _ in range(800):
        rows = [(rng.choice("suuaax "), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(0, 9))]
        want = _cheapest(rows)
        assert parser.solve(tuple(rows)) == want
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(3))
        table = parser.stretch(rows[: cuts[0]])
        for a, b in zip(cuts, [*cuts[1:], len(rows)]):
            table = parser.compose(table, parser.stretch(rows[a:b]))
        assert parser.best(table) == want


def test_other_grammars():
    """A right-recursive grammar has growing stacks; an ambiguous one is followed on all ways."""
    with pytest.raises(ValueError, match="grow"):
        G.RoleParser((("C", ""), ("C", "uaC")))
    ambiguous = G.RoleParser((("C", ""), ("C", "P"), ("C", "sP"), ("P", "X"), ("P", "Y"), ("P", "PX"), ("P", "PY"), ("X", "ua"), ("Y", "ua")))
    plain = G.RoleParser()
    rng = random.Random(2)
    for _ in range(200):
        rows = tuple((rng.choice("sua"), rng.choice([0, 1, 2])) for _ in range(rng.randint(0, 7)))
        assert ambiguous.solve(rows) == plain.solve(rows)
