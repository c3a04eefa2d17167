import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tracelens.llm import exact_dedup as X
from tracelens.llm import simhash as S
from tracelens.llm.components import connected_components

from .cases import TEXTS, empty, frame


def _filter(values, low=0, quotients=16, bits=4):
    return X.CountingQuotientFilter.build(np.array(values, np.uint64), np.ones(len(values), np.int64), low, quotients, bits)


def test_quotient_filter_counts_and_merges_losslessly():
    rng = np.random.default_rng(0)
    for _ in range(50):
        parts = [rng.integers(0, 256, rng.integers(0, 60)) for _ in range(4)]
        whole = _filter(parts[0])
        for p in parts[1:]:
            other = _filter(p)
            whole = whole.merge(X.CountingQuotientFilter.from_columns(other.to_columns(), 0, 16, 4))
        want = Counter(np.concatenate(parts).tolist())
        assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist(), strict=True)) == want
        assert all(whole.count(v) == want.get(v, 0) for v in range(256))


def test_exact_dedup_edges(spark):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            now = i == keep and not kept
            kept |= now
            want[i, keep, len(ids), now, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in X.exact_dedup(frame(spark)).collect()) == want
    assert Counter((r.doc_id, r.text or "") for r in X.drop_copies(frame(spark)).collect()) == Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())
    assert X.drop_copies(frame(spark)).columns == frame(spark).columns
    assert X.exact_dedup(empty(spark)).count() == X.drop_copies(empty(spark)).count() == 0


def test_fingerprint_definition():
    def plain(text):
        w = text.lower().split()
        if not w:
            return 0
        sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for _, t in TEXTS:
        t = (t or "").encode()[:3000]
        assert S.fingerprint(t) == plain(t)


def test_ring_keys_meet_every_link():
    rng = np.random.default_rng(2)
    for distance in (0, 1, 2, 3, 4, 5):
        sets = S.ring_keys(distance)
        for _ in range(400):
            a = int(rng.integers(0, 1 << 63))
            b = a
            for bit in rng.choice(64, distance, replace=False):
                b ^= 1 << int(bit)
            same = lambda f: all((a >> at ^ b >> at) & ((1 << w) - 1) == 0 for at, w in f)  # noqa: B023, E731
            assert any(same(f) for f in sets)
            assert S.near(np.array([a], np.uint64), np.array([b], np.uint64), distance).all()


def test_near_is_the_hamming_distance():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    b = a.copy()
    for k in range(500):
        for bit in rng.choice(64, rng.integers(0, 7), replace=False):
            b[k] ^= np.uint64(1 << int(bit))
    assert (S.near(a, b, 3) == (np.bitwise_count(a ^ b) <= 3)).all()


def _components(values, distance):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_links_of_a_hot_key_are_whole(spark, monkeypatch):
    """One large ball of fingerprints, dealt out over cells, and scattered ones."""
    monkeypatch.setattr(S, "CELL", 16)
    rng = np.random.default_rng(4)
    center = int(rng.integers(1 << 62))
    values = {center ^ sum(1 << int(b) for b in rng.choice(14, rng.integers(0, 6), replace=False)) for _ in range(150)}
    values |= {int(v) for v in rng.integers(-(1 << 62), 1 << 62, 50)}
    values = sorted(values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.component for r in connected_components(S.links(fps, 3)).collect()}
    want = _components(values, 3)
    sizes = Counter(want.values())
    assert got == {v: c for v, c in want.items() if sizes[c] > 1}


def test_keys_of_fingerprints_are_not_broadcast(spark, tmp_path):
    """24 rows a fingerprint: a table of fingerprints below the threshold must not bring its keys to the driver."""
    spark.range(3000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    found = S.links(spark.read.parquet(f"{tmp_path}/fps"), 3)
    found.collect()
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 100), (5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 100}


def test_simhash_edges(spark):
    prints = [S.fingerprint((t or "").encode()) for _, t in TEXTS]
    of = _components(sorted(set(prints)), 3)
    names = defaultdict(lambda: None)
    for (i, _), p in zip(TEXTS, prints, strict=True):
        if i is not None:
            names[of[p]] = i if names[of[p]] is None else min(names[of[p]], i)
    want = Counter((i, f"{p:016x}", names[of[p]]) for (i, _), p in zip(TEXTS, prints, strict=True))
    assert Counter(tuple(r) for r in S.simhash_groups(frame(spark)).collect()) == want
    stays = Counter(r.doc_id for r in S.drop_near_copies(frame(spark)).collect())
    assert stays == Counter(i for (i, _), p in zip(TEXTS, prints, strict=True) if i == names[of[p]])
    assert S.simhash_groups(empty(spark)).count() == S.drop_near_copies(empty(spark)).count() == 0


def test_helper_columns_clash_with_none(spark):
    """Columns with every name that the operators use themselves stay, in any case."""
    names = ["own_sha", "GONE_ID", "gone_sha", "gone_key", "one", "filter_at", "filter_row", "filter_words", "__own_sha", "__nth", "tag", "fp"]
    rows = [(i, t, *[f"{n}{k}" for n in names]) for k, (i, t) in enumerate([(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, "something else"), (None, None), (None, "")])]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in names)]))
    for drop, kept in ((X.drop_copies, [2, 3, None]), (S.drop_near_copies, [1, 3, None, None])):
        got = drop(docs)
        assert got.columns == docs.columns
        left = sorted(got.collect(), key=str)
        assert sorted((r.doc_id for r in left), key=str) == sorted(kept, key=str)
        assert {tuple(r) for r in left} <= set(rows)


def test_key_filter_loses_no_key(spark, monkeypatch):
    from tracelens.llm import key_filter as K

    monkeypatch.setattr(K, "LEAST_BITS", 1 << 13)
    rng = np.random.default_rng(6)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, 900)
    others = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    rows = spark.createDataFrame([(int(k), True) for k in keys] + [(int(k), False) for k in others] + [(None, False)], "filter_at long, member boolean")
    made = K.KeyFilter(spark.createDataFrame([(int(k),) for k in keys], "k long"))
    maybe, rest = made.split(rows, rows["filter_at"])
    assert made.bits == 1 << 14 and maybe.columns == rows.columns
    assert maybe.where("member").count() == 900 and maybe.where("not member").count() < 400
    assert maybe.count() + rest.count() == 3901
    monkeypatch.setattr(K, "MOST_BITS", 1 << 10)
    maybe, rest = K.KeyFilter(spark.createDataFrame([(int(k),) for k in keys], "k long")).split(rows, rows["filter_at"])
    assert (maybe.count(), rest.count()) == (3901, 0)
