import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from tracelens.llm import common as C
from tracelens.llm import language_id as I
from tracelens.llm import lm
from tracelens.llm import quality as Q

from .cases import TEXTS, empty, frame

SF = "/root/testdata/sf0.01"


def _auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    good = y.sum()
    return (rank[y == 1].sum() - good * (good + 1) / 2) / (good * (len(y) - good))


def test_quality_separates_held_out_rows(spark):
    docs, labels = C.table(spark, SF, "documents"), C.table(spark, SF, "labels")
    got = Q.score_quality(docs, Q.fit_quality(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    aside = got[got.held_out]
    assert _auc(aside.score.to_numpy(), aside.quality.to_numpy()) > 0.95
    assert aside.predicted[aside.quality == 1].mean() > 0.97
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_word_vectors_are_sums_of_neighbours(spark):
    texts = ["a B a", None, "", "b", "C! d"]
    table = Q.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    places, signs = Q.index_vectors()
    want = np.zeros((Q.ROWS, Q.DIM))
    for t in texts:
        for rows, _ in Q.streams(pa.array([(t or "").encode()], pa.binary())):
            for a, b in zip(rows, rows[1:], strict=False):
                np.add.at(want, (a, places[b]), signs[b])
                np.add.at(want, (b, places[a]), signs[a])
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(table, want / np.where(norm > 0, norm, 1), atol=1e-6)


def test_pooling_is_a_mean(spark):
    table = np.random.default_rng(0).normal(size=(Q.ROWS, Q.DIM)).astype(np.float32)
    texts = [(t or "").encode() for _, t in TEXTS]
    whole = Q.pooled(pa.array(texts, pa.binary()), table)
    for t, x in zip(texts, whole, strict=True):
        for k, (rows, _) in enumerate(Q.streams(pa.array([t], pa.binary()))):
            part = x[k * (Q.DIM + 2) : (k + 1) * (Q.DIM + 2)]
            assert np.allclose(part[: Q.DIM], table[rows].mean(axis=0) if len(rows) else 0, atol=2e-3)  # sums in single precision
            assert np.isclose(part[-2], math.log1p(len(rows))) and np.isclose(part[-1], (rows[1:] == rows[:-1]).sum() / max(1, len(rows)))


def test_quality_edges(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, none)).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 1), (99, 0), (11, 1), (8, 0)], "doc_id long, quality int")
    model = Q.fit_quality(docs, odd)
    got = Q.score_quality(docs, model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    model = Q.fit_quality(empty(spark), odd)
    assert Q.score_quality(empty(spark), model).count() == Q.keep_good(empty(spark), model).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    net = Q.fit_network(x[:2000], (rng.random(2000) < p[:2000]).astype(float))
    assert np.abs(net.score(x[2000:]) - p[2000:]).mean() < 0.08


def test_parsing_counts_longest_matches(monkeypatch):
    monkeypatch.setattr(I, "SEGMENT", 10**6)
    for seed in range(120):
        rng = random.Random(seed)
        learned = {k: bytes(rng.choice(b"ab c") for _ in range(rng.randint(1, 30))) for k in "xyz"[: rng.randint(1, 3)]}
        texts = [bytes(rng.choice(b"ab cd") for _ in range(rng.randint(1, 40))) for _ in range(7)]
        parser = I.Parser(learned)
        for t, row in zip(texts, parser.phrases(texts), strict=True):
            for k, n in zip(parser.languages, row, strict=True):
                at = want = 0
                while at < len(t):
                    size = 0
                    while at + size < len(t) and t[at : at + size + 1] in learned[k]:
                        size += 1
                    at, want = at + max(size, 1), want + 1
                assert n == want


def test_matches_cross_segments():
    rng = random.Random(3)
    learned = {k: bytes(rng.choice(b"ab c") for _ in range(3000)) for k in "xy"}
    sizes = [0, 1, I.SEGMENT - 1, I.SEGMENT, I.SEGMENT + 1, 2 * I.SEGMENT, 5 * I.SEGMENT + 17]
    texts = [(learned["x"][700:] + learned["y"]) * 3] + [bytes(rng.choice(b"ab cd") for _ in range(n)) for n in sizes]
    parser = I.Parser(learned)
    for t, row in zip(texts, parser.phrases(texts), strict=True):
        for k, n in zip(parser.languages, row, strict=True):
            at = want = 0
            while at < len(t):
                size = 1
                while at + size < len(t) and t[at : at + size + 1] in learned[k]:
                    size += 1
                at, want = at + size, want + 1
            assert n == want


def test_languages(spark):
    docs = C.table(spark, SF, "documents")
    got = I.identify_languages(docs).toPandas().merge(docs.toPandas()[["doc_id", "lang"]], on="doc_id")
    aside = got[got.held_out]
    assert len(aside) > 100 and (aside.lang_pred == aside.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_edges(spark):
    got = {r.doc_id: (r.lang_pred, r.score) for r in I.identify_languages(frame(spark)).collect()}
    assert got[4] == got[5] == got[6] == got[9] == ("und", 0.0) and got[1][0] == "en"
    unlabelled = frame(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in I.identify_languages(unlabelled).collect()} == {"und"}
    signs = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ ٣ _"), (3, "½ ª"), (4, "ʰ"), (5, "語")], "doc_id long, text string")
    assert [(r.doc_id, r.lang_pred) for r in I.identify(signs, {"en": b" the of ", "fr": b" le la "}).orderBy("doc_id").collect() if r.lang_pred == "und"] == [(1, "und"), (2, "und")]
    assert I.identify_languages(empty(spark)).count() == 0
    long = spark.createDataFrame([(1, "a", "x" * 200_000)], "doc_id long, lang string, text string")
    assert len(I.references(long)["a"]) == 200_002  # a language's only row, though longer than the bound


def _tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_base_scores_and_counts(spark):
    counts = collections.Counter()
    for i, t in TEXTS:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(_tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(_tokens(t)), sum(counts[w] > 0 for w in _tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in _tokens(t)), 5)) for i, t in TEXTS)
    got = lm.score_texts(frame(spark)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.score_texts(empty(spark)).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    words = [f"w{i}".encode() for i in range(300)]
    counts = lm.Counts(tokens=5000, distinct=900, words=words, word_counts=sorted(rng.integers(2, 40, 300).tolist(), reverse=True), ends=50)
    w = lm.first_weights(counts)
    w.classes[:] = rng.normal(0, 0.3, w.classes.shape)
    w.slots[:] = rng.normal(0, 0.3, w.slots.shape)
    before = np.array([[5], [lm.FREQUENT + 3], [lm._START]])
    ids = np.arange(301)
    each = lm.Batch(ids, np.repeat(before, 301, axis=1)).log10(w)
    other = lm.Batch(np.array([lm.FREQUENT]), before).log10(w)
    assert np.isclose((10**each).sum() + 10 ** other[0], 1, atol=1e-4)


def test_gradient_counts_match_plain_sums():
    rng = np.random.default_rng(3)
    counts = lm.Counts(2000, 400, [f"w{i}".encode() for i in range(100)], [9] * 100, 20)
    w = lm.first_weights(counts)
    ids = np.where(rng.random(200) < 0.3, lm.FREQUENT + rng.integers(0, 50, 200), rng.integers(0, 101, 200))
    batch = lm.Batch(ids, rng.integers(0, 101, (3, 200)))
    zero = lambda: lm.Weights(np.zeros(0), np.zeros(0), np.zeros_like(w.classes), np.zeros_like(w.slots))
    seen, due = zero(), zero()
    batch.add_expected(w, seen, due)
    want = np.zeros_like(w.classes)
    p = batch.class_probabilities(w)
    for rows in batch.class_rows:
        np.add.at(want, rows, p)
    assert np.allclose(due.classes, want, atol=1e-4) and seen.classes.sum() == 800 and np.isclose(due.slots.sum(), seen.slots.sum(), atol=1e-2)


def test_gradient_sums_groups_of_any_size_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    w = lm.first_weights(lm.Counts(9000, 400, [f"w{i}".encode() for i in range(300)], [9] * 300, 20))
    before = np.array([np.repeat(np.arange(200), 40), np.where(np.arange(8000) < 3000, 7, rng.integers(0, 301, 8000)), np.full(8000, 3)])
    batch = lm.Batch(rng.integers(0, 301, 8000), before)
    zero = lambda: lm.Weights(np.zeros(0), np.zeros(0), np.zeros_like(w.classes), np.zeros_like(w.slots))
    seen, due, calls = zero(), zero(), []
    take = np.take
    monkeypatch.setattr(np, "take", lambda *a, **b: (calls.append(1), take(*a, **b))[1])
    batch.add_expected(w, seen, due)
    monkeypatch.undo()
    want, p = np.zeros_like(w.classes), batch.class_probabilities(w)
    for rows in batch.class_rows:
        np.add.at(want, rows, p)
    assert np.allclose(due.classes, want, rtol=1e-4, atol=1e-3) and seen.classes.sum() == 32000
    assert len(calls) < 400  # 518 when each large group was taken by itself


def test_training_helps(spark):
    docs = C.table(spark, SF, "documents")
    before, after = (lm.score_texts(docs, updates=k).toPandas() for k in (0, lm.UPDATES))
    assert after[after.held_out].score.sum() > before[before.held_out].score.sum() > before[before.held_out].base_score.sum()


def _others(counts, buckets=5):
    """Counts with numbers for all words but the frequent ones, and each word's number."""
    ranked = sorted(((-n, w) for w, n in counts.items()))
    words, tokens, place, number = np.zeros((buckets, lm.LEVELS), np.int64), np.zeros(lm.LEVELS, np.int64), collections.Counter(), {}
    for n, w in ranked:
        words[zlib.crc32(w) % buckets, lm._level(np.array(-n))] += 1
        tokens[lm._level(np.array(-n))] -= n
    best = ranked[: lm.FREQUENT - 1]
    others = lm.other_words(words, tokens, best)
    for k, (n, w) in enumerate(ranked):
        bucket = zlib.crc32(w) % buckets
        number[w] = k + 1 if k < len(best) else lm.FREQUENT + int(others.numbers(bucket, np.array([-n]), np.array([place[bucket]]))[0])
        place[bucket] += 1
    total = sum(counts.values())
    return lm.Counts(total + 9, len(counts) + 1, [w for _, w in best], [-n for n, _ in best], 9, others), number


def test_every_word_has_a_way_of_its_own():
    """Words past the frequent ones: numbers of their own, and with the unknown all sum to one in any context."""
    rng = np.random.default_rng(4)
    for many, most in ((lm.FREQUENT + 3000, 900), (lm.FREQUENT, 3), (7, 5), (0, 1)):
        counts, number = _others({f"w{i}".encode(): int(n) for i, n in enumerate(rng.integers(1, most + 1, many))})
        unknown = max([lm.FREQUENT - 1, *number.values()]) + 1 if many >= lm.FREQUENT else lm.FREQUENT
        assert len(set(number.values())) == many and counts.others.tree.starts[-1] == unknown - lm.FREQUENT + 1
        w = lm.first_weights(counts)
        for table in (w.classes, w.slots, w.nodes):
            table[:] = rng.normal(0, 0.5, table.shape)
        ids = np.array([0, *number.values(), unknown])
        for before in ([5, unknown, lm._START], [unknown - 1, 1, 0]):
            each = lm.Batch(ids, np.repeat(np.array([before]).T, len(ids), axis=1)).log10(w)
            assert np.isclose((10**each).sum(), 1, atol=1e-4)


def test_rare_words_depend_on_what_stands_before():
    """Two words of equal count, both past the frequent ones, each after one of two others."""
    counts, number = _others({f"w{i}".encode(): 2 for i in range(lm.FREQUENT + 500)})
    x, y = lm.FREQUENT + 40, lm.FREQUENT + 300
    ids, before = np.tile([x, y], 200), np.array([np.tile([3, 4], 200)] * 3)
    w = lm.first_weights(counts)
    zero = lambda *k: lm.Weights(np.zeros(0), np.zeros(0), *(np.zeros((n, m), np.float32) for n, m in zip((lm.ROWS, lm.ROWS, lm.NODE_ROWS), k, strict=True)))
    seen, due, seen_too, by_bias = zero(lm.CLASSES, lm.SLOTS, lm.WAYS), zero(lm.CLASSES, lm.SLOTS, lm.WAYS), zero(lm.CLASSES, lm.SLOTS, lm.WAYS), zero(1, len(w.slot_bias), len(w.tree.bias))
    batch = lm.Batch(ids, before)
    batch.add_expected(w, seen, due)
    batch.add_observed(w, seen_too, by_bias)
    want = lm.expected_by_bias(w, by_bias)  # the first update's way, to the same counts
    for name in ("classes", "slots", "nodes"):
        assert np.allclose(getattr(due, name), getattr(want, name), atol=1e-2) and (getattr(seen, name) == getattr(seen_too, name)).all()
    for name in ("classes", "nodes"):
        table = getattr(w, name)
        table += lm.STEP * np.log1p((getattr(seen, name) - getattr(due, name)) / (getattr(due, name) + lm.SMOOTH))
    w.factors.clear()
    right, wrong = (lm.Batch(np.array([x]), np.array([[k]] * 3)).log10(w)[0] for k in (3, 4))
    assert right > wrong + 0.3


def test_numbers_of_words_in_texts(spark):
    """Texts of more words than the frequent ones: each word its own number, rare ones too."""
    rows = [(i, " ".join(f"w{j}" for j in range(i, 3200, 1 + i % 3))) for i in range(40)]
    encoded, counts = lm.encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    number = collections.defaultdict(set)
    for r in encoded.collect():
        for w, k in zip(dict(rows)[r.doc_id].split(), lm.W.unpack(r.ids).tolist(), strict=False):
            number[w].add(k)
    learned = {w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split()}
    assert {len(k) for k in number.values()} == {1}
    assert len({min(number[w]) for w in learned}) == len(learned) > lm.FREQUENT
    assert counts.others.tree.starts[-1] == len(learned) - (lm.FREQUENT - 1) + 1
