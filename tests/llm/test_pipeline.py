"""run() against a brute-force version of every stage but the trained one, whose decisions are taken from its own scores."""

import hashlib
import random
import struct

import corpus_pipeline as P
from tokenizers import Tokenizer

from tracelens.llm import quality as Q
from tracelens.llm import simhash as S
from tracelens.llm.queries import tokenizer_path

from .test_decontaminate import WORD, brute
from .test_dedup import _components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus(spark, folder):
    rng = random.Random(8)
    word = [f"{a}{b}" for a in ("tal", "mo", "ri", "ven", "os", "ke") for b in ("na", "ster", "lu", "do", "", "ing")]
    prose = lambda n: " ".join(rng.choice(word) for _ in range(n)).capitalize() + "."
    items = [(k, prose(14)) for k in range(4)]
    rows = [(k, prose(rng.randint(30, 200))) for k in range(60)]
    rows += [(100 + k, " ".join(w.upper() + "!!" for w in prose(60).split())) for k in range(20)]
    rows += [(200 + k, rows[3][1]) for k in range(5)] + [(300, rows[4][1]), (301, rows[4][1] + " ")]  # exact copies, and one with the same words
    rows += [(400 + k, prose(40) + " " + items[k][1] + " " + prose(40)) for k in range(4)]
    rows += [(500, None), (501, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], COLUMNS).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 0 if 100 <= i < 120 else 1) for i, _ in rows if i < 120]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(rows), items


def test_pipeline_against_brute_force(spark, tmp_dir):
    texts, items = _corpus(spark, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    model = Q.fit_quality(docs, spark.read.parquet(f"{tmp_dir}/labels.parquet"))
    left = {r.doc_id: texts[r.doc_id] for r in Q.score_quality(docs, model).collect() if r.predicted}
    assert not any(100 <= i < 120 for i in left) and sum(i < 60 for i in left) > 55  # junk goes, clean documents stay
    best = {}
    for i, t in left.items():
        best[t or ""] = max(i, best.get(t or "", i))
    left = {i: texts[i] for i in best.values()}
    prints = {i: S.fingerprint((t or "").encode()) for i, t in left.items()}
    of = _components(sorted(set(prints.values())), 3)
    first = {}
    for i, p in prints.items():
        first[of[p]] = min(i, first.get(of[p], i))
    left = {i: texts[i] for i in first.values()}
    hits = dict(zip(left, brute(left.values(), items, 10), strict=True))
    assert sum(bool(h) for _, h, _ in hits.values()) >= 3
    words = {}
    for i, t in left.items():
        w, hit = WORD.findall((t or "").encode().lower()), set(hits[i][1])
        words[i] = [x.decode() for k, x in enumerate(w) if k not in hit]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in P.run(spark, tmp_dir).collect()}
    assert set(got) == set(left)
    for i, r in got.items():
        assert (r.lang, r.source, r.n_tokens) == ("en", "s", len(r.ids))
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()
        back = tokenizer.decode(r.ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert [w for w in back.replace(" ", "").split("</w>") if w.isalnum()] == words[i]  # what the cut has left
        if not hits[i][1]:
            assert r.ids == tokenizer.encode(left[i] or "", add_special_tokens=False).ids


def test_stages_keep_the_columns(spark, tmp_dir):
    _corpus(spark, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in docs.schema.fields]
        assert stage(spark, docs.limit(0), tmp_dir).count() == 0
    cut = {r.doc_id: r for r in P.clean(spark, docs, tmp_dir).collect()}
    assert all(r.n_chars == len(r.text) for r in cut.values() if r.text is not None) and cut[500].text is None
