import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from tracelens.llm import merge_replay as M
from tracelens.llm.queries import tokenizer_path

from .cases import TEXTS, empty, frame

ODD = ["Don't <|endoftext|>x", "é É ́x İ ΣΣ", "ﬁ ½ 123 4.5 ١٢", "I'LL we'VE 'S's", "a\x0bb\x0cc\rd  \n\n  e", "\x1c\x1f\x85 nbsp ​z", "😀😀 a😀b", "  　", "a" * 999, " " * 700 + "x", "=-" * 800]


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_equals_the_library(spark, file):
    rows = [(k, t) for k, (_, t) in enumerate(TEXTS)] + [(100 + k, t) for k, t in enumerate(ODD)]
    path = tokenizer_path(file)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=M.read_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in M.encode_and_decode(frame(spark, rows), path, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        assert (got[i].ids, got[i].n_tokens, bytes(got[i].decoded)) == (ids, len(ids), (t or "").encode())
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_edges(spark):
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    got = M.encode_and_decode(frame(spark), path, public_tokenizers.PATTERN, with_ids=False, with_text=False)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in got.collect()) == sorted((str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in TEXTS)
    assert M.encode_and_decode(empty(spark), path, public_tokenizers.PATTERN).count() == 0


def _one_by_one(word, ranks):
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if found is None:
            return [ranks[p] for p in parts]
        parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]


def test_replay_equals_word_by_word(monkeypatch):
    """Random vocabularies, whose merges need not come in the order of their parts."""
    for seed in range(120):
        rng = random.Random(seed)
        tokens = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(0, 60))}
        order = [bytes([b]) for b in range(256)] + sorted(tokens, key=lambda _: rng.random())
        ranks = {t: i for i, t in enumerate(order)}
        table = M.MergeTable(ranks)
        words = list({bytes(rng.choice(b"abcab") for _ in range(rng.choice([1, 3, 5, 9, 14, 40]))) for _ in range(100)}) + [b"", b"a" * 50, b"a" * 301]
        monkeypatch.setattr(M, "VECTOR", rng.choice([1, 4, 64]))
        ids, sizes = M.replay(words, table)
        at = 0
        for word, n in zip(words, sizes.tolist(), strict=True):
            assert ids[at : at + n].tolist() == _one_by_one(word, ranks), (seed, word)
            at += n


def test_bytes_without_token_are_an_error():
    with pytest.raises(ValueError, match="no token"):
        M.MergeTable({b"a": 0})


def test_split_in_stretches():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in [t or "" for _, t in TEXTS if t is None or len(t) < 5000] + ODD + ["a  \n b   c\t\t  d 12  !!  "]:
        for most in (1, 2, 3, 7, 50, 10**6):
            assert [w for part in M.split(text, pattern, most) for w in part] == pattern.findall(text)


def test_units_part_no_match():
    import pyarrow as pa

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(5)
    signs = ["a", "é", "x1", "\u00a0", " ", " ", "  ", "\n", "\u3000", "\x85", "日", ".", "'s", "\x1f", "😀", "¿"]
    texts = [t or "" for _, t in TEXTS] + ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for cut in (True, False):
        found, offsets = M.units(pa.array([t.encode() for t in texts], pa.large_binary())[3:], cut)
        pieces = [u.decode() for u in found.to_pylist()]
        for text, a, b in zip(texts[3:], offsets[:-1], offsets[1:], strict=True):
            assert "".join(pieces[a:b]) == text
            assert [w for u in pieces[a:b] for w in pattern.findall(u)] == pattern.findall(text)
            assert cut or b - a == (text != "")


def test_replay_in_parts(monkeypatch):
    ranks = M.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    table = M.MergeTable(ranks)
    words = [w.encode() for w in " ".join(t or "" for _, t in TEXTS[:8]).split()[:400]]
    whole = M.encode_distinct(words, table)
    monkeypatch.setattr(M, "REPLAY_BYTES", 50)
    assert M.encode_distinct(words, table) == whole
