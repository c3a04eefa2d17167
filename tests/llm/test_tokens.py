import hashlib
import json
import random
import struct

import pytest
from tokenizers import Tokenizer, models

from tracelens.llm import bpe
from tracelens.llm import token_counts as T
from tracelens.llm import word_blocks as W
from tracelens.llm.queries import tokenizer_path

from .cases import TEXTS, empty, frame

ODD = ["Don't <|endoftext|>x <|STARTOFTEXT|> <|startoftext|>", "é É ́x İ ΣΣ ΑΣ ς", "ﬁ ½ 123 4.5 ١٢", "I'LL we'VE 'S's", "a\x0bb\x0cc\rd", "​﻿ z", "😀😀 a😀b", "  　"]


def _library(texts):
    t = Tokenizer.from_file(tokenizer_path())
    out = []
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out.append((ids, back, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return out


def test_bpe_equals_the_library(spark, monkeypatch):
    rows = [(k, t) for k, (_, t) in enumerate(TEXTS)] + [(100 + k, t) for k, t in enumerate(ODD)]
    got = {r.doc_id: (r.ids, r.decoded, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_and_decode(frame(spark, rows), tokenizer_path(), carry=("block", "codes")).collect()}
    assert got == {i: x for (i, _), x in zip(rows, _library([t for _, t in rows]), strict=True)}
    assert bpe.encode_and_decode(frame(spark, rows), tokenizer_path(), carry=("block", "codes")).columns[:3] == ["doc_id", "block", "codes"]
    assert bpe.encode_and_decode(empty(spark), tokenizer_path()).count() == 0


def test_a_worker_that_decodes_holds_no_tokenizer():
    with open(tokenizer_path(), encoding="utf-8") as file:
        content = file.read()
    assert bpe._encoder(content) is bpe._encoder(content) and bpe._built
    bpe.drop_encoder()
    assert not bpe._built and bpe._encoder(content).encode("a b").ids


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError, match="decoder of its own"):
        bpe.encode_and_decode(frame(spark), tokenizer_path("byte_bpe_50k.json"))
    with open(tokenizer_path(), encoding="utf-8") as file:
        spec = json.load(file)
    spaced = spec | {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
    with pytest.raises(ValueError, match="word by word"):
        bpe.check_supported(json.dumps(spaced))
    greedy = spec | {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}
    with pytest.raises(ValueError, match="added tokens"):
        bpe.check_supported(json.dumps(greedy))
    bpe.check_supported(json.dumps(spec))


def test_small_blocks_give_the_same(spark):
    docs = frame(spark).select("doc_id", "text")
    own = docs.selectExpr("doc_id", "coalesce(cast(text as binary), cast('' as binary)) as text")
    words = {}
    for r in W.block_words(own, 16, most=64).collect():
        for code, w in zip(W.unpack(r.codes).tolist(), W.unpack_words(r.words), strict=True):
            words[r.block, code] = w
    got = sorted(b" ".join(words[r.block, c] for c in W.unpack(r.codes).tolist()) for r in W.block_texts(own, most=64).collect())
    assert got == sorted(b" ".join((t or "").encode().split()) for _, t in TEXTS)


def test_changed_input_is_an_error(spark):
    one = spark.createDataFrame([(1, bytearray(b"a b"))], "doc_id long, text binary").coalesce(1)
    two = spark.createDataFrame([(1, bytearray(b"a c"))], "doc_id long, text binary").coalesce(1)
    with pytest.raises(Exception, match="stage it as a table"):
        W.with_words(W.block_texts(one), W.block_words(two, 16), lambda texts, words: texts.select(["doc_id"]), "doc_id long").collect()


def _word_piece(begin, go_on, words):
    vocabulary = {"[UNK]": 0}
    for piece in [*begin, *("##" + g for g in go_on)]:
        vocabulary.setdefault(piece, len(vocabulary))
    t = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**9))
    found = [t.encode(w).tokens for w in words]
    return [-1 if x == ["[UNK]"] else len(x) for x in found]


def test_automaton_equals_greedy_word_pieces():
    for seed in range(150):
        rng = random.Random(seed)
        piece = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))  # noqa: B023, E731
        begin, go_on = list({piece() for _ in range(12)}), list({piece() for _ in range(8)})
        words = ["".join(rng.choice("abcd" if rng.random() < 0.05 else "abc") for _ in range(rng.randint(1, 14))) for _ in range(50)]
        automaton = T.LongestMatch(begin, go_on)
        assert [automaton.count(w) for w in words] == _word_piece(begin, go_on, words)


def test_token_counts_edges(spark):
    begin, go_on = T.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    got = [(r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in T.token_counts(frame(spark), begin, go_on).collect()]
    want = []
    for i, t in TEXTS:
        words = [w.decode() for w in (t or "").encode().split()]
        n = _word_piece(begin, go_on, words)
        want.append((i, len(words), sum(map(abs, n)), sum(x < 0 for x in n)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert T.token_counts(empty(spark), begin, go_on).count() == 0
