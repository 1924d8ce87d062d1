import random
import struct

import pytest
import sentencepiece

from jobfacts.llm import sentencepieces as sp
from tests.llm.helpers import clashing, docs

TEXTS = ["", " ", "Hello  world\n\tfoo ", " lead", "naïve x 漢字 \U0001F600 zz", "<s> a</s> <0x0A> <unk>", "ﬁ ½ Ａ é", "a\n\n\nb    c", " " * 40 + "x",
         "a" * 300 + " bbbbbbbbb 11111111", "\u0000​﻿", "The and of the in " * 50]


def random_texts(n=400):
    rng = random.Random(2)
    return ["".join(rng.choice("abcdefghij  \n.,the é漢 ") for _ in range(rng.randrange(80))) for _ in range(n)]


def field(number, kind, value):
    tag = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, (number << 3 | kind) >> 7])
    return tag + (bytes([len(value) & 127 | 128, len(value) >> 7]) + value if kind == 2 else value)


def unigram_model(fallback: bool) -> bytes:
    """A model written by hand: pieces with scores, no training."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    rng = random.Random(9)
    pieces += [(p, -1.0 - rng.random() * 9, 1) for p in ["▁", "a", "b", "c", "d", "▁a", "▁b", "ab", "bc", "abc", "▁ab", "cd", "dd", "▁abcd", "da", "é"]]
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    trainer = field(3, 0, b"\x01") + field(35, 0, b"\x01" if fallback else b"\x00")
    normal = field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")
    return body + field(2, 2, trainer) + field(3, 2, normal)


def test_bpe_model_against_the_library():
    pieces, library = sp.load(sp.default_model()), sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    for t in TEXTS + random_texts():
        ids = pieces.encode(t).tolist()
        assert ids == library.encode(t)
        assert pieces.decode(ids) == library.decode(ids) == t


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_model_against_the_library(fallback):
    model = unigram_model(fallback)
    pieces, library = sp.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("abcd  éxy") for _ in range(rng.randrange(30)))
        assert pieces.encode(t).tolist() == library.encode(t), t


def test_shortest_path_against_all_paths():
    pieces = sp.Pieces(unigram_model(True))

    def best(word):
        if not word:
            return 0.0
        return min((best(word[n:]) - pieces.scores[pieces.ids[word[:n]]] for n in range(1, len(word) + 1) if word[:n] in pieces.ids), default=1e9)

    for word in ("▁abcd", "abcdda", "ddddab", "bcabcd"):
        assert -sum(pieces.scores[i] for i in pieces.shortest(word)) == pytest.approx(best(word))


def test_rules_rewrite_the_text():
    pieces = sp.Pieces(unigram_model(True), {"x": "ab", "xx": "c"})
    assert pieces.normalise("xxx a") == "▁cab▁a"


def test_new_words_are_composed_together(monkeypatch):
    pieces, library = sp.load(sp.default_model()), sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    rng, alone = random.Random(4), []
    texts = [" ".join("".join(rng.choice("abdehinorstäé漢,") for _ in range(rng.randrange(1, 15))) for _ in range(40)) for _ in range(60)]
    texts += ["", "x" * 65 + " a", *TEXTS]
    monkeypatch.setattr(sp, "WORDS", 1000)
    shortest = pieces.shortest
    monkeypatch.setattr(pieces, "shortest", lambda word: alone.append(word) or shortest(word))
    ids, ends = pieces.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t) for t in texts]
    assert all(len(w) > sp.SHORT for w in alone)


def test_texts_of_a_batch_encoded_in_parts(spark, monkeypatch):
    data = [(i, t) for i, t in enumerate(TEXTS + random_texts(30))]
    want = {r.doc_id: r.ids for r in sp.sentencepiece_query(docs(spark, data).coalesce(1)).collect()}
    monkeypatch.setattr(sp, "TEXTS", 50)
    assert {r.doc_id: r.ids for r in sp.sentencepiece_query(docs(spark, data).coalesce(1)).collect()} == want


def test_query_round_trip_and_edges(spark):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(98, None), (99, "▁ lost"), (99, "▁ lost"), (None, "x")]
    rows = sp.sentencepiece_query(clashing(docs(spark, data)))
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    got = rows.collect()
    assert sorted((repr(r.doc_id), r.ids, r.n_tokens) for r in got) == sorted(
        (repr(i), library.encode(t or ""), len(library.encode(t or ""))) for i, t in data)
    assert {r.doc_id for r in got if not r.round_trip} == {99}
    back = sp.decode(rows, sp.load(sp.default_model())).collect()
    assert sorted((repr(r.doc_id), r.decoded) for r in back) == sorted((repr(i), (t or "").replace("▁", " ")) for i, t in data)
    assert sp.sentencepiece_query(docs(spark, [])).collect() == []
