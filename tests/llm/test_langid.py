import zlib
from collections import Counter

import numpy as np

from jobfacts.llm import langid
from jobfacts.llm.common import table
from tests.llm.helpers import clashing, docs

SF = "/root/testdata/sf0.01"


def plain_ngrams(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        out.update(padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1) if padded[i:i + n] != " ")
    return out


def decoded(code):
    return "".join(chr(x) for x in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if x)


def test_ngrams_against_plain_version():
    for text in ["", "12 !", "a", "Hello, wörld-wide  WEB 3x", "漢字 kana", "no end", " x"]:
        values, counts = np.unique(langid.ngrams(text), return_counts=True)
        assert {decoded(int(v)): int(n) for v, n in zip(values, counts)} == dict(plain_ngrams(text))


def test_distance_by_hand():
    profiles = langid.Profiles({"xx": [10, 20, 30], "yy": [30, 20, 40]})
    assert profiles.distances(np.array([20, 30])).tolist() == [(1 + 1) / 6, (1 + 1) / 6]
    assert profiles.distances(np.array([10, 99])).tolist() == [3 / 6, 6 / 6]


def test_learned_profiles_against_plain_counts(spark):
    rows = [(1, "abc abd", "p"), (2, "xyz", "q"), (3, "abc", "p"), (4, "zzz", None), (5, None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn(df, length=5)
    want = plain_ngrams("abc abd abc")
    first = sorted(want, key=lambda g: (-want[g], [0] * (3 - len(g)) + [ord(c) for c in g]))[:5]
    at = profiles.languages.index("p")
    assert profiles.languages == ["p", "q"]
    assert [decoded(int(g)) for g in profiles.sorted[at][np.argsort(profiles.ranks[at])]] == first


def test_held_out_accuracy(spark):
    df = table(spark, SF, "documents")
    got = {r.doc_id: r for r in langid.langid_query(df).collect()}
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == len(truth) and {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the and of"), (4, "the and of"), (None, "the of and")]
    profiles = langid.Profiles({"en": langid.ranked(langid.ngrams("the and of the and"), 400).tolist()})
    got = langid.identify(clashing(docs(spark, rows)), profiles).select("doc.doc_id", "lang_pred", "score").collect()
    assert sorted((repr(r.doc_id), r.lang_pred) for r in got) == sorted([("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("4", "en"), ("None", "en")])
    assert all(0 <= r.score <= 1 for r in got)
    nothing = langid.learn(docs(spark, []))
    assert nothing.predict("the and of") == ("und", 0.0)
    assert langid.langid_query(docs(spark, [])).collect() == []
