import random
import re
from collections import Counter

from jobfacts.llm import quality
from tests.llm.helpers import clashing, docs, duck, rows_of, sorted_rows, words

EDGE = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "a b c d e a b c d e"), (6, "x " * 40), (7, "#*$ %&| <> plain"),
        (8, "same line\nsame line\n \nsame line\nother"), (9, "é ü 漢字 of the and to in is it for on as"), (9, "é ü 漢字 of the and to in is it for on as"),
        (None, "the of and to in that for on with as by be " * 3), (10, "SHOUTING LOUD WORDS ARE HERE AND THERE FOR ALL OF US NOW"),
        (11, "a b c d e f g h i j k l m n o p"), (12, "word " * 3 + "... \n• x\n- y\n* z\n")]


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def rows(spark=None):
    rng = random.Random(4)
    out = list(EDGE)
    for i in range(60):
        t = words(rng, rng.randrange(80), 6 if i % 3 else 500)
        out.append((100 + i, t.replace(" w1 ", "\n").replace("w2", "The")))
    return out


def test_counts_and_verdicts_against_brute_force_and_sql(spark):
    data = rows()
    got = quality.quality_query(docs(spark, data))
    for r, (i, t) in zip(sorted(got.collect(), key=lambda r: repr(r.doc_id)), sorted(data, key=lambda x: repr(x[0]))):
        n, chars, symbols, dup, rep = brute(t)
        assert (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (i, n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.base_failed and r.kept)
    sql = duck({"documents": data}, {"documents": "doc_id BIGINT, text VARCHAR"}, quality.oracle_sql())
    assert sorted_rows(rows_of(got)) == sorted_rows(sql)


def test_clashing_columns_pass_through(spark):
    df = clashing(docs(spark, rows()))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    plain = {r.doc_id for r in quality.quality_query(docs(spark, rows())).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == plain and plain


def test_empty_table(spark):
    assert quality.quality_query(docs(spark, [])).collect() == []


def test_rules_are_a_parameter(spark):
    rule = quality.Rule("short", "word_chars", "n_words", high=400)
    got = quality.apply_rules(docs(spark, [(1, "alphabet " * 1 + "b c d e f g h i j k"), (2, "longwords " * 4 + "1 2 3 4 5 6 7 otherlongwords")]), rules=(rule,))
    assert {r.doc.doc_id: r.failed for r in got.collect()} == {1: [], 2: ["short"]}
