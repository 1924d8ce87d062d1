import random

import numpy as np

from jobfacts.llm import toxicity
from jobfacts.llm.common import table
from tests.llm.helpers import clashing, docs

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(1)
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(3, 14))) for _ in range(25)})
    terms = [toxicity.Term(t, rng.random() < 0.4, 1.0) for t in texts]
    automaton = toxicity.Automaton(terms)
    for _ in range(3000):
        base = rng.choice(texts) if rng.random() < 0.7 else "".join(rng.choice("abcx") for _ in range(rng.randrange(1, 14)))
        word = list(base)
        for _ in range(rng.randrange(3)):
            p = rng.randrange(len(word) + 1)
            word[p:p + rng.randrange(2)] = rng.choice(["", "a", "b", "x"])
        word = "".join(word)
        near = [min((distance(word[:n], t.text) for n in range(len(word) + 1)), default=99) if t.stem else distance(word, t.text) for t in terms]
        fits = [d for d, t in zip(near, terms) if d <= t.edits]
        got = automaton.match(word)
        assert (got is not None) == bool(fits), word
        if got:
            assert got[1] == min(fits), word


def test_quotation_and_address_are_told_apart():
    model = toxicity.Model(toxicity.Automaton([toxicity.Term("rotten", False, 2.0)]))
    assert [(h["quoted"], h["directed"], h["edits"]) for h in model.spans('He said "rotten" once.')] == [(True, False, 0)]
    assert [(h["quoted"], h["directed"], h["edits"]) for h in model.spans('the "other" day it was rottn fruit')] == [(False, False, 1)]
    assert [(h["quoted"], h["directed"], h["edits"]) for h in model.spans("You are r0tten through and through")] == [(False, True, 1)]
    assert model.spans("a rotating wheel") == []


def test_held_out_documents(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r for r in toxicity.toxicity_query(documents, labels).collect()}
    held = [r for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [got[r.doc_id].score for r in held if not r.toxic], [got[r.doc_id].score for r in held if r.toxic]
    wins = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert wins >= 0.95
    assert np.mean([s >= 0.5 for s in bad]) >= 0.85 and np.mean([s < 0.5 for s in good]) >= 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_edges(spark):
    rows = [(i, "plain words in here " + ("badword" if i % 2 else "nothing")) for i in range(40)] + [(100, None), (101, ""), (None, "badword"), (1, "twice")]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(500, 1, 1), (None, 1, 1), (100, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_query(clashing(docs(spark, rows)), labels).collect()
    assert len(got) == len(rows)
    assert {r.predicted for r in got if r.doc_id is None} == {1} and all(r.score < 0.5 for r in got if r.doc_id in (100, 101))
    one = toxicity.toxicity_query(docs(spark, rows), labels.where("toxic = 1")).collect()
    assert {r.score for r in one} == {0.0}
    assert toxicity.toxicity_query(docs(spark, []), labels).collect() == []


def test_hits_report_spans(spark):
    model = toxicity.Model(toxicity.Automaton([toxicity.Term("rotten", False, 2.0)]))
    got = toxicity.hits(docs(spark, [(1, "so rotten"), (2, None), (3, "fine")]), model).collect()
    assert [(r.doc_id, r.start, r.end, r.term) for r in got] == [(1, 3, 9, "rotten")]


def test_sample_takes_a_document_once(spark):
    """One document that repeats far beyond the sample size neither fills nor crowds it."""
    rows = [(i, f"text {i}") for i in range(60)] + [(7, f"copy {k}") for k in range(3000)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(7, 1, 1)] * 500, "doc_id long, quality int, toxic int")
    got = toxicity._sample(docs(spark, rows), labels, 20).collect()
    assert sorted(r.toxic for r in got) == [0] * 20 + [1] * 20 and len({r.text for r in got}) == 40
    assert len(toxicity._sample(docs(spark, rows), labels, 100).collect()) == 60
    plan = toxicity._sample(docs(spark, rows), labels, 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2 and "Window" not in plan


def test_very_long_text(spark):
    model = toxicity.Model(toxicity.Automaton([toxicity.Term("rotten", False, 2.0)]))
    text = "some word or other " * 100_000 + "rotten"
    assert [h["start"] for h in model.spans(text)] == [len(text) - 6]
