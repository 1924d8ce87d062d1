import random
import time

import numpy as np
import pytest

from jobfacts.llm import licenses, licensetexts
from tests.llm.helpers import clashing, docs, words

TABLE = licensetexts.templates()
INDEX = licenses.Index(TABLE)


def text_of(name):
    return " ".join(TABLE[name].replace("[", "").replace("]", "").split())


def found(text):
    return [(x[0], x[1]) for x in licenses.scan_words(licenses.words_of_text(text), INDEX)]


@pytest.mark.parametrize("text, want", [
    ("Released under the BSD License.", "bsd"), ("Released under the ISC License.", "isc"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", "cc-by-3.0"),
    ("Licensed under the Apache License, Version 1.1", "apache-1.1"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT License.", "mit"), ("released under the MIT No Attribution licence", "mit-0"),
    ("Distributed under the BSD 3-Clause License", "bsd-3-clause"), ("Available under the Simplified BSD License", "bsd-2-clause"),
    ("This program is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl-2.1"),
    ("This project is licensed under the Mozilla Public License 2.0", "mpl-2.0"), ("All rights reserved.", "all-rights-reserved"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("SPDX-License-Identifier: EPL-2.0", "epl-2.0"), ("Licensed under the GPLv3", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License.", "gpl")])
def test_names_and_versions(text, want):
    assert [x[0] for x in found(text)] == [want]


@pytest.mark.parametrize("text", [
    "Licensed under the Apache License, Version 7.0", "This work is licensed under the GNU General Public License, version 9.",
    "Released under the Foo License.", "Licensed under CC BY-XX 4.0.", "This work is licensed under the GNU GPL v7", "the license of the work", "",
    "Licensed under the Mozilla Public License, Version 3.0"])
def test_an_unknown_deciding_word_gives_no_licence(text):
    assert found(text) == []


def test_whole_texts_of_variants_are_told_apart():
    for name in licensetexts.TEXTS:
        got = licenses.scan_words(licenses.words_of_text("before it " + text_of(name) + " and after"), INDEX)
        licence, _, part = name.partition(" ")
        assert [(x[0], x[1], x[2], x[7]) for x in got] == [(licence, part, 2, True)], name
    assert found(text_of("gpl-3.0 header").replace("3", "4")) == []
    assert found(text_of("gpl-2.0 header").replace("Foundation; either", "Foundation, either")) == [("gpl-2.0", "header")]


def test_the_winnowed_index_is_used():
    assert len(INDEX.grams) > 150
    own = licenses.words_of_text(text_of("mit-0 text"))
    assert INDEX.hits(licenses.same(own))


def test_edited_texts_are_found():
    rng = random.Random(4)
    longs = [n for n in licensetexts.TEXTS if len(text_of(n).split()) > 60 and "header" not in n]
    right = 0
    for _ in range(120):
        name = rng.choice(longs)
        own = text_of(name).split()
        t = INDEX.templates[sorted(TABLE).index(name)]
        own = licenses._plain_words(" ".join(own))
        free = np.flatnonzero(t.fixed == 0).tolist()
        for p in sorted(rng.sample(free, len(own) // 15), reverse=True):
            own[p:p + rng.randrange(2)] = rng.choice([[], ["zzz"]])
        before = words(rng, rng.randrange(40)).split()
        got = licenses.scan_words(licenses.words_of_text(" ".join(before + own + words(rng, 20).split())), INDEX)
        licence = name.partition(" ")[0]
        # the opening words of a text that was edited elsewhere may be what is left of it
        right += any(x[0] == licence and abs(x[2] - len(before)) <= 3 and abs(x[3] - len(before) - len(own)) <= 3 for x in got)
        assert all(x[0] in (licence, "all-rights-reserved") or x[1] == "opening" for x in got), (name, got)
    assert right >= 110


def brute(text):
    """All templates aligned over the whole text, on every diagonal, again and again around what
    was found; then the best of what overlaps."""
    w = licenses.same(licenses.words_of_text(text))
    all_of = []
    for i, t in enumerate(INDEX.templates):
        todo = [(0, len(w))]
        while todo:
            a, b = todo.pop()
            if b - a < licenses.MIN_COVERAGE * len(t.words):
                continue
            matches, score, start, end = licenses.align(t.words, w[a:b], -len(t.words), b - a, t.fixed)
            if matches >= licenses.MIN_COVERAGE * len(t.words):
                if not licenses._other_version(t, w, a + end):
                    all_of.append(licenses.Match(i, a + start, a + end, matches, score))
                todo += [(a, a + start), (a + end, b)]
    return [(INDEX.templates[m.template].license, m.start, m.end) for m in licenses.best_of(all_of)]


def test_against_brute_force_with_all_templates():
    rng = random.Random(7)
    notices = [n for n in TABLE if "notice" in n or "sentence" in n or n == "all-rights-reserved"]
    for _ in range(12):
        parts = []
        for _ in range(4):
            own = text_of(rng.choice(notices)).split()
            if rng.random() < 0.3:
                own[0] = "zzz"
            parts.append(" ".join(words(rng, rng.randrange(2, 9)).split() + own))
        text = " \n".join(parts) + " end"
        got = [(x[0], x[2], x[3]) for x in licenses.scan_words(licenses.words_of_text(text), INDEX)]
        assert got == brute(text), text


def test_alignment_against_full_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        t, w = rng.integers(0, 4, rng.integers(1, 8)), rng.integers(0, 4, rng.integers(0, 12))
        best = [0] * (len(w) + 1)
        for i in range(1, len(t) + 1):
            new = [best[0] - 1]
            for j in range(1, len(w) + 1):
                new.append(max(best[j - 1] + (1 if t[i - 1] == w[j - 1] else -1), best[j] - 1, new[-1] - 1))
            best = new
        assert licenses.align(t, w, -len(t), len(w))[1] == max(best)


def test_deciding_words_stay_together():
    t = licenses.template("x", "a b [c d] e")
    for text, want in (("a b c d e", 5), ("a zz c d e", 4), ("a b c zz d e", -1), ("a b c e", -1), ("zz a b zz c d e", 5)):
        assert licenses.align(t.words, licenses.same(licenses._hash(text.split())), -6, 8, t.fixed)[0] == want, text


def test_winnowing_keeps_a_hash_of_each_window():
    rng = np.random.default_rng(6)
    for n in range(20):
        h = rng.integers(0, 5, n).astype(np.uint64)
        kept = licenses.winnow(h)
        for i in range(n - licenses.WINNOW + 1):
            own = [k for k in kept if i <= k < i + licenses.WINNOW]
            assert own and min(h[own]) == min(h[i:i + licenses.WINNOW])


def test_query(spark):
    rows = [(1, "code\nAll Rights Reserved!\nmore"), (2, None), (3, ""), (4, "..."), (None, "Released under the MIT License."), (1, "twice all rights reserved")]
    got = licenses.license_query(clashing(docs(spark, rows))).collect()
    assert sorted((repr(r.doc_id), r.license, r.start_word, r.end_word, r.exact) for r in got) == [
        ("1", "all-rights-reserved", 1, 4, True), ("1", "all-rights-reserved", 1, 4, True), ("None", "mit", 0, 5, True)]
    assert licenses.license_query(docs(spark, [])).collect() == []


def test_long_texts():
    for unit, n in (("released under the mit license ", 5000), ("the license ", 50000), ("licensed under the apache license version 2 0 ", 5000)):
        at = time.perf_counter()
        got = licenses.scan_words(licenses.words_of_text(unit * n), INDEX)
        assert len(got) == (n if "under" in unit else 0) and time.perf_counter() - at < 30, unit


def test_templates_without_words_are_refused():
    with pytest.raises(ValueError):
        licenses.Index({"x": "..."})
