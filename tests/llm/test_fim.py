import hashlib
import random
import re

import numpy as np

from jobfacts.llm import fim
from tests.llm.helpers import clashing, docs, duck, rows_of, sorted_rows


def units(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def sample():
    rng = random.Random(4)
    pieces = ["a", "\n", "bb ", "é", "\n\n", "\r", "😀", "long line " * 30]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(150)]
    return rows + [(500, None), (501, ""), (502, "one line"), (503, "has <S> in it\nx"), (504, "<\n<P\nS>\n<"), (505, "\n" * 3000),
                   (506, "word " * 60000 + "\n" + "x\n" * 40000), (3, "again\nand again\n"), (None, "no id\nat all\n")]


def brute(i, text):
    text = text or ""
    h = [int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    u = units(text)
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form, out = "plain", text
    if text and not any(m in text for m in ("<P>", "<S>", "<M>")):
        form = "spm" if h[3] % 100 < 50 else "psm"
        out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    cut = form != "plain"
    return (i, form, len(mid) if cut else None, n, sha(out), len(pre) if cut else None, sha(text))


def test_index_finds_every_boundary():
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choice(["a", "\n", "é", "😀" * 30, "\n\n", "x" * 300]) for _ in range(rng.randrange(120)))
        ends = fim.boundaries(text)
        assert [text[a:b] for a, b in zip(ends, ends[1:])] == units(text)
        epsilon = rng.choice([1, 4, 48])
        index = fim.fit(ends, epsilon)
        assert [index.offset(r) for r in range(len(ends))] == list(ends)
        assert np.abs(index.residuals).max() <= epsilon + 1


def test_boundaries_across_pieces():
    text = ("é" * 1000 + "\n") * 2500  # more than two pieces
    assert list(fim.boundaries(text)) == [1001 * i for i in range(2501)]
    assert len(fim.fit(fim.boundaries(text)).ranks) == 1  # equal lines lie on one segment


def test_steps_need_several_segments():
    ends = fim.boundaries("x" * 9 + "\n" + ("y" * 99 + "\n") * 50 + "z\n" * 500)
    index = fim.fit(ends, 8)
    assert 2 <= len(index.ranks) <= 4 and [index.offset(r) for r in range(len(ends))] == list(ends)


def test_query_against_brute_force_and_sql(spark):
    rows = sample()
    got = rows_of(fim.fim_query(clashing(docs(spark, rows).repartition(4))))
    want = [brute(*r) for r in rows]
    assert sorted_rows(got) == sorted_rows(want)
    sql = duck({"documents": rows}, {"documents": "doc_id BIGINT, text VARCHAR"}, fim.oracle_sql())
    assert sorted_rows(sql) == sorted_rows(got)
    assert {r[1] for r in got} == {"plain", "psm", "spm"}
    assert fim.fim_query(docs(spark, [])).collect() == []


def test_output_restores_and_share_of_forms(spark):
    rows = [(i, f"a{i}\nb\nc\nd") for i in range(400)]
    made = fim.fill_in_middle(docs(spark, rows), fim_percent=60, spm_percent=25)
    got = {r.doc_id: r for r in made.withColumn("back", fim.restored()).collect()}
    assert all(got[i].back == t for i, t in rows)
    shares = {f: sum(r.form == f for r in got.values()) / 400 for f in ("plain", "spm", "psm")}
    assert 0.3 < shares["plain"] < 0.5 and 0.08 < shares["spm"] < 0.25 < shares["psm"]


def test_rank_indexes(spark):
    text = "one\ntwo\nthree\n" * 20
    row = fim.rank_indexes(docs(spark, [(1, text), (2, None)])).where("doc_id = 1").first()
    index = fim.RankIndex([s.rank for s in row.segments], [s.offset for s in row.segments], [s.slope for s in row.segments],
                          np.frombuffer(bytes(row.residuals), np.int16))
    assert row.n == 60 and [index.offset(r) for r in range(61)] == list(fim.boundaries(text))
