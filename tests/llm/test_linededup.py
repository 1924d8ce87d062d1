import random

from jobfacts.llm import linededup
from tests.llm.helpers import clashing, docs, duck, rows_of, sorted_rows


def within_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute(data, min_fuzzy=linededup.MIN_FUZZY):
    """doc_id to (text, n_lines, n_equal, n_close), for distinct doc_ids."""
    first = {}
    order = sorted((i, k, x.strip(" \t\x0b\x0c\r")) for i, t in data for k, x in enumerate((t or "").split("\n")))
    for i, k, line in order:
        if line:
            first.setdefault(line, (i, k))
    long = [x for x in first if len(x) >= min_fuzzy]
    close = {a for a in long if any(first[b] < first[a] and within_one(a, b) for b in long)}
    out = {}
    for i, t in data:
        raw, keep, n, equal, near = (t or "").split("\n"), [], 0, 0, 0
        for k, x in enumerate(raw):
            line = x.strip(" \t\x0b\x0c\r")
            n += bool(line)
            if line and first[line] < (i, k):
                equal += 1
            elif line in close:
                near += 1
            else:
                keep.append(x)
        out[i] = ("\n".join(keep), n, equal, near)
    return out


def edited(rng, line):
    p = rng.randrange(len(line))
    return rng.choice([line[:p] + line[p + 1:], line[:p] + rng.choice("xyzé ") + line[p:], line[:p] + rng.choice("qé") + line[p + 1:]])


def sample(seed=5):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("abcde é") for _ in range(rng.choice([3, 19, 20, 21, 40, 80, 511, 512, 513, 700]))) for _ in range(40)]
    data = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(6)):
            x = rng.choice(lines)
            own.append(edited(rng, x) if rng.random() < 0.5 else x)
            if rng.random() < 0.1:
                own.append(" \t")
        data.append((i, "\n".join(own)))
    return data + [(100, None), (101, ""), (102, "\n\n"), (103, "aaaaaaaaaaaaaaaaaaaaaaaa\naaaaaaaaaaaaaaaaaaaaaaa"), (104, " " + lines[0] + "\r")]


def test_against_brute_force(spark):
    data = sample()
    got = {r.doc_id: (r.text, r.n_lines, r.n_equal, r.n_close) for r in linededup.line_dedup_query(docs(spark, data)).collect()}
    assert got == brute(data)
    assert sum(v[3] for v in got.values()) > 20


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    data = sample(6)
    monkeypatch.setattr(linededup, "MAX_ENTRIES", -1)
    monkeypatch.setattr(linededup, "salted_join", lambda l, r, k: __import__("jobfacts.llm.common", fromlist=["x"]).salted_join(l, r, k, salts=3, limit=-1))
    got = {r.doc_id: (r.text, r.n_lines, r.n_equal, r.n_close) for r in linededup.line_dedup_query(docs(spark, data)).collect()}
    assert got == brute(data)


def test_sql_agrees(spark):
    data = [(i, (t or "").replace("\r", "")) for i, t in sample(7)]
    sql = duck({"documents": data}, {"documents": "doc_id BIGINT, text VARCHAR"}, linededup.oracle_sql())
    assert sorted_rows(rows_of(linededup.line_dedup_query(docs(spark, data)))) == sorted_rows(sql)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    a, b = "the first line of all these documents", "another line that nobody else has at all"
    data = [(None, a), (1, a + "\n" + b), (1, a + "\n" + b), (2, b), (2, "a different text under the same number")]
    df = clashing(docs(spark, data))
    kept = linededup.keep_first_lines(df)
    assert kept.columns == df.columns
    assert sorted((repr(r.doc_id), r.text) for r in kept.collect()) == sorted([
        ("None", a), ("1", b), ("1", b), ("2", "a different text under the same number")])


def test_empty_table_and_bound(spark):
    assert linededup.line_dedup_query(docs(spark, [])).collect() == []
    exact = linededup.repeated_lines(docs(spark, [(1, "abcdefghijklmnopqrstuvwxyz"), (2, "abcdefghijklmnopqrstuvwxy")]), max_edits=0)
    assert exact.collect() == []


def test_a_doc_id_of_a_third_of_the_rows(spark):
    """Rows that share a doc_id, or have none: each keeps and loses the lines it would with an
    own id, as far as order goes; lines at one place of one doc_id are not earlier than one another."""
    rng = random.Random(9)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(30)) for _ in range(30)]

    def text():
        return "\n".join(edited(rng, x) if rng.random() < 0.4 else x for x in rng.sample(lines, rng.randrange(1, 5)))

    data = [(i, text()) for i in range(40)] + [(12, text()) for _ in range(30)] + [(None, text()) for _ in range(30)]
    data += data[50:60]  # and some of them twice
    order = lambda i, k: (i is not None, i if i is not None else 0, k)
    first = {}
    for i, t in data:
        for k, x in enumerate(t.split("\n")):
            x = x.strip()
            if x:
                first[x] = min(first.get(x, order(i, k)), order(i, k))
    long = [x for x in first if len(x) >= linededup.MIN_FUZZY]
    close = {a for a in long if any(first[b] < first[a] and within_one(a, b) for b in long)}
    want = sorted((repr(i), "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip()
                                      or not (first[x.strip()] < order(i, k) or x.strip() in close))) for i, t in data)
    out = linededup.line_dedup_query(docs(spark, data).repartition(5)).collect()
    assert sorted((repr(r.doc_id), r.text) for r in out) == want
    assert sum(r.n_close for r in out if r.doc_id in (12, None)) > 5


def test_lists_are_no_longer_than_a_text(spark):
    a = "a line that stands in every text of the one big group"
    data = [(None, f"{a}\nown line of text number {i}, all by itself {i * i}") for i in range(300)] + [(1, a)]
    got = linededup.line_dedup_query(docs(spark, data)).collect()
    assert {r.text for r in got if r.doc_id == 1} == {""} and len(got) == 301
