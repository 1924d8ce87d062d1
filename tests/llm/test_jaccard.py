import random
import re

import numpy as np

from jobfacts.llm import jaccard
from tests.llm.helpers import clashing, docs, words


def shingle_set(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < size else [tuple(w[i:i + size]) for i in range(len(w) - size + 1)])


def brute(data, percent=90, size=3):
    """doc_id to (n_shingles, component_id), for distinct doc_ids."""
    sets = {i: shingle_set(t, size) for i, t in data}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def sample(seed=3):
    """Random texts; stars, chains and dense groups of near copies; exact copies."""
    rng = random.Random(seed)
    data = [(i, words(rng, rng.randrange(60), 40)) for i in range(30)]
    for _ in range(6):
        base = words(rng, rng.randrange(25, 160), 3000).split()
        own = list(base)
        for _ in range(rng.randrange(2, 14)):
            own = list(base) if rng.random() < 0.5 else own  # a star around the base, or a chain
            if rng.random() < 0.85:
                own[rng.randrange(len(own))] = f"new{rng.randrange(10 ** 6)}"
            data.append((rng.randrange(10 ** 9), " ".join(own)))
    return data + [(40, None), (41, ""), (42, " \n\t"), (43, "One"), (44, "one"), (45, "one two"), (46, "ONE two"), (47, "É a"), (48, "é a"),
                   (49, "x " * 500), (50, "x " * 400), (51, "a b c"), (52, "a b c a b c")]


def test_against_brute_force(spark):
    data = sample()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_query(clashing(docs(spark, data))).collect()}
    assert got == brute(data)
    assert sum(v[1] != i for i, v in got.items()) > 20


def test_small_tiles_and_shuffles_give_the_same(spark, monkeypatch):
    data = sample(4)
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", 300)
    got = jaccard.components(docs(spark, data), max_broadcast=-1, tile=3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(data)


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j k"
    df = docs(spark, [(7, text), (7, text), (9, text), (None, text), (None, "alone in the world"), (8, "another text that stands for itself"),
                      (8, text)])
    got = sorted((repr(r.doc_id), repr(r.component_id)) for r in jaccard.jaccard_query(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("8", "7"), ("8", "8"), ("9", "7"), ("None", "7"), ("None", "None")]
    kept = jaccard.keep_one(clashing(df))
    assert sorted((repr(r.doc_id), r.text) for r in kept.collect()) == sorted([
        ("7", text), ("7", text), ("8", "another text that stands for itself"), ("None", "alone in the world")])


def test_empty_table(spark):
    assert jaccard.jaccard_query(docs(spark, [])).collect() == []


def test_linked_sets_share_a_key_and_pass_the_tree():
    rng = np.random.default_rng(0)
    bounds = jaccard.size_bounds(90)
    assert all(bounds[i + 1] * 90 >= bounds[i] * 100 for i in range(len(bounds) - 1))
    for _ in range(600):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        most = 2 * len(a) * 10 // 190
        out, new = rng.integers(0, most // 2 + 1), rng.integers(0, most // 2 + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[int(out):], rng.integers(0, 2 ** 64, int(new), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 90 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.keys_of(a, bounds, 90), jaccard.keys_of(b, bounds, 90)))
            points = [jaccard.point_of(x)[None].astype(np.int64) for x in (a, b)]
            assert len(jaccard.tree_join(*points, 90)[0]) == 1


def test_tree_join_against_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 6, (5, jaccard.POINT_GROUPS))
    points = np.concatenate([np.maximum(0, b + (rng.random((40, jaccard.POINT_GROUPS)) < 0.03) * rng.integers(-1, 2, (40, jaccard.POINT_GROUPS))) for b in base])
    i, j = jaccard.tree_join(points, points, 90)
    sums = points.sum(axis=1)
    shared = np.minimum(points[:, None], points[None]).sum(axis=2)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(190 * shared >= 90 * (sums[:, None] + sums[None])))))


def links_of(data):
    """doc_id to the number of different other texts it links with, for distinct texts."""
    sets = {i: shingle_set(t) for i, t in data}
    return {i: sum(j != i and bool(s and o) and 100 * len(s & o) >= 90 * len(s | o) for j, o in sets.items()) for i, s in sets.items()}


def test_links_are_counted_against_brute_force(spark, monkeypatch):
    data, seen = [], set()
    for i, t in sample(5):  # equal texts are one vertex
        if t not in seen:
            data.append((i, t))
            seen.add(t)
    want = links_of(data)
    assert max(want.values()) >= 4
    assert {r.doc_id: r.n_links for r in jaccard.jaccard_query(clashing(docs(spark, data))).collect()} == want
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", 300)
    monkeypatch.setattr(jaccard, "SLICE", 7)
    got = jaccard.components(docs(spark, data), max_broadcast=-1, tile=3).collect()
    assert {r.doc_id: r.n_links for r in got} == want


def test_copies_of_one_text_count_the_same_links(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)] + [" ".join(base[:k] + ["x"] + base[k + 1:]) for k in (20, 90, 160)]
    data = [(i, texts[i % 4]) for i in range(10)] + [(None, texts[0])]
    assert {r.n_links for r in jaccard.jaccard_query(docs(spark, data)).collect()} == {3}


def test_five_words_and_80_percent(spark):
    data = sample(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(docs(spark, data), size=5, percent=80, count_links=False).collect()}
    want = brute(data, 80, 5)
    assert got == want and want != brute(data)
    kept = {r.doc_id for r in jaccard.keep_one(docs(spark, data)).collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i}


def test_parities_bound_the_difference():
    rng = np.random.default_rng(2)
    tight = []
    for _ in range(500):
        a = np.unique(rng.integers(0, 2 ** 64, int(rng.integers(0, 600)), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[int(rng.integers(0, len(a) + 1)):], rng.integers(0, 2 ** 64, int(rng.integers(0, 300)), dtype=np.uint64)]))
        d = len(np.setxor1d(a, b))
        bits = jaccard.apart(jaccard.parities_of(a), jaccard.parities_of(b))
        assert bits <= d
        if len(a) < 2 * len(b) < 4 * len(a):  # others are told apart by their sizes
            tight.append(bits / max(d, 1))
    assert len(tight) > 150 and np.median(tight) > 0.75 and min(tight) > 0.4


def test_points_are_packed_without_loss():
    rng = np.random.default_rng(3)
    points = [rng.integers(0, top, jaccard.POINT_GROUPS).astype(np.uint32) for top in (1, 3, 16, 17, 256, 257, 65536, 65537, 2 ** 32, 2)]
    held = [jaccard.packed(p) for p in points]
    assert [len(h) * 8 // jaccard.POINT_GROUPS for h in held[:3]] == [4, 4, 4] and len(held[-2]) == 4 * jaccard.POINT_GROUPS
    assert (jaccard.unpacked(held) == np.stack(points)).all()
    assert jaccard.unpacked([]).shape == (0, jaccard.POINT_GROUPS)


def test_unrelated_pairs_are_told_apart_by_few_bytes():
    rng = np.random.default_rng(4)
    for n in (60, 300, 1500, 6000):
        a, b = (np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64)) for _ in "ab")
        coarse = [jaccard.folded(jaccard.folded(jaccard.parities_of(x))) for x in (a, b)]
        assert all(len(x) <= n // 4 for x in coarse)
        assert 180 * jaccard.apart(*coarse) > 20 * 2 * n
        near = np.unique(np.concatenate([a[n // 10:], rng.integers(0, 2 ** 64, n // 10, dtype=np.uint64)]))
        assert 180 * jaccard.apart(coarse[0], jaccard.folded(jaccard.folded(jaccard.parities_of(near)))) <= 20 * (len(a) + len(near))


def test_unrelated_sets_share_few_keys_and_linked_ones_some():
    rng = np.random.default_rng(5)
    bounds = jaccard.size_bounds(80)
    for n in (20, 60, 300):
        sets = [np.unique(rng.integers(0, 2 ** 64, int(rng.integers(n, n * 5 // 4)), dtype=np.uint64)) for _ in range(150)]
        keys = [jaccard.keys_of(x, bounds, 80) for x in sets]
        shared = sum(len(np.intersect1d(a, b)) > 0 for i, a in enumerate(keys) for b in keys[:i])
        assert shared <= 20  # of 11,175 pairs
    for _ in range(3000):  # small sets as far apart as links allow, with many empty groups
        a = np.unique(rng.integers(0, 2 ** 64, int(rng.integers(1, 60)), dtype=np.uint64))
        out = int(rng.integers(0, len(a)))
        b = a[rng.permutation(len(a))[out:]]
        new = max(0, len(b) * 100 // 80 - len(a)) if rng.random() < 0.5 else int(rng.integers(0, 1 + len(a) // 4))
        b = np.unique(np.concatenate([b, rng.integers(0, 2 ** 64, new, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.keys_of(a, bounds, 80), jaccard.keys_of(b, bounds, 80)))
