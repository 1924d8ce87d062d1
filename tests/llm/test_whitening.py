import numpy as np
import pytest
from pyspark.sql import functions as F

from jobfacts.llm import whitening
from tests.llm.helpers import clashing

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], VECTORS)


def sample(seed=1, rows=300, dims=12):
    rng = np.random.default_rng(seed)
    base = (rng.normal(size=(rows, dims)) * np.linspace(0.1, 1.5, dims)).astype(np.float32)
    data = [(i, base[i % 120] if i % 3 else base[7]) for i in range(rows)]  # a third is one vector
    return data + [(1000, None), (1001, [float("nan")] * dims), (1002, [None] + [0.5] * (dims - 1)), (1003, [float("inf")] * dims),
                   (1004, []), (1005, [0.5] * (dims - 1)), (None, base[3]), (5, base[4])]


def brute(data, dims, weights="one"):
    good = [(i, v) for i, v in data if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(256 * float(c))) for c in v) for _, v in good]
    distinct = sorted(set(x))
    w = np.array([x.count(d) if weights == "counts" else 1 for d in distinct])
    u = np.array(distinct)
    n, s = int(w.sum()), (u * w[:, None]).sum(axis=0)
    centred = u - s / n
    v = (centred * w[:, None]).T @ centred / n
    e, q = np.linalg.eigh(v)
    return good, x, n, s, e[::-1], q[:, ::-1], np.trace(v)


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_against_brute_force(spark, weights):
    data = sample()
    good, x, n, s, e, q, trace = brute(data, 12, weights)
    got = whitening.whiten(clashing(frame(spark, data)).repartition(3), weights=weights).toPandas()
    assert len(got) == 4 * len(good) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    for k in range(4):
        own = got[got.component == k + 1]
        assert np.allclose(own.explained, e[k] / trace, rtol=1e-9)
        want = sorted((repr(i), int(((n * np.array(t) - s) ** 2).sum()), float((np.array(t) - s / n) @ q[:, k] / np.sqrt(e[k]))) for (i, _), t in zip(good, x))
        have = sorted((repr(None if i != i else int(i)), int(d), w) for i, d, w in zip(own.id, own.deviation, own.whitened))
        assert [h[:2] for h in have] == [w[:2] for w in want]
        a, b = np.array([h[2] for h in have]), np.array([w[2] for w in want])
        order = [np.lexsort((np.abs(a), [h[0] for h in have])), np.lexsort((np.abs(b), [w[0] for w in want]))]
        a, b = a[order[0]], b[order[1]]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_copies_get_equal_values_by_both_joins(spark, monkeypatch):
    data = [(i, [i % 7 * 0.25, (i * i) % 5, i % 3]) for i in range(210)]
    plain = whitening.whitening_query(frame(spark, data)).toPandas().sort_values(["vec_id", "component"]).reset_index(drop=True)
    monkeypatch.setattr(whitening, "HOT_SHARE", 1.0)  # no vector is broadcast
    shuffled = whitening.whitening_query(frame(spark, data)).toPandas().sort_values(["vec_id", "component"]).reset_index(drop=True)
    assert np.allclose(plain.whitened.abs(), shuffled.whitened.abs()) and plain.deviation.equals(shuffled.deviation)
    groups = plain[plain.component == 1].groupby(["deviation", "whitened"]).size()
    assert len(groups) <= 105 and groups.sum() == 210


def test_fewer_dimensions_and_no_variance(spark):
    flat = [(i, [i * 0.5, 1.0]) for i in range(9)]
    got = whitening.whitening_query(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9 and all(r.explained == pytest.approx(1) for r in got)
    assert whitening.whitening_query(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []
    assert whitening.whitening_query(frame(spark, [])).collect() == []
    assert whitening.whitening_query(frame(spark, [(1, None), (2, []), (3, [None])])).collect() == []


def test_large_values_are_exact(spark):
    data = [(i, [1e6 * i, -2e9 + i, 3e12 * (i % 2)]) for i in range(40)]
    _, x, n, s, *_ = brute([(i, np.array(v, np.float32)) for i, v in data], 3)
    got = {r.id: int(r.deviation) for r in whitening.whiten(frame(spark, data)).where("component = 1").collect()}
    assert got == {i: sum((n * int(t) - int(u)) ** 2 for t, u in zip(row, s)) for i, row in enumerate(x)}
    assert whitening.whitening_query(frame(spark, data)).where(F.col("deviation").isNull()).count() > 0
    assert whitening.whitening_query(frame(spark, [(1, [3e38, 1]), (2, [1, 2]), (3, [2, 1])])).where("vec_id = 1").count() == 0


def test_packed_vectors_keep_their_values():
    x = np.array([[0, -1, 32767], [0, -32768, 5], [0, 32768, 1], [-2 ** 31, 2 ** 31 - 1, 0], [2 ** 62, -2 ** 63, 2 ** 63 - 1]])
    packed = whitening._packed(x)
    assert [len(p) // 3 for p in packed] == [2, 2, 4, 4, 8]
    assert (whitening._unpacked(packed, 3) == x).all()


def test_unknown_weights(spark):
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [(1, [1.0])]), weights="tf")
