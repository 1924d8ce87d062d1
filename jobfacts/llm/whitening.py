"""Embedding whitening from the weighted covariance of the distinct vectors.

Every entry c becomes the integer x = floor(256 * c).  Rows are grouped by their x vector, and
each distinct vector counts once or as often as it occurs (``weights``).  Three passes over
the distinct vectors follow: the weighted sums S and n; the covariance, one centred matrix
product per batch, added up per matrix row; and the projection on the leading eigenvectors,
done once per distinct vector and joined back to the rows.

An x vector travels packed, in the narrowest of 2, 4 or 8 bytes an entry, which is also what
it is grouped by; rows are joined back by its SHA-256.  Vectors that hold more than a
``HOT_SHARE`` of the rows are at most 1 / HOT_SHARE many: these are broadcast, so that no
group of copies meets in one task; all others are joined by a shuffle.  The driver sees the
sums, one matrix of dims x dims and the eigenvectors.

Defined results: rows whose vector is NULL or has a NULL, infinite or NaN entry, or an x that
doesn't fit a long, go; a vector has the length that most of the other rows have (the larger
of two equally frequent ones), rows of other lengths go; components whose eigenvalue is zero
but for rounding have no row, so one distinct vector alone gives no rows; NULL ids and repeated
rows are rows like others; an empty table gives an empty result.  A deviation that doesn't
fit a long is NULL in the query.  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value, cut

by_value(__name__)

#: fixed-point steps per unit
SCALE = 256
COMPONENTS = 4
#: a vector with more than this share of the rows is joined by broadcast
HOT_SHARE = 0.001
_WIDTHS = (np.int16, np.int32, np.int64)


class Fit(NamedTuple):
    """Components by falling eigenvalue, of the fit list's covariance."""

    weight: int                 # n, the sum of the weights
    sums: list[int]             # S
    values: np.ndarray          # leading eigenvalues
    vectors: np.ndarray         # a column per component
    trace: float


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and x vectors of the usable rows of a batch of lists of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(rows)).flatten()
    entries = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dims)  # NULL becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(entries * SCALE)
        good = (np.isfinite(x) & (x >= -2.0 ** 63) & (x < 2.0 ** 63)).all(axis=1)
    return rows[good], x[good].astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each vector in its narrowest width, which its length then tells."""
    out: list[bytes] = [b""] * len(x)
    reach = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1)) if x.size else np.zeros(len(x), np.int64)
    for kind, below in zip(_WIDTHS, (0, 2 ** 15, 2 ** 31)):
        own = np.flatnonzero((reach >= below) & (reach <= np.iinfo(kind).max))
        block = x[own].astype(kind)
        for i, row in zip(own, block):
            out[i] = row.tobytes()
    return out


def _unpacked(packed: list[bytes], dims: int) -> np.ndarray:
    x = np.empty((len(packed), dims), np.int64)
    widths = np.array([len(p) // dims for p in packed])
    for kind in _WIDTHS:
        own = np.flatnonzero(widths == np.dtype(kind).itemsize)
        if len(own):
            x[own] = np.frombuffer(b"".join(packed[i] for i in own), kind).reshape(len(own), dims)
    return x


def _dims(vectors: DataFrame, vector: str) -> int:
    """The most frequent length; counted per length, not per row."""
    found = (vectors.where(F.size(f"`{vector}`") > 0).groupBy(F.size(f"`{vector}`").alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).first())
    return found["d"] if found else 0


def quantized(vectors: DataFrame, dims: int, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(id, x packed, key) of the rows that remain."""
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, x = _matrix(batch.column("v"), dims)
            yield pa.record_batch([batch.column("id").take(pa.array(own)), pa.array(_packed(x), pa.binary())], ["id", "x"])

    made = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x binary")
    return made.select("id", "x", F.sha2("x", 256).alias("key"))


def _sums(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and S, exact: partial sums per task in Python integers, added as decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (dims + 1)
        for batch in batches:
            x, w = _unpacked(batch.column("x").to_pylist(), dims), batch.column("w").to_numpy()
            safe = float(np.abs(x.astype(float)).max(initial=0)) * float(w.sum()) < 2.0 ** 62  # else Python integers
            for j, t in enumerate(((x if safe else x.astype(object)) * w[:, None]).sum(axis=0)):
                totals[j + 1] += int(t)
            totals[0] += int(w.sum())
        yield pa.record_batch([pa.array(range(dims + 1), pa.int32()), pa.array([str(t) for t in totals], pa.string())], ["i", "s"])

    parts = distinct.select("x", "w").mapInArrow(run, "i int, s string")
    added = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return added.get(0, 0), [added.get(j + 1, 0) for j in range(dims)]


def _covariance(distinct: DataFrame, dims: int, weight: int, sums: list[int]) -> np.ndarray:
    """Weighted covariance, divisor n: a centred matrix product per batch, a row of the
    matrix per task and dimension, added up in one group per dimension."""
    mean = np.array([s / weight for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            centred = _unpacked(batch.column("x").to_pylist(), dims) - mean
            total += (centred * batch.column("w").to_numpy()[:, None]).T @ centred
        yield pa.record_batch([pa.array(range(dims), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "part"])

    def add(key: tuple[pa.Scalar], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims)
        for batch in groups:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["i", "total"])

    rows = distinct.select("x", "w").mapInArrow(run, "i int, part binary").groupBy("i").applyInArrow(add, "i int, total binary").collect()
    v = np.zeros((dims, dims))
    for r in rows:
        v[r["i"]] = np.frombuffer(r["total"])
    return (v + v.T) / (2 * weight)


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Fit | None:
    """From (x packed, w) of the distinct vectors; None if there is none."""
    weight, sums = _sums(distinct, dims)
    if not weight:
        return None
    v = _covariance(distinct, dims, weight, sums)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values[:components] > max(values[0], 0) * dims * np.finfo(float).eps * 16).sum())
    return Fit(weight, sums, values[:real], vectors[:, :real], float(np.trace(v)))


def _projected(distinct: DataFrame, dims: int, fitted: Fit) -> DataFrame:
    """(key, copies, w, deviation as decimal, whitened) of each distinct vector."""
    scaled = fitted.vectors / np.sqrt(fitted.values)
    n, sums = fitted.weight, fitted.sums
    mean, exact_sums = np.array([s / n for s in sums]), np.array(sums, dtype=object)

    def deviations(x: np.ndarray) -> list[str]:
        bound = float(np.abs(x.astype(float)).max(initial=0)) * n + max(abs(t) for t in sums)
        if bound * bound * dims < 2.0 ** 62:  # no overflow in long arithmetic; else Python integers
            gap = x * n - np.array(sums, np.int64)
            return [str(t) for t in (gap * gap).sum(axis=1).tolist()]
        gap = x.astype(object) * n - exact_sums
        return [str(t) for t in (gap * gap).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column("x").to_pylist(), dims)
            white = (x - mean) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))
            yield pa.record_batch([batch.column("key"), batch.column("copies"), batch.column("w"),
                                   pa.array(deviations(x), pa.string()), lists], ["key", "copies", "w", "deviation", "whitened"])

    return distinct.mapInArrow(run, "key string, copies long, w long, deviation string, whitened array<double>")


def _identity_error(projected: DataFrame, count: int, weight: int) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, centred first."""
    means = projected.agg(*[(F.sum(F.col("w") * F.col("whitened")[i]) / weight).alias(f"m{i}") for i in range(count)]).first()
    gap = [F.col("whitened")[i] - F.lit(means[i]) for i in range(count)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = projected.agg(*[(F.sum(F.col("w") * gap[i] * gap[j]) / weight).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


_RESULT = "id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, copies long"


def whiten(vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", components: int = COMPONENTS,
           weights: str = "one") -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation (sum over dims of
    (n * x - S) squared, exact), whitened, explained, identity_error, copies of the vector."""
    if weights not in ("one", "counts"):
        raise ValueError("weights are one or counts")
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], _RESULT.format(kind=vectors.schema[id_column].dataType.simpleString()))
    dims = _dims(vectors, vector)
    if not dims:
        return empty
    rows = cut(quantized(vectors, dims, vector, id_column), "quantized")
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = cut(rows.groupBy("x").agg(F.count("*").alias("copies")).select(F.sha2("x", 256).alias("key"), "x", "copies", weight.alias("w")), "distinct")
    fitted = fit(distinct, dims, components)
    if fitted is None or not len(fitted.values):
        return empty
    count = len(fitted.values)
    projected = cut(_projected(distinct, dims, fitted), "projected")
    error = _identity_error(projected, count, fitted.weight)
    total = rows.count()
    hot = F.col("copies") > max(1.0, total * HOT_SHARE)  # at most 1 / HOT_SHARE vectors, each of a few hundred bytes
    known = projected.select("key", "copies", "deviation", "whitened")
    frequent = F.broadcast(known.where(hot))
    ids = rows.select("id", "key")
    joined = ids.join(frequent, "key").unionByName(ids.join(F.broadcast(known.where(hot).select("key")), "key", "left_anti").join(known.where(~hot), "key"))
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values])
    out = joined.select("id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), "copies", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.weight).cast("long").alias("n"), "deviation",
                      "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"), "copies")


def whitening_query(vectors: DataFrame) -> DataFrame:
    return whiten(vectors).select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                                  "whitened", "explained", "identity_error")
