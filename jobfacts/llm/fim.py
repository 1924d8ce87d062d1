"""Fill-in-middle transformation of whole texts, cut at line boundaries by a learned rank index.

A text's units are its lines, each with its line break.  The offsets of all unit boundaries
(code points; rank 0 is the start, rank n the end) are fitted by segments of straight lines,
none further than ``EPSILON`` from any boundary.  What a segment misses is stored as a
residual per rank, so a cut is the prediction of its segment plus the residual: exact, found
by one search among the segments.  Two ranks drawn from a hash of the document's id are cut
this way; the pieces are put together and hashed by built-in expressions.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>``
prefix ``<M>`` middle, ``plain`` the text as it was.  A text that holds a marker is plain, so
the markers of an output are its own and ``restored`` can split at them.

Defined results: a NULL text is empty; empty texts have no unit and are plain; a NULL doc_id
draws from the empty id; rows with equal ids draw alike; texts without a line break are one
unit; an empty table gives an empty result.  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

#: greatest distance, in code points, of a segment from a boundary
EPSILON = 48
SEED = 7
#: percent of documents that are transformed, and of these written suffix first
FIM_PERCENT = 100
SPM_PERCENT = 50
#: The markers of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_PIECE = 1 << 20


def boundaries(text: str) -> np.ndarray:
    """Offsets of all unit boundaries, from 0 to the length: n + 1 of them for n units."""
    places = []
    for at in range(0, len(text), _PIECE):  # a piece at a time, so that a wide copy of it stays small
        piece = text[at:at + _PIECE]
        codes = np.frombuffer(piece.encode(), np.uint8) if piece.isascii() else np.frombuffer(piece.encode("utf-32-le"), np.uint32)
        places.append(np.flatnonzero(codes == 10) + (at + 1))
    ends = np.concatenate([np.zeros(1, np.int64), *places])
    return ends if ends[-1] == len(text) else np.append(ends, len(text))


class RankIndex(NamedTuple):
    """Segments (first rank, offset there, slope) and the residual of every rank."""

    ranks: list[int]
    offsets: list[int]
    slopes: list[float]
    residuals: np.ndarray

    def predict(self, rank: int) -> int:
        s = bisect_right(self.ranks, rank) - 1
        return self.offsets[s] + int(self.slopes[s] * (rank - self.ranks[s]))

    def offset(self, rank: int) -> int:
        return self.predict(rank) + int(self.residuals[rank])


def fit(ends: np.ndarray, epsilon: int = EPSILON) -> RankIndex:
    """Greedy segments: from its first boundary on, a segment grows as long as one slope
    passes within ``epsilon`` of all its boundaries.  The slopes that do are an interval that
    shrinks with every boundary; doubling blocks keep the search for its end linear."""
    last = len(ends) - 1
    ranks, offsets, slopes = [], [], []
    residuals = np.zeros(last + 1, np.int16)
    start = 0
    while start <= last:
        low, high, end, size = -np.inf, np.inf, start + 1, 8
        while end <= last:
            steps = np.arange(end, min(end + size, last + 1)) - start
            rise = (ends[end:end + len(steps)] - ends[start]).astype(float)
            lows = np.maximum(np.maximum.accumulate((rise - epsilon) / steps), low)
            highs = np.minimum(np.minimum.accumulate((rise + epsilon) / steps), high)
            fits = lows <= highs
            good = len(steps) if fits.all() else int(np.argmin(fits))
            if good:
                low, high = float(lows[good - 1]), float(highs[good - 1])
            end += good
            if good < len(steps):
                break
            size *= 2
        slope = 0.0 if end == start + 1 else (low + high) / 2
        guess = ends[start] + (slope * np.arange(end - start)).astype(np.int64)
        residuals[start:end] = ends[start:end] - guess
        ranks.append(start)
        offsets.append(int(ends[start]))
        slopes.append(slope)
        start = end
    return RankIndex(ranks, offsets, slopes, residuals)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of a document: 8-digit groups of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def rank_indexes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", epsilon: int = EPSILON) -> DataFrame:
    """The index of every text: doc_id, n, segments (rank, offset, slope) and the residuals,
    two bytes a rank."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches):
        kinds = pa.list_(pa.struct([("rank", pa.int64()), ("offset", pa.int64()), ("slope", pa.float64())]))
        for batch in batches:
            made = [fit(boundaries(t.as_py()), epsilon) for t in batch.column("text")]
            segments = [[{"rank": r, "offset": o, "slope": s} for r, o, s in zip(x.ranks, x.offsets, x.slopes)] for x in made]
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(x.residuals) - 1 for x in made], pa.int64()),
                                   pa.array(segments, kinds), pa.array([x.residuals.tobytes() for x in made], pa.binary())],
                                  ["doc_id", "n", "segments", "residuals"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, "
                                "segments array<struct<rank:long,offset:long,slope:double>>, residuals binary")


def _cutter(epsilon: int):
    kinds = [("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())]

    @F.arrow_udf("struct<n:long,first:long,second:long>")
    def cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        found = []
        for t, a, b in zip(texts, h1.to_pylist(), h2.to_pylist()):
            index = fit(boundaries(t.as_py()), epsilon)
            n = len(index.residuals) - 1
            low, high = sorted((a % (n + 1), b % (n + 1)))
            found.append((n, index.offset(low), index.offset(high)))
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))],
                                          fields=[pa.field(*k) for k in kinds])

    return cuts


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, epsilon: int = EPSILON) -> DataFrame:
    """doc_id, n (units), form, prefix_chars and middle_chars (NULL if plain), output."""
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", _cutter(epsilon)("text", h1, h2).alias("cut"))
    marked = [F.contains("text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("text") == "") | marked[0] | marked[1] | marked[2] | (h3 % 100 >= fim_percent)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix = F.concat(F.lit(PREFIX), F.substring("text", F.lit(1), first))
    middle = F.concat(F.lit(MIDDLE), F.substring("text", first + 1, second - first))
    suffix = F.concat(F.lit(SUFFIX), F.substring("text", second + 1, F.length("text")))
    output = (F.when(F.col("form") == "psm", F.concat(prefix, suffix, middle))
              .when(F.col("form") == "spm", F.concat(suffix, prefix, middle)).otherwise(F.col("text")))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", F.col("cut.n").alias("n"), "form", F.when(cut, F.col("cut.first")).alias("prefix_chars"),
                       F.when(cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"), output.alias("output"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text of an output, from it and its form alone."""
    pieces = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    one, two, three = (F.get(pieces, F.lit(k)) for k in (1, 2, 3))
    return (F.when(F.col(form) == "psm", F.concat(one, three, two))
            .when(F.col(form) == "spm", F.concat(two, three, one)).otherwise(F.col(output)))


def fim_query(docs: DataFrame) -> DataFrame:
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


def oracle_sql(source: str = "documents") -> str:
    draw = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::UBIGINT"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM {source}),
u AS (SELECT doc_id, t, h, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS l FROM d),
c AS (SELECT *, len(l) AS n, {draw(0)} % (len(l) + 1) AS a, {draw(1)} % (len(l) + 1) AS b,
      CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {draw(2)} % 100 >= {FIM_PERCENT} THEN 'plain'
           WHEN {draw(3)} % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(l[1:least(a, b)], '') AS pre, array_to_string(l[least(a, b) + 1:greatest(a, b)], '') AS mid,
      array_to_string(l[greatest(a, b) + 1:n], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                        WHEN 'spm' THEN '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""
