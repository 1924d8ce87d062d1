"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (1 to 3, within
words and their edges).  A document's own list is compared with each profile by the
out-of-place distance: the sum, over the document's n-grams, of how far the ranks lie
apart, a missing n-gram counting as the profile's length.  The nearest profile wins.

Counts cover the whole text of every row that the caller marks for learning: tasks count
in bounded tables, Spark sums them, and a window keeps each language's first ``PROFILE``
n-grams.  The profiles (languages x ``PROFILE`` rows) are the model.

Defined results: a NULL text, or one without letters, is ``und`` with score 0, as is any
text if nothing was learned; texts with a NULL lang are not learned from; equal distances
go to the language that sorts first, equal counts to the smaller n-gram; repeated rows count
as often as they occur in learning and get equal predictions; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

PROFILE = 400
DOCUMENT = 300
UNKNOWN = "und"
#: n-grams that a learning task counts before it hands them on
COUNTED = 500_000

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 letters, a space standing for the edges of words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    solid = _letter_table()[codes]
    if not solid.any():
        return np.zeros(0, dtype=np.int64)
    codes = np.where(solid, codes, 32)
    keep = solid | np.concatenate([[True], solid[:-1]])  # the first of a run of others
    c = np.concatenate([[32], codes[keep], [32]])
    at = c != 32
    pairs, threes = (c[:-1] << 21) | c[1:], (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
    return np.concatenate([c[at], pairs[at[:-1] | at[1:]], threes[at[1:-1]]])


def ranked(grams: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes, in order; equal counts by code."""
    values, counts = np.unique(grams, return_counts=True)
    return values[np.lexsort((values, -counts))[:most]]


class Profiles:
    def __init__(self, lists: dict[str, list[int]]):
        self.languages = sorted(lists)
        self.length = max((len(x) for x in lists.values()), default=0)
        self.sorted, self.ranks = [], []
        for name in self.languages:
            grams = np.array(lists[name], dtype=np.int64)
            order = np.argsort(grams)
            self.sorted.append(grams[order])
            self.ranks.append(order)

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each profile, from 0 to 1."""
        place = np.arange(len(own))
        out = []
        for grams, ranks in zip(self.sorted, self.ranks):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            apart = np.where(grams[at] == own, np.minimum(np.abs(ranks[at] - place), self.length), self.length)
            out.append(apart.sum() / (self.length * len(own)))
        return np.array(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(ngrams(text or ""), DOCUMENT)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        far = self.distances(own)
        best = int(far.argmin())
        return self.languages[best], float(1.0 - far[best])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", length: int = PROFILE) -> Profiles:
    """Profiles from all rows with a lang."""
    rows = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.record_batch([pa.array([name] * len(values), pa.string()), pa.array(values), pa.array(counts)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text")):
                texts.setdefault(name, []).append(t.as_py() or "")
            for name, own in texts.items():
                for part in _chunks(own):
                    values, counts = np.unique(ngrams(part), return_counts=True)
                    held.setdefault(name, []).append((values, counts))
                    size += len(values)
                    if size >= COUNTED:
                        yield from handed_on()
                        size = 0
        yield from handed_on()

    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    first = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length)
    lists: dict[str, list[int]] = {}
    for row in first.orderBy("lang", "rank").collect():  # languages x length rows
        lists.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(lists)


def _chunks(texts: list[str], size: int = 1 << 20) -> Iterator[str]:
    """The texts joined by spaces, in parts of about ``size`` characters."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield " ".join(part)
            part, held = [], 0
    if part:
        yield " ".join(part)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The input columns but the text in a struct ``doc``, with ``lang_pred`` and ``score``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_")]
    rows = docs.select(F.struct(*rest).alias("doc"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column("t")]
            yield pa.record_batch([batch.column("doc"), pa.array([x[0] for x in found], pa.string()),
                                   pa.array([x[1] for x in found], pa.float64())], ["doc", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def langid_query(docs: DataFrame) -> DataFrame:
    profiles = learn(docs.where(~_held_out()))
    rows = docs.select("doc_id", _held_out().alias("held_out"), "text")
    return identify(rows, profiles).select("doc.doc_id", "doc.held_out", "lang_pred", "score")
