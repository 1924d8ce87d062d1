"""License scans: winnowed fingerprints pick candidates, banded alignment reports matches.

Words are runs of letters and digits, lower-cased; a few stand for another ("released" for
"licensed").  Templates and their deciding words are in ``licensetexts``.  Their fingerprints
form an inverted index from hash to (template, position):

* Hashes of ``GRAM`` consecutive words are winnowed: of each ``WINNOW`` neighbours the smallest is
  kept, so a run of GRAM + WINNOW - 1 unchanged words is sure to be found.
* A template with deciding words, which must stand in a text exactly, has the hash of these
  words in a row as its fingerprint (its longest such row), looked up at all places.

Hits on neighbouring diagonals (document place - template place) are one candidate.  Its stretch of
the document is aligned with the whole template inside a band around its diagonals, and so is what
lies before and after a match: a match scores 1, a word substituted, inserted or missing costs 1;
document words before and after the match are free; nothing may change or come between
deciding words.  A match needs ``MIN_COVERAGE`` of the template's words.

Of matches that overlap, the best scored one stays, then the one with more words, then the
earlier one.  A version that no template has gives no match: a name that is followed by a further
digit, or a name without a version that is followed by one, is dropped.

Defined results: NULL, empty and wordless texts match nothing; templates without words are
refused; repeated rows report the same matches; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value
from jobfacts.llm.licensetexts import SAME_WORDS, templates
from jobfacts.llm.wordhash import mix, word_hashes

by_value(__name__)

GRAM, WINNOW = 3, 4
MIN_COVERAGE = 0.8
#: half width of the alignment band, beyond the candidate's own diagonals, as a share of the template
BAND = 0.15

_U = np.uint64


def _hash(words: list[str]) -> np.ndarray:
    return word_hashes(" ".join(words).encode())


_SAME_FROM = _hash(sorted(SAME_WORDS))
_SAME_TO = _hash([SAME_WORDS[w] for w in sorted(SAME_WORDS)])[np.argsort(_SAME_FROM)]
_SAME_FROM = np.sort(_SAME_FROM)
_DIGITS = np.sort(_hash([str(d) for d in range(10)]))
_VERSION = set(_hash(["version", "v"]).tolist())
_VERSIONED = set(_hash([f"v{d}" for d in range(10)]).tolist())


def same(words: np.ndarray) -> np.ndarray:
    """Word hashes with those of ``SAME_WORDS`` replaced."""
    if not len(words):
        return words
    at = np.minimum(np.searchsorted(_SAME_FROM, words), len(_SAME_FROM) - 1)
    return np.where(_SAME_FROM[at] == words, _SAME_TO[at], words)


class Template(NamedTuple):
    license: str
    part: str
    words: np.ndarray
    fixed: np.ndarray     # deciding words: the number of their row from 1, 0 for others
    ends: str             # "" or, for a template that ends in deciding words, "version" or "name"


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def template(name: str, text: str) -> Template:
    words, fixed = [], []
    for i, piece in enumerate(re.split(r"[\[\]]", text)):  # odd pieces stood in brackets
        own = _plain_words(piece)
        words += own
        fixed += [(i + 1) // 2 if i % 2 else 0] * len(own)
    if not words:
        raise ValueError("a template has no words")
    licence, _, part = name.partition(" ")
    ends = "" if not fixed[-1] or licence == "all-rights-reserved" else "version" if re.search(r"[0-9]", words[-1]) else "name"
    return Template(licence, part, same(_hash(words)), np.array(fixed), ends)


def _rows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words."""
    count = max(len(words) - n + 1, 0)
    total = np.full(count, n, dtype=_U)
    for i in range(n if count else 0):
        total = mix(total * _U(0x9E3779B97F4A7C15) + words[i:count + i])
    return total


def winnow(hashes: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Positions of the smallest hash of each window, the rightmost of equals."""
    if len(hashes) <= window:
        return np.arange(len(hashes)) if len(hashes) < window else np.array([len(hashes) - 1 - int(hashes[::-1].argmin())])
    rows = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(rows)) + window - 1 - rows.argmin(axis=1))


def _slack(length: int) -> int:
    return max(2, round(BAND * length))


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places in sorted ``known``, -1 for values that aren't there."""
    if not len(known) or not len(values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


class Index:
    """The templates' fingerprints, by hash or, for rows of deciding words, by their rarest word."""

    def __init__(self, table: dict[str, str]):
        self.templates = [template(n, table[n]) for n in sorted(table)]
        grams: dict[int, list[tuple[int, int]]] = {}
        rows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, t in enumerate(self.templates):
            if t.fixed.any():
                size, first = max((int((t.fixed == r).sum()), -int(np.flatnonzero(t.fixed == r)[0])) for r in range(1, int(t.fixed.max()) + 1))
                rows.setdefault(tuple(t.words[-first:-first + size].tolist()), []).append((i, -first))
            else:
                hashes = _rows(t.words, min(GRAM, len(t.words)))
                for at in winnow(hashes):
                    grams.setdefault(int(hashes[at]), []).append((i, int(at)))
        self.grams = np.array(sorted(grams), dtype=_U)
        self.gram_places = [grams[int(h)] for h in self.grams]
        often: dict[int, int] = {}
        for row in rows:
            for w in set(row):
                often[w] = often.get(w, 0) + 1
        by_word: dict[int, list[tuple[int, np.ndarray, list[tuple[int, int]]]]] = {}
        for row, places in rows.items():
            at = min(range(len(row)), key=lambda k: often[row[k]])
            by_word.setdefault(row[at], []).append((at, np.array(row, dtype=_U), places))
        self.rare = np.array(sorted(by_word), dtype=_U)
        self.rare_rows = [by_word[int(w)] for w in self.rare]

    def hits(self, words: np.ndarray) -> dict[int, set[int]]:
        """Diagonals on which a template and the text share a fingerprint."""
        found: dict[int, set[int]] = {}
        number = _in(words, self.rare)
        for p in np.flatnonzero(number >= 0).tolist():
            for at, row, places in self.rare_rows[number[p]]:
                if p >= at and np.array_equal(words[p - at:p - at + len(row)], row):
                    for i, own in places:
                        found.setdefault(i, set()).add(p - at - own)
        hashes = _rows(words, GRAM)
        number = _in(hashes, self.grams)
        if (number >= 0).any():
            kept = winnow(hashes)
            for p in kept[number[kept] >= 0].tolist():
                for i, own in self.gram_places[number[p]]:
                    found.setdefault(i, set()).add(p - own)
        return found

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of the bands to align in."""
        for i, found in sorted(self.hits(words).items()):
            slack, diagonals = _slack(len(self.templates[i].words)), sorted(found)
            low = high = diagonals[0]
            for d in diagonals[1:]:
                if d - high > slack or d - low > 2 * slack:
                    yield i, low - slack, high + slack
                    low = d
                high = d
            yield i, low - slack, high + slack


# alignment cells: score, matches and start in one number, so that a row is a few vector operations
_SCORE, _MATCH = 1 << 46, 1 << 34
_NONE = -(1 << 62)


def align(own: np.ndarray, words: np.ndarray, low: int, high: int, fixed: np.ndarray | None = None) -> tuple[int, int, int, int]:
    """(matches, score, start, end) of the best alignment of the whole template within diagonals
    low..high; matches is -1 if the deciding words can't be placed."""
    n, steps = len(own), np.arange(high - low + 1)
    row = np.where((low + steps >= 0) & (low + steps <= len(words)), low + steps, _NONE)
    for i in range(1, n + 1):
        at = low + i + steps  # document words before the cell
        inside = (at >= 1) & (at <= len(words))
        equal = np.zeros(len(steps), dtype=bool)
        equal[inside] = words[at[inside] - 1] == own[i - 1]
        decides = fixed is not None and fixed[i - 1] > 0
        new = np.where(inside & (row > _NONE), np.where(equal, row + (_SCORE + _MATCH), _NONE if decides else row - _SCORE), _NONE)
        if not decides:  # template word missing
            gone = np.append(row[1:], _NONE)
            new = np.maximum(new, np.where((gone > _NONE) & (at >= 0) & (at <= len(words)), gone - _SCORE, _NONE))
        if not (decides and i < n and fixed[i] == fixed[i - 1]):  # document words inserted, any number
            best = np.maximum.accumulate(np.where(new > _NONE, new + steps * _SCORE, _NONE))
            new = np.where((best > _NONE) & (at >= 0) & (at <= len(words)), best - steps * _SCORE, _NONE)
        row = new
    k = int(row.argmax())
    if row[k] == _NONE:
        return -1, -len(own), 0, 0
    score, rest = divmod(int(row[k]), _SCORE)
    return rest // _MATCH, score, rest % _MATCH, low + n + k


class Match(NamedTuple):
    template: int
    start: int
    end: int
    matched: int
    score: int


def _matches(t: Template, words: np.ndarray, low: int, high: int, least: float) -> Iterator[tuple[int, int, int, int]]:
    """(matches, score, start, end) of alignments with enough matches in a band, none over another."""
    n, middle = len(t.words), (low + high) // 2
    if 0 <= middle and high - low == 2 * _slack(n) < 2 * least * n and np.array_equal(words[middle:middle + n], t.words):
        yield n, n, middle, middle + n  # unchanged, on the candidate's one diagonal; its band leaves no room for another
        return
    todo = [(0, len(words))]
    while todo:
        a, b = todo.pop()
        a, b = max(a, low), min(b, high + len(t.words))  # words that the band can reach
        # no alignment has more matches than the template has words that stand there
        if b - a < least * len(t.words) or np.isin(t.words, words[a:b]).sum() < least * len(t.words):
            continue
        matches, score, start, end = align(t.words, words[a:b], low - a, high - a, t.fixed)
        if matches >= least * len(t.words):
            yield matches, score, a + start, a + end
            todo += [(a, a + start), (a + end, b)]


def _other_version(t: Template, words: np.ndarray, end: int) -> bool:
    """Whether the words after a match make it another version than the template's."""
    if not t.ends or end >= len(words):
        return False
    after = int(words[end])
    digit = lambda h: bool(np.isin(h, _DIGITS))
    if t.ends == "version":
        return digit(words[end])
    return after in _VERSIONED or digit(words[end]) or after in _VERSION and end + 1 < len(words) and digit(words[end + 1])


def best_of(found: list[Match]) -> list[Match]:
    """No two that overlap: by score, words, then place."""
    spans: list[tuple[int, int]] = []
    kept = []
    for m in sorted(set(found), key=lambda m: (-m.score, -m.matched, m.start, m.template)):
        at = bisect_left(spans, (m.start, m.end))
        if (at == 0 or spans[at - 1][1] <= m.start) and (at == len(spans) or m.end <= spans[at][0]):
            spans.insert(at, (m.start, m.end))
            kept.append(m)
    return sorted(kept, key=lambda m: m.start)


def scan_words(words: np.ndarray, index: Index, least: float = MIN_COVERAGE) -> list[tuple[str, str, int, int, int, int, float, bool]]:
    """(license, part, start, end, matched words, template words, coverage, exact) of all matches."""
    words, found = same(words), []
    for i, low, high in index.candidates(words):
        t = index.templates[i]
        for matches, score, start, end in _matches(t, words, low, high, least):
            if not _other_version(t, words, end):
                found.append(Match(i, start, end, matches, score))
    out = []
    for m in best_of(found):
        t = index.templates[m.template]
        n = len(t.words)
        out.append((t.license, t.part, m.start, m.end, m.matched, n, m.matched / n, m.matched == n == m.end - m.start))
    return out


def _plain(text):
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ").cast("binary")


def words_of_text(text: str) -> np.ndarray:
    return word_hashes(" ".join(_plain_words(text)).encode())


def scan(docs: DataFrame, table: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text",
         least: float = MIN_COVERAGE) -> DataFrame:
    """One row per match: doc_id, license, part, start_word, end_word, matched, template_words, coverage, exact."""
    index = Index(templates() if table is None else table)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _plain(F.col(f"`{text}`")).alias("t"))
    names = ["license", "part", "start_word", "end_word", "matched", "template_words", "coverage", "exact"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *x) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("t"))
                     for x in scan_words(word_hashes(t.as_py()), index, least)]
            columns = list(zip(*found)) or [[]] * 9
            yield pa.record_batch([pa.array(columns[0], batch.column("doc_id").type), *[pa.array(c, k) for c, k in zip(columns[1:], kinds)]],
                                  ["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, license string, part string, start_word long, end_word long, matched long, template_words long, "
                                "coverage double, exact boolean")


def license_query(docs: DataFrame) -> DataFrame:
    return scan(docs)
