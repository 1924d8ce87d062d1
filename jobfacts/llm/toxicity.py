"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon is learned: words, and beginnings of words, that toxic documents hold far more
often than others, with a weight each.  All its terms form one trie.  A word is run through
the intersection of the trie with the terms' Levenshtein automata, built lazily as a
deterministic automaton, so a misspelled term is caught within the term's edit bound and
most words die after a few characters.

Each hit is scored in its context window: a term in quotation marks or after a word of
reporting counts as quoted, one near an address in the second person as directed.  The
weighted hits of a document are features of a logistic regression.

Lexicon and regression are fitted on a bounded sample of labelled rows (``SAMPLE`` of each
label, those whose hashed id is smallest); every other row is scored over its whole text.

Defined results: a NULL or empty text has no hits and gets the score of such texts; labels
without a document, documents without a label and NULL labels take no part in learning; if
one label is missing from the sample, all documents get score 0; repeated rows get equal
scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

#: labelled rows of each label that learning reads
SAMPLE = 5_000
#: terms in the lexicon, at most
LEXICON = 1_000
#: toxic documents that a term must occur in, and how much likelier there
SUPPORT, RATIO = 5, 20.0
STEMS = (5, 6, 7)
#: term lengths from which one, and two, edits are allowed
ONE_EDIT, TWO_EDITS = 6, 11
WINDOW = 6
REMEMBERED = 300_000

# Words of reporting and of address in English, German, French and Spanish.
_REPORTS = frozenset("said says say called calls call wrote writes quote quoted quotes term word sagte sagt nannte schrieb wort "
                     "dit disait appelle mot dijo dice llama palabra".split())
_ADDRESS = frozenset("you your yours youre u du dich dir dein deine ihr euch tu toi te ton ta vous votre ti usted tus vosotros".split())
_QUOTES = "\"“”„«»‘’"
_LOOKS = str.maketrans("013457@$", "oieastas")
_TOKEN = re.compile(r"[\w@$]+")


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        return 2 if len(self.text) >= TWO_EDITS else 1 if len(self.text) >= ONE_EDIT else 0


class Automaton:
    """The intersection of a trie of terms with their Levenshtein automata.

    A state is a set of (trie node, edits used).  States and moves are made when needed."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.bound = [0]
        self.ends: list[int] = [-1]
        for number, term in enumerate(terms):
            node = 0
            self.bound[0] = max(self.bound[0], term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.bound.append(0)
                    self.ends.append(-1)
                node = self.children[node][c]
                self.bound[node] = max(self.bound[node], term.edits)
            self.ends[node] = number
        self.alphabet = {c for x in self.children for c in x}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[int, int] | None] = []  # best (term, edits) if the word ends here
        self.stems: list[tuple[int, int] | None] = []  # best (stem, edits) already passed
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        queue = list(items)
        while queue:  # a character of the term may be missing from the word
            node, used = queue.pop()
            for child in self.children[node].values():
                if used < self.bound[child] and (child, used + 1) not in items:
                    items.add((child, used + 1))
                    queue.append((child, used + 1))
        least: dict[int, int] = {}
        for node, used in items:
            least[node] = min(used, least.get(node, used))
        own = frozenset(least.items())
        if own not in self.states:
            self.states[own] = len(self.sets)
            self.sets.append(own)
            self.moves.append({})
            ends = sorted((used, n) for node, used in own if (n := self.ends[node]) >= 0 and used <= self.terms[n].edits)
            stems = [x for x in ends if self.terms[x[1]].stem]
            self.found.append((ends[0][1], ends[0][0]) if ends else None)
            self.stems.append((stems[0][1], stems[0][0]) if stems else None)
        return self.states[own]

    def _move(self, state: int, c: str) -> int:
        items = set()
        for node, used in self.sets[state]:
            for letter, child in self.children[node].items():
                if letter == c:
                    items.add((child, used))
                elif used < self.bound[child]:
                    items.add((child, used + 1))
            if used < self.bound[node]:
                items.add((node, used + 1))
        return self._state(items)

    def match(self, word: str) -> tuple[int, int] | None:
        """The nearest term that the word, or its beginning for a stem, is within bounds of."""
        state, best, alphabet, moves = self.start, None, self.alphabet, self.moves
        for c in word:
            if c not in alphabet:
                c = ""
            after = moves[state].get(c)
            if after is None:
                after = moves[state][c] = self._move(state, c)
            state = after
            stem = self.stems[state]
            if stem and (best is None or stem[1] < best[1]):
                best = stem
            if not self.sets[state]:
                return best
        end = self.found[state]
        return end if end and (best is None or end[1] <= best[1]) else best


#: features: log of words; hits by weight that are plain, directed or quoted; near hits; hits per 100 words
FEATURES = 6


@dataclass
class Model:
    automaton: Automaton
    weights: list[float] = field(default_factory=lambda: [0.0] * (FEATURES + 1))
    fitted: bool = False

    def __post_init__(self):
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, int]] = {}

    def _look_up(self, words: list[str]) -> set[str]:
        """The distinct words that match a term."""
        own = set(words)
        for word in own - self.clean - self.hits.keys():
            hit = self.automaton.match(word) or (self.automaton.match(word.translate(_LOOKS)) if not word.isalpha() else None)
            if hit:
                self.hits[word] = hit
            else:
                self.clean.add(word)
        found = own & self.hits.keys()
        if len(self.clean) > REMEMBERED:
            self.clean.clear()
        if len(self.hits) > REMEMBERED:
            self.hits = {w: self.hits[w] for w in found}
        return found

    def spans(self, text: str) -> list[dict]:
        """Every hit: start, end, term, edits, quoted, directed."""
        lower = text.lower()
        if len(lower) != len(text):  # a few letters grow; positions are those of the lower-cased text
            text = lower
        places = list(_TOKEN.finditer(lower))
        words = [m.group() for m in places]
        found = self._look_up(words)
        out = []
        marks = [m.start() for m in re.finditer(f"[{_QUOTES}\n]", text)] if found else []
        for i, word in enumerate(words):
            if word not in found:
                continue
            start, end = places[i].span()
            number, edits = self.hits[word]
            before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
            out.append({"start": start, "end": end, "term": self.automaton.terms[number].text, "edits": edits,
                        "weight": self.automaton.terms[number].weight, "quoted": bool(_REPORTS & set(before)) or _inside(text, marks, start, end),
                        "directed": bool(_ADDRESS & set(before + after))})
        return out

    def features(self, text: str | None) -> list[float]:
        words = _TOKEN.findall((text or "").lower())
        if not self._look_up(words):
            return [math.log1p(len(words)), 0.0, 0.0, 0.0, 0.0, 0.0]
        plain = directed = quoted = near = 0.0
        hits = self.spans(text)
        for h in hits:
            near += h["edits"] > 0
            if h["quoted"]:
                quoted += h["weight"]
            elif h["directed"]:
                directed += h["weight"]
            else:
                plain += h["weight"]
        return [math.log1p(len(words)), math.log1p(plain), math.log1p(directed), math.log1p(quoted), math.log1p(near),
                math.log1p(100.0 * len(hits) / max(len(words), 1))]

    def score(self, text: str | None) -> float:
        if not self.fitted:
            return 0.0
        z = self.weights[-1] + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _inside(text: str, marks: list[int], start: int, end: int) -> bool:
    """Whether quotation marks of one line enclose the span."""
    from bisect import bisect_left

    at = bisect_left(marks, start)
    left = [p for p in marks[max(0, at - 1):at] if text[p] != "\n"]
    right = [p for p in marks[bisect_left(marks, end):bisect_left(marks, end) + 1] if text[p] != "\n"]
    if not left or not right:
        return False
    # an even number of marks between line start and span means the span is outside
    n = 0
    for p in reversed(marks[:at]):
        if text[p] == "\n":
            break
        n += 1
    return n % 2 == 1


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> list[float]:
    """Logistic regression with an intercept (last weight) by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(text, toxic) of ``size`` labelled documents of each label, one row a document.

    The smallest hashes of a label are a top-k: every task keeps its own ``size``.  A doc_id that
    repeats counts once, with its smallest text, however many rows it has."""
    known = labels.where("doc_id IS NOT NULL").select("doc_id", "toxic").distinct()
    picked = reduce(DataFrame.unionByName, [known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
                                            for label in (0, 1)])
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # 2 * size ids
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")  # 2 * size rows at most


def lexicon(sample: DataFrame, size: int = LEXICON) -> list[Term]:
    """Words and stems that are far more frequent in toxic texts."""
    token = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_@$]+)"), 1))
    words = sample.where("text IS NOT NULL").select("toxic", token.alias("w"))
    stems = [F.transform(F.filter("w", lambda x, n=n: F.length(x) > n), lambda x, n=n: F.struct(x.substr(F.lit(1), F.lit(n)).alias("t"), F.lit(True).alias("stem")))
             for n in STEMS]
    whole = F.transform("w", lambda x: F.struct(x.alias("t"), F.lit(False).alias("stem")))
    counted = (words.select("toxic", F.explode(F.array_distinct(F.concat(whole, *stems))).alias("x"))
               .groupBy("x.t", "x.stem").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    sizes = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    ratio = ((F.col("bad") + 0.5) / (sizes[1] + 1)) / ((F.col("good") + 0.5) / (sizes[0] + 1))
    best = (counted.where((F.col("bad") >= SUPPORT) & (ratio >= RATIO)).select("t", "stem", "bad", F.log(ratio).alias("w"))
            .orderBy(F.col("bad").desc(), "t", "stem").limit(size * 8).collect())
    terms: list[Term] = []
    held: set[str] = set()
    for row in best:  # a term that an accepted stem covers adds nothing
        if len(terms) < size and not any(row["t"][:n] in held for n in STEMS):
            terms.append(Term(row["t"], bool(row["stem"]), float(row["w"])))
            if row["stem"]:
                held.add(row["t"])
    return terms


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    sample = _sample(docs, labels, size)
    model = Model(Automaton(lexicon(sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([model.features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64())),
                                   batch.column("toxic")], ["x", "y"])

    rows = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(run, "x array<double>, y long").collect()
    y = np.array([r["y"] for r in rows], dtype=float)
    if len(set(y.tolist())) == 2:
        order = sorted(range(len(rows)), key=lambda i: (rows[i]["y"], rows[i]["x"]))
        model.weights = regression(np.array([rows[i]["x"] for i in order]), y[order])
        model.fitted = True
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The input columns but the text in a struct ``doc``, with ``score`` and the number of hits."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_")]
    rows = docs.select(F.struct(*rest).alias("doc"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column("t")]
            yield pa.record_batch([batch.column("doc"), pa.array(scores, pa.float64())], ["doc", "score"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def hits(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per hit: doc_id and its span, term, edits and context."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    kinds = {"start": pa.int64(), "end": pa.int64(), "term": pa.string(), "edits": pa.int64(), "weight": pa.float64(),
             "quoted": pa.bool_(), "directed": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, h) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("t")) for h in model.spans(t.as_py() or "")]
            yield pa.record_batch([pa.array([i for i, _ in found], batch.column("doc_id").type),
                                   *[pa.array([h[k] for _, h in found], t) for k, t in kinds.items()]], ["doc_id", *kinds])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, end long, term string, edits long, weight double, quoted boolean, directed boolean")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels.where(~_held_out()))
    rows = docs.select("doc_id", _held_out().alias("held_out"), "text")
    return score(rows, model).select("doc.doc_id", "doc.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
