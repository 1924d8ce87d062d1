"""Personal data in whole texts: patterns propose, validators confirm, context adjusts.

Four base kinds are found by fixed patterns, leftmost and non-overlapping per kind: email
addresses, IP addresses (parts up to 255), card numbers (13 to 19 digits that pass Luhn)
and phone numbers (9 to 15 digits).  A match that fails its test goes, without a retry.

The method adds kinds of its own: bank accounts (IBAN, length by country and mod-97), social
security numbers, bank routing numbers (weights 3, 7, 1), health service numbers (mod 11) and
dates of birth (real dates).  Each proposal starts from its kind's prior; a validator that confirms
it, and words near it that name such data or speak of examples and other numbers, move the
score.  Added spans need ``MIN_SCORE``; base spans carry a score too and stay whatever it is.
An added span that overlaps a base span, or a better added one, goes.

Proposals take time linear in the text.  Numbers are looked for only inside runs of digits and
their separators, found in one pass; patterns on a run begin where the last attempt ended
or are possessive.

Defined results: NULL and empty texts have no span; offsets are code points, ends
exclusive; digits are 0 to 9 alone; texts of any length are read whole; rows with equal texts
get equal spans; an empty table gives an empty result.  Other columns, whatever their names,
take no part.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from datetime import date
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "routing", "health", "birth")
MIN_SCORE = 0.5
#: characters on either side in which context words count
CONTEXT = 60

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_RUN = re.compile(r"[0-9][0-9\x20./-]*+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})([\x20-])([0-9]{2})\2([0-9]{4})(?![0-9-])")
_NINE = re.compile(r"(?<![0-9-])[0-9]{9}(?![0-9-])")
_HEALTH = re.compile(r"(?<![0-9-])[0-9]{3}[\x20-]?[0-9]{3}[\x20-]?[0-9]{4}(?![0-9-])")
_DATE = re.compile(r"(?<![0-9./-])([0-9]{1,4})([./-])([0-9]{1,2})\2([0-9]{1,4})(?![0-9./-])")

# Account number lengths by country code.
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26,
    "UA": 29, "VG": 24, "XK": 20}


class Rule(NamedTuple):
    """Score of a proposal: prior, gain when its validator confirms it, gain per side of context."""

    prior: float
    confirmed: float
    near: float
    words: frozenset[str]


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: words near a span that name its kind (the score rises once, however many there are)
RULES = {
    "email": Rule(0.8, 0.1, 0.1, _words("email e-mail mail contact reach write courriel correo kontakt")),
    "ip": Rule(0.5, 0.1, 0.3, _words("ip address host server client adresse login")),
    "card": Rule(0.3, 0.4, 0.3, _words("card credit visa mastercard amex debit karte carte tarjeta payment cvv expires")),
    "phone": Rule(0.6, 0.1, 0.3, _words("phone tel telephone call mobile cell fax whatsapp telefon téléphone teléfono")),
    "iban": Rule(0.1, 0.7, 0.2, _words("iban account bank konto compte cuenta transfer")),
    "ssn": Rule(0.2, 0.1, 0.5, _words("ssn social security taxpayer")),
    "routing": Rule(0.0, 0.2, 0.5, _words("routing aba rtn")),
    "health": Rule(0.0, 0.2, 0.5, _words("nhs patient")),
    "birth": Rule(0.1, 0.0, 0.6, _words("born birth birthday birthdate dob geboren né née nacido nacida")),
}
#: words near a span that speak of examples or of other numbers
_AGAINST = _words("example sample dummy test fake placeholder version isbn invoice order sku serial")
_LOSS = 0.4
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    confirmed: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Country and check digits to the end, letters as 10 to 35: the remainder must be 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[Span]:
    done = 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        left = text[max(done, text.rfind("@", done, at) + 1):at]  # no @ is part of a name
        own = len(left) - len(left.rstrip(_LOCAL))
        if own:
            done = m.end()
            yield Span("email", at - own, done, True)


def _runs(text: str) -> list[tuple[int, int]]:
    """All digits of a text with what may part them inside a number: ``[0-9][0-9 ./-]*``."""
    return [m.span() for m in _RUN.finditer(text)]


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    """The spans of the four base kinds, by kind and start."""
    runs = _runs(text) if runs is None else runs
    found = list(_emails(text)) if "@" in text else []
    found += [Span("ip", *m.span(), True) for a, b in runs if b - a >= 7
              for m in _IP.finditer(text, a, b) if all(_small(p) for p in m[0].split("."))]
    for a, b in runs:
        if b - a < 13:
            continue
        for m in _CARD.finditer(text, a, b):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(Span("card", *m.span(), True))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(Span("phone", *m.span(), True))
    return found


def _real_date(a: str, b: str, c: str) -> bool:
    """Year first, or day and month in either order before a year of four digits."""
    orders = [(a, b, c)] if len(a) == 4 else [(c, a, b), (c, b, a)] if len(c) == 4 else []
    for y, m, d in orders:
        if len(m) > 2 or len(d) > 2 or not 1900 <= int(y) <= 2100:
            continue
        try:
            date(int(y), int(m), int(d))
            return True
        except ValueError:
            pass
    return False


def _iban(text: str, start: int) -> Span | None:
    """The account whose check digits are at ``start``, if its two letters stand before them."""
    m = _IBAN.match(text, start - 2) if start >= 2 and not (start > 2 and text[start - 3].isalnum()) else None
    plain = m[0].replace(" ", "") if m else ""
    length = _IBAN_LENGTHS.get(plain[:2], 0)
    if not length or len(plain) < length or not mod97(plain[:length]):
        return None
    end, seen = m.start(), 0
    while seen < length:  # words that follow the account are not part of it
        seen += text[end] != " "
        end += 1
    return Span("iban", m.start(), end, True) if end == m.end() or text[end] == " " else None


def proposals(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    """Spans of the added kinds, tested but not scored."""
    found = []
    for a, b in _runs(text) if runs is None else runs:
        if account := _iban(text, a):
            found.append(account)
        if b - a < 8:
            continue
        for m in _SSN.finditer(text, a, b):
            if m[1] not in ("000", "666") and m[1] < "900" and m[3] != "00" and m[4] != "0000":
                found.append(Span("ssn", *m.span(), True))
        for m in _NINE.finditer(text, a, b):
            if sum(w * (ord(d) - 48) for w, d in zip((3, 7, 1) * 3, m[0])) % 10 == 0:
                found.append(Span("routing", *m.span(), True))
        for m in _HEALTH.finditer(text, a, b):
            digits = m[0].replace(" ", "").replace("-", "")
            check = -sum((10 - i) * (ord(d) - 48) for i, d in enumerate(digits[:9])) % 11
            if check < 10 and check == ord(digits[9]) - 48:
                found.append(Span("health", *m.span(), True))
        for m in _DATE.finditer(text, a, b):
            if _real_date(m[1], m[3], m[4]):
                found.append(Span("birth", *m.span(), False))
    return found


def score(text: str, span: Span) -> float:
    """Prior, validator and the words of ``CONTEXT`` characters on either side."""
    rule = RULES[span.kind]
    near = set(_WORD.findall((text[max(0, span.start - CONTEXT):span.start] + " " + text[span.end:span.end + CONTEXT]).lower()))
    value = rule.prior + (rule.confirmed if span.confirmed else 0.0) + (rule.near if near & rule.words else 0.0)
    return round(min(1.0, max(0.0, value - (_LOSS if near & _AGAINST else 0.0))), 3)


def scored_spans(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, bool, float]]:
    """All spans (kind, start, end, confirmed, score), by kind as in ``KINDS``, then start."""
    text = text or ""
    runs = _runs(text)
    base = base_spans(text, runs)
    kept = [(s, score(text, s)) for s in base]
    added = sorted(((s, score(text, s)) for s in proposals(text, runs)), key=lambda x: (-x[1], x[0].start, KINDS.index(x[0].kind)))
    added = [x for x in added if x[1] >= min_score]
    if added:
        taken = sorted((s.start, s.end) for s in base)
        for s, value in added:
            if _free(taken, s):
                kept.append((s, value))
    kept.sort(key=lambda x: (KINDS.index(x[0].kind), x[0].start))
    return [(*s, value) for s, value in kept]


def _free(taken: list[tuple[int, int]], span: Span) -> bool:
    """Adds the span to the sorted ``taken`` unless it overlaps one.  Those of one kind don't
    overlap, so at most one neighbour per kind can reach over the nearest start."""
    at = bisect_left(taken, (span.start, span.start))
    near = taken[max(0, at - len(KINDS)):at + 1]
    if any(a < span.end and span.start < b for a, b in near):
        return False
    insort(taken, (span.start, span.end))
    return True


_SPANS = "array<struct<kind:string,start:long,end:long,confirmed:boolean,score:double>>"


def personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), min_score: float = MIN_SCORE) -> DataFrame:
    """The columns ``keep`` with ``spans``, ordered by kind and start."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confirmed", pa.bool_()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "confirmed", "score")
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in scored_spans(t.as_py(), min_score)] for t in batch.column("text")]
            yield pa.record_batch([batch.column("row"), pa.array(spans, kind)], ["row", "spans"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, spans {_SPANS}").select("row.*", "spans")


def masked(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; of spans that
    overlap, the union is replaced, by the kind of the first."""
    columns = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    def cover(value: str | None) -> str | None:
        if value is None:
            return None
        out, at, reach = [], 0, 0
        for kind, start, end, _, _ in sorted(scored_spans(value, min_score), key=lambda s: (s[1], -s[2])):
            if start >= reach:
                out += [value[at:start], f"[{kind.upper()}]"]
            at = reach = max(reach, end)
        return "".join([*out, value[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("row"), pa.array([cover(t.as_py()) for t in batch.column("text")], pa.string())], ["row", "text"])

    made = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return made.select(*[F.col("text").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def pii_query(docs: DataFrame) -> DataFrame:
    found = personal_data(docs)
    base = _of(*BASE)
    counts = [F.size(_of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
