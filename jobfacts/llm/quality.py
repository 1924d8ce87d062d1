"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is an integer column over the whole text; every rule compares two of them
as a percentage, so no rule depends on floating-point rounding.  No user functions run.

Defined results: a NULL or empty text has no words and fails the base rules; a document
is judged by itself, so repeated rows, ties and NULL in other columns have no effect;
an empty table gives an empty result.  Input columns whose names clash with a metric are
kept out of the way: ``apply_rules`` returns the input columns plus one struct column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import NOT_WHITE, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the", "this", "to",
    "was", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von",
    "zu",
    "au", "dans", "de", "du", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "en", "las", "los", "no", "por", "se", "su", "y",
)

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high``, asked of texts with ``min_words`` or more."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("capitals", "n_capitals", "word_chars", high=40),
    Rule("stop_words", "n_stop_words", "n_words", low=2, min_words=50),
    Rule("stutter", "n_stutter", "n_words", high=20),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
)


def _failed(rule: Rule, m) -> Column:
    part, whole = F.lit(100) * m(rule.part), m(rule.whole)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (part < F.lit(rule.low) * whole)
    if rule.high is not None:
        bad = bad | (part > F.lit(rule.high) * whole)
    return bad & (m("n_words") >= rule.min_words)


def _count_left(text: Column, others: str) -> Column:
    """Characters of ``text`` that the pattern ``others`` doesn't cover."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input columns in a struct ``doc`` beside one ``long`` column per metric."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    split = base.select(
        "doc", "t", words_of(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_WHITE)).alias("lines"))
    hashed = split.select(
        "doc", "t", "w", "lines", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    # one hash per window of five words, by its first word's position
    windows = hashed.select(
        "doc", "t", "w", "lines",
        F.when(F.size("h") >= WINDOW,
               F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW),
                           lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("win"))
    # the windows are sorted with their positions only in a text that repeats one
    ordered = windows.select(
        "doc", "t", "w", "lines",
        F.when(F.size(F.array_distinct("win")) < F.size("win"),
               F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("s"))
    found = ordered.select(
        "doc", "t", "w", "lines",
        F.sort_array(F.transform(
            F.filter("s", lambda x, k: F.coalesce(F.get("s", k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get("s", k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])).alias("at"))
    # a repeated window covers the words up to the next one's start, five at most
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    stop = [w for w in STOP_WORDS]
    return found.select(
        "doc",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count_left(F.col("t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _count_left(F.col("t"), r"[^\p{Lu}]+").alias("n_capitals"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter("w", lambda x, i: F.coalesce(x == F.get("w", i - 1), F.lit(False)))).cast("long").alias("n_stutter"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        covered.alias("n_repeat_words"))


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``base_failed``, ``failed`` (names of the rules broken) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PCT) * F.col("n_words"))
    broken = {r.name: _failed(r, F.col) for r in rules}
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()])) if rules else F.array().cast("array<string>")
    return measured.withColumns({
        "base_failed": base, "failed": names,
        "kept": ~base & ~reduce(Column.__or__, broken.values(), F.lit(False))})


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every input row: ``doc`` (struct of its columns), the metrics and the verdict."""
    return judge(measure(docs, text), rules)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input rows that pass, with the input columns.

    Rejected rows generate nothing: a filter would be pushed below the projections, where it
    would compute the metrics anew for every word."""
    judged = apply_rules(docs, text, rules)
    return judged.select(F.explode(F.when(F.col("kept"), F.array("doc"))).alias("doc")).select("doc.*")


def quality_query(docs: DataFrame) -> DataFrame:
    return apply_rules(docs).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_rule(rule: Rule) -> str:
    bad = [f"100 * {rule.part} {sign} {bound} * {rule.whole}"
           for sign, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
    return f"(({' OR '.join(bad)}) AND n_words >= {rule.min_words})"


def oracle_sql(source: str = "documents", rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB: one row per word and window instead of arrays; returns ``quality_query``'s rows."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {source}),
w AS (SELECT *, word = lag(word) OVER (PARTITION BY r ORDER BY p) AS same FROM (SELECT r, unnest(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'), 1) AS p FROM d)),
five AS (SELECT r, p, CASE WHEN lead(word, 4) OVER o IS NOT NULL THEN
             concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS g
         FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM five WHERE g IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r),
ww AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
              count(*) FILTER (WHERE lower(word) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)})) AS n_stop_words,
              count(*) FILTER (WHERE same) AS n_stutter FROM w GROUP BY r),
l AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
ll AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
              count(*) FILTER (WHERE regexp_matches(line, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')) AS n_ellipsis_lines,
              count(*) FILTER (WHERE regexp_matches(line, '^[\\x20\\x09-\\x0D]*[-*•]')) AS n_bullet_lines FROM l GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g'))::BIGINT AS n_capitals,
             coalesce(n_stop_words, 0)::BIGINT AS n_stop_words, coalesce(n_stutter, 0)::BIGINT AS n_stutter, coalesce(n_lines, 0)::BIGINT AS n_lines,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_ellipsis_lines, 0)::BIGINT AS n_ellipsis_lines,
             coalesce(n_bullet_lines, 0)::BIGINT AS n_bullet_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN ww USING (r) LEFT JOIN ll USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(map(_sql_rule, rules)) or "FALSE"}) AS kept FROM b"""
