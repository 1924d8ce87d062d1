"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words that a fixed mask selects from a window; words under a 0
are ignored, so a substitution there leaves the seed as it was.  Seeds of the benchmark
items are joined with the seeds of the documents.  Around each hit, the item is laid over
the document on the hit's diagonal and the best stretch of ``STRETCH`` words (the whole
item, if shorter) that holds the hit is verified: at least ``SHARE`` percent of its words
must agree in place.

No allowed stretch is missed: the two masks are a pair of which one at least fits somewhere
into 13 words, wherever two of them are changed.  Items shorter than a stretch may have
k = 20 % of their words changed, rounded down; then n // (k + 1) words in a row are unchanged
somewhere, and runs of that length are their seeds (the whole item below five words).
Which run lengths are needed is read from the items, so a benchmark without short items costs none.

Words are runs of letters and digits, lower-cased.  The benchmark's seeds are broadcast
when their count, taken first, is at most ``MAX_BROADCAST``; above that they are shuffled
and joined with salted document seeds.

Defined results: NULL or empty texts have no words and match nothing; items without a word
match nothing; items with equal words count as one, under their smallest item_id;
rows with equal doc_id and text are one document; an empty table on either side gives an
empty result.  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import cut, salted_join

#: all of one span
MASKS = ("11101011", "11001111")
STRETCH = 13
SHARE = 80
MAX_BROADCAST = 1_000_000


def _word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""),
                       lambda w: F.xxhash64(w))


def _seeds(words: str, masks: tuple[str, ...]) -> Column:
    """The seeds of all windows, one mask after the other."""
    last = F.size(words) - len(masks[0])

    def of(number: int, mask: str) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
            F.lit(number), *[F.get(words, i + k) for k, bit in enumerate(mask) if bit == "1"]))

    return F.when(last >= 0, F.concat(*[of(n, m) for n, m in enumerate(masks)])).otherwise(F.array().cast("array<bigint>"))


def _exploded(df: DataFrame, words: str, masks: tuple[str, ...], keep: list[str], at: str) -> DataFrame:
    """One row per seed: the kept columns, h and the window's first word ``at``."""
    seeded = df.select(*keep, F.size(words).alias("_n"), _seeds(words, masks).alias("_s"))
    span = len(masks[0])
    # the outer form: for the other, a filter on size(_s) is inferred and pushed below the
    # projections, where it would hash all words anew for every window
    return (seeded.select(*keep, "_n", F.posexplode_outer("_s").alias("_i", "h")).where("h IS NOT NULL")
            .select(*keep, "h", (F.col("_i") % (F.col("_n") - (span - 1))).alias(at)))


def run_length(n: int, share: int = SHARE) -> int:
    """Words in a row that stay unchanged somewhere in n words if ``share`` percent of them do."""
    return n // (n * (100 - share) // 100 + 1)


def _verified(hits: DataFrame) -> DataFrame:
    """Adds ``agree``, the words that agree in the best stretch around the hit."""
    length = F.least(F.size("iw"), F.lit(STRETCH))
    span = F.col("span")
    agrees = hits.select(
        "doc_id", "th", "item_id", "ip", "dp", "span", length.alias("stretch"), F.size("iw").alias("item_words"),
        F.transform("iw", lambda x, i: F.when((F.col("dp") - F.col("ip") + i >= 0)
                                              & (F.get("dw", F.col("dp") - F.col("ip") + i) == x), 1).otherwise(0)).alias("m"))
    first = F.greatest(F.col("ip") + span - F.col("stretch"), F.lit(0))
    last = F.least(F.col("ip"), F.size("m") - F.col("stretch"))
    best = F.array_max(F.transform(F.sequence(first, last), lambda s: F.aggregate(
        F.slice("m", s + 1, F.col("stretch")), F.lit(0), lambda acc, x: acc + x)))
    return (agrees.withColumn("agree", best).where(F.col("agree") * 100 >= F.col("stretch") * SHARE)
            .select("doc_id", "th", "item_id", "item_words", "stretch", "agree", (F.col("dp") - F.col("ip")).alias("offset")))


def _hits(corpus: DataFrame, bench: DataFrame, masks: tuple[str, ...], max_broadcast: int) -> DataFrame:
    """Places (ip in an item, dp in a document) that share a seed of one group of masks."""
    seeds = _exploded(bench, "iw", masks, ["item"], "ip").distinct()
    if seeds.count() <= max_broadcast:
        hits = (_exploded(corpus, "dw", masks, ["doc_id", "th", "dw"], "dp").join(F.broadcast(seeds), "h")
                .join(F.broadcast(bench), "item"))
    else:
        found = salted_join(_exploded(corpus, "dw", masks, ["doc_id", "th"], "dp"), seeds, ["h"]).drop("h").distinct()
        whole = corpus.withColumnsRenamed({"doc_id": "_id", "th": "_th"}).distinct()
        hits = found.join(whole, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).join(bench, "item")
    return hits.select("doc_id", "th", "item_id", "ip", "dp", "iw", "dw", F.lit(len(masks[0])).alias("span"))


def overlaps(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
             item_id: str = "item_id", masks: tuple[str, ...] = MASKS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per (document, item) that overlap: doc_id, th (hash of the text), item_id,
    item_words, stretch, agree and offset (the document word under the item's first)."""
    if len({len(m) for m in masks}) != 1 or any(set(m) - {"0", "1"} for m in masks):
        raise ValueError("masks are strings of 0 and 1 of one length")
    bench = (items.select(F.col(f"`{item_id}`").alias("item_id"), _word_hashes(F.col(f"`{item_text}`")).alias("iw"))
             .groupBy("iw").agg(F.min("item_id").alias("item_id")).where(F.size("iw") > 0))
    bench = cut(bench.select(F.xxhash64("iw").alias("item"), "item_id", "iw"), "items")
    short = [r["n"] for r in bench.where(F.size("iw") < STRETCH).select(F.size("iw").alias("n")).distinct().collect()]  # 12 at most
    groups = [(masks, F.size("iw") >= STRETCH)]
    for run in sorted({run_length(n) for n in short}):
        groups.append((("1" * run,), F.size("iw").isin(*[n for n in short if run_length(n) == run])))
    corpus = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("th"),
                         _word_hashes(F.col(f"`{text}`")).alias("dw"))
    hits = reduce(DataFrame.unionByName, [_hits(corpus, bench.where(own), m, max_broadcast) for m, own in groups])
    best = F.max(F.struct("agree", F.col("offset"), "stretch", "item_words")).alias("b")
    return (_verified(hits).groupBy("doc_id", "th", "item_id").agg(best)
            .select("doc_id", "th", "item_id", "b.item_words", "b.stretch", "b.agree", "b.offset"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that overlap with no item, input columns only."""
    leaks = overlaps(docs, items).select(F.col("doc_id").alias("__id"), F.col("th").alias("__hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hash"))
    return docs.join(leaks, same, "left_anti")


def decontamination_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return overlaps(docs, items).select("doc_id", "item_id", "item_words", "agree")


def oracle_sql(source: str = "documents", masks: tuple[str, ...] = MASKS) -> str:
    """DuckDB: all places where a document's word equals an item's, by diagonal; seeds and
    stretches are then looked up among the places of a diagonal."""
    fits = " OR ".join("list_has_all(places, [" + ", ".join(f"p + {k}" for k, b in enumerate(m) if b == "1") + "])" for m in masks)
    agree = "len(list_filter(places, lambda x: x >= s AND x < s + stretch))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {source}),
b AS (SELECT min(item_id) AS item_id, w FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark) GROUP BY w HAVING len(w) > 0),
dw AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
bw AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM b),
g AS (SELECT r, item_id, dw.p - bw.p AS diag, list(bw.p) AS places FROM dw JOIN bw USING (word) GROUP BY r, item_id, dw.p - bw.p),
c AS (SELECT g.*, len(w) AS n, least(len(w), {STRETCH}) AS stretch,
             CASE WHEN len(w) < {STRETCH} THEN len(w) // (len(w) * {100 - SHARE} // 100 + 1) ELSE {len(masks[0])} END AS span
      FROM g JOIN b USING (item_id) WHERE 100 * len(places) >= {SHARE} * least(len(w), {STRETCH})),
h AS (SELECT * FROM (SELECT *, unnest(range(1, n - span + 2)) AS p FROM c)
      WHERE CASE WHEN n < {STRETCH} THEN list_has_all(places, range(p, p + span)) ELSE {fits} END),
t AS (SELECT *, unnest(range(greatest(p + span - stretch, 1), least(p, n - stretch + 1) + 1)) AS s FROM h),
v AS (SELECT r, item_id, n, {agree} AS agree, stretch FROM t WHERE 100 * {agree} >= {SHARE} * stretch)
SELECT DISTINCT doc_id, item_id, item_words, agree FROM (
    SELECT doc_id, item_id, n::INTEGER AS item_words, max(agree)::INTEGER AS agree FROM v JOIN d USING (r) GROUP BY r, doc_id, item_id, n)"""
