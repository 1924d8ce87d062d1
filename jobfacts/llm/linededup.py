"""Line dedup: a deletion-neighbourhood join over all lines of all documents.

A line (trimmed; blank ones are left alone) goes when an earlier line of any document is
equal to it or, for lines of ``min_fuzzy`` characters or more, one character insertion,
deletion or substitution away.  Earlier means a smaller (doc_id, line number).

Variants are emitted in two steps that together lose no pair within the bound:

1. A line of n characters is cut into pieces.  One edit leaves all pieces but one as they
   are, so equal keys "line without piece j" hold every close pair.  A line emits the keys
   of its own length and, as the longer partner, of the length below.
2. Lines that share a key with a different line emit every one-character deletion of the
   piece left out, as hashes.  Equal variants with the same position are substitutions of
   one another; a variant equal to a whole shorter piece is an insertion.

Groups are reduced to their earliest line by aggregation, so a group of any size costs one
row a member.  The edit distance to that line is then verified.

What is found about a document's lines goes back to it as one list.  A doc_id of one row makes one
list, no longer than its text.  Rows that share a doc_id (or have none) are cut into lines
instead and joined line by line; their lists are made per (doc_id, hash of text).  So no
list is longer than a text, whatever share of the rows one doc_id holds.

Defined results: NULL text counts as empty; empty and blank lines stay; rows that repeat a
(doc_id, line number) are not earlier than one another, so repeated rows keep or lose the
same lines; NULL doc_id sorts first; an empty table gives an empty result.  Other columns
pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobfacts.llm.common import cut, salted_join

PIECE = 256
MIN_FUZZY = 20
#: entries, of about 40 bytes, that lists of line numbers may hold together to be broadcast
MAX_ENTRIES = 1_500_000
_TRIM = " \t\x0b\x0c\r"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(_TRIM))


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per non-blank line: doc_id, line_no, line (trimmed), h1."""
    split = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                        F.posexplode(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n")).alias("line_no", "raw"))
    return (split.select("doc_id", "line_no", _trim(F.col("raw")).alias("line")).where(F.col("line") != "")
            .select("doc_id", "line_no", "line", F.xxhash64("line").alias("h1")))


def _equal_lines(lines: DataFrame) -> DataFrame:
    """Lines equal to an earlier one; two 64-bit hashes stand for the line."""
    marked = cut(lines.select("h1", F.xxhash64(F.lit(1), "line").alias("h2"), "doc_id", "line_no"), "lines")
    repeated = cut(marked.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "line_no")).alias("first"))
                   .where("n > 1").drop("n"), "equal-lines")
    return (salted_join(marked, repeated, ["h1", "h2"]).select("h1", F.struct("doc_id", "line_no").alias("pos"), "first")
            .where("first < pos").select("h1", "pos", "first", F.lit(0).alias("edits")))


def _piece_size(n: Column) -> Column:
    pieces = F.greatest(F.lit(2), F.ceil(n / F.lit(PIECE))).cast("int")
    return F.ceil(n / pieces).cast("int")


def _keys(lines: DataFrame, min_fuzzy: int) -> DataFrame:
    """Rows (k, j, longer, h1, doc_id, line_no): the line without its piece j."""
    sized = (lines.withColumn("n", F.length("line")).where(F.col("n") >= min_fuzzy)
             .withColumns({"own": _piece_size(F.col("n")), "less": _piece_size(F.col("n") - 1)}))

    def hashes(size: str, n: Column, shift: int) -> Column:
        last = F.ceil(n / F.col(size)).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last),
                           lambda j: F.xxhash64(F.substring(F.col("line"), j * F.col(size) + (1 + shift), F.col(size))))

    pieces = sized.select("doc_id", "line_no", "h1", "n", hashes("own", F.col("n"), 0).alias("a"),
                          hashes("less", F.col("n") - 1, 0).alias("b"), hashes("less", F.col("n") - 1, 1).alias("c"))

    def without(before: str, after: str, n: Column, longer: bool) -> Column:
        return F.transform(before, lambda _, j: F.struct(
            F.xxhash64(n, j, F.slice(before, F.lit(1), j), F.slice(after, j + 2, F.size(after))).alias("k"),
            j.alias("j"), F.lit(longer).alias("longer")))

    return pieces.select("doc_id", "line_no", "h1", F.inline(F.concat(
        without("a", "a", F.col("n"), False), without("b", "c", F.col("n") - 1, True))))


def _list_join(texts: DataFrame, lists: DataFrame, entries: str, on, how: str = "inner") -> DataFrame:
    """A join with a written table of lists, which is broadcast if all of them are counted to be short."""
    total = lists.agg(F.sum(F.size(entries) + 1).alias("n")).first()["n"] or 0
    return texts.join(F.broadcast(lists) if total <= MAX_ENTRIES else lists, on, how)


def _shared_ids(docs: DataFrame, doc_id: str) -> DataFrame | None:
    """doc_ids (NULL is one) of several rows; None if there are none."""
    ids = cut(docs.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id"), "shared-ids")
    return ids if ids.limit(1).count() else None


def _without(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    return rows if ids is None else rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_anti")


def _lines_of_shared(docs: DataFrame, ids: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Lines of the rows whose doc_id others share, each text of a doc_id once: id, th, at, line, h."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("own"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    rows = rows.join(ids, F.col("own").eqNullSafe(F.col("id")), "left_semi").select(F.col("own").alias("id"), F.xxhash64("t").alias("th"), "t").distinct()
    lines = rows.select("id", "th", F.posexplode(F.split("t", "\n")).alias("at", "raw")).select("id", "th", "at", _trim(F.col("raw")).alias("line"))
    return lines.where("line <> ''").withColumn("h", F.xxhash64("line"))


def _pieces(docs: DataFrame, shared: DataFrame, ids: DataFrame | None, text: str, doc_id: str) -> DataFrame:
    """Rows (k, longer, h1, pos, piece) of the lines in ``shared``, with the piece's text."""
    same_id = F.col("doc_id").eqNullSafe(F.col("id"))
    per_doc = cut(_without(shared, ids).groupBy("doc_id")
                  .agg(F.collect_list(F.struct("k", "j", "longer", "h1", "line_no")).alias("wanted")), "wanted")
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("t"))
    found = (_list_join(texts, per_doc, "wanted", same_id)
             .select("doc_id", "wanted", F.split("t", "\n").alias("raw"))
             .select("doc_id", F.inline(F.transform("wanted", lambda x: F.struct(
                 x["k"].alias("k"), x["j"].alias("j"), x["longer"].alias("longer"), x["h1"].alias("h1"),
                 x["line_no"].alias("line_no"), _trim(F.get("raw", x["line_no"])).alias("line")))))
             .where(F.xxhash64("line") == F.col("h1")))
    if ids is not None:
        lines = _lines_of_shared(docs, ids, text, doc_id).select("id", "at", "line", "h").distinct()
        found = found.unionByName(shared.join(lines, same_id & (F.col("line_no") == F.col("at")) & (F.col("h1") == F.col("h")))
                                  .select("doc_id", "k", "j", "longer", "h1", "line_no", "line"))
    size = _piece_size(F.length("line") - F.col("longer").cast("int"))
    return found.select("k", "longer", "h1", F.struct("doc_id", "line_no").alias("pos"), F.substring(
        F.col("line"), F.col("j") * size + 1, size + F.col("longer").cast("int")).alias("piece")).distinct()


def _close_lines(docs: DataFrame, lines: DataFrame, ids: DataFrame | None, text: str, doc_id: str, min_fuzzy: int) -> DataFrame:
    """Lines one edit away from an earlier, different line."""
    keys = cut(_keys(lines, min_fuzzy), "line-keys")
    several = cut(keys.groupBy("k").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi").select("k"), "shared-keys")
    shared = (salted_join(keys, several, ["k"]).groupBy("k", "j", "longer", "h1")
              .agg(F.min(F.struct("doc_id", "line_no")).alias("pos")).select("k", "j", "longer", "h1", "pos.*"))
    pieces = cut(_pieces(docs, shared if ids is None else cut(shared, "shared-lines"), ids, text, doc_id), "line-pieces")

    def drop_one(kind: str, at) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.length("piece") - 1, F.lit(0))), lambda p: F.struct(
            F.xxhash64("k", at(p), F.concat(F.substring(F.col("piece"), F.lit(1), p),
                                            F.substring(F.col("piece"), p + 2, F.length("piece")))).alias("v"),
            F.lit(kind).alias("kind")))

    whole = F.array(F.struct(F.xxhash64("k", F.lit(-1), "piece").alias("v"), F.lit("whole").alias("kind")))
    variants = pieces.select("k", "h1", "pos", "piece", F.inline(
        F.when(F.col("longer"), drop_one("cut", lambda p: F.lit(-1)))
        .otherwise(F.concat(whole, drop_one("swap", lambda p: p)))))
    # lines that share a variant differ in one character: their number is bounded by the alphabet
    over = Window.partitionBy("v")
    first_cut, first_other = [F.min(F.when(c, F.col("pos"))).over(over) for c in (F.col("kind") == "cut", F.col("kind") != "cut")]
    claims = cut(variants.select("v", "kind", "h1", "pos", "k")
                 .withColumns({"lo": F.min("h1").over(over), "hi": F.max("h1").over(over), "cut": first_cut, "other": first_other})
                 .where("lo < hi").withColumn("first", F.when(F.col("kind") == "whole", F.col("cut")).otherwise(F.col("other")))
                 .where("first < pos").select("k", "h1", "pos", "first").distinct(), "claims")
    mine = pieces.select("k", "h1", "pos", F.col("piece").alias("mine"))
    theirs = pieces.select("k", F.col("pos").alias("first"), F.col("piece").alias("theirs"))
    return (claims.join(mine, ["k", "h1", "pos"]).join(theirs, ["k", "first"])
            .where(F.levenshtein("mine", "theirs", 1) == 1)
            .groupBy("h1", "pos").agg(F.min("first").alias("first")).select("h1", "pos", "first", F.lit(1).alias("edits")))


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_edits: int = 1,
                   min_fuzzy: int = MIN_FUZZY) -> DataFrame:
    """The lines to drop: doc_id, line_no (from 0), h1, edits, first_doc_id, first_line_no."""
    return _repeated_lines(docs, _shared_ids(docs, doc_id) if max_edits else None, text, doc_id, max_edits, min_fuzzy)


def _repeated_lines(docs: DataFrame, ids: DataFrame | None, text: str, doc_id: str, max_edits: int, min_fuzzy: int) -> DataFrame:
    if max_edits not in (0, 1):
        raise ValueError("the edit bound is 0 or 1")
    lines = _lines(docs, text, doc_id)
    found = _equal_lines(lines)
    if max_edits:
        found = found.union(_close_lines(docs, lines, ids, text, doc_id, min_fuzzy))
    best = found.groupBy("pos", "h1").agg(F.min(F.struct("edits", "first")).alias("best"))
    return best.select("pos.*", "h1", "best.edits", F.col("best.first.doc_id").alias("first_doc_id"),
                       F.col("best.first.line_no").alias("first_line_no"))


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_edits: int = 1,
                        min_fuzzy: int = MIN_FUZZY) -> DataFrame:
    """``doc`` (struct of the input columns), ``clean`` (text without repeated lines),
    ``n_lines`` (non-blank), ``n_equal`` and ``n_close`` (dropped lines)."""
    ids = _shared_ids(docs, doc_id)
    found = cut(_repeated_lines(docs, ids, text, doc_id, max_edits, min_fuzzy).select("doc_id", "line_no", "h1", "edits"), "repeated-lines")
    same_id = F.col("doc_id").eqNullSafe(F.col("id"))
    one = F.struct("line_no", "edits")
    drops = cut(_without(found, ids).groupBy("doc_id").agg(F.collect_list(one).alias("drops")), "drops")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{doc_id}`").alias("id"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    joined = _list_join(whole, drops, "drops", same_id, "left").drop("doc_id")
    if ids is not None:
        # line by line: a line that many texts of one doc_id hold at one place is spread over them
        lines = cut(_lines_of_shared(docs, ids, text, doc_id).select("id", "th", "at", "h"), "lines-of-shared-ids")
        place = [F.xxhash64(F.col(c).isNull(), F.coalesce(F.col(c), F.lit(0).cast(docs.schema[doc_id].dataType)), F.col(n), F.col(h)).alias("place")
                 for c, n, h in (("id", "at", "h"), ("doc_id", "line_no", "h1"))]
        gone = cut(found.join(ids, same_id, "left_semi").select("doc_id", "line_no", "h1", "edits", place[1]), "drops-of-shared-ids")
        matched = salted_join(lines.withColumn("place", place[0]), gone, ["place"]).where(
            same_id & (F.col("at") == F.col("line_no")) & (F.col("h") == F.col("h1")))
        per_text = cut(matched.groupBy("id", "th").agg(F.collect_list(one).alias("shared_drops")).withColumnsRenamed({"id": "_id", "th": "_th"}), "drops-by-text")
        joined = _list_join(joined, per_text, "shared_drops", F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("t") == F.col("_th")), "left")
        joined = joined.withColumn("drops", F.coalesce("drops", "shared_drops"))
    joined = joined.select("doc", F.split("t", "\n").alias("raw"),
                           F.coalesce("drops", F.array().cast("array<struct<line_no:int,edits:int>>")).alias("drops"))
    kept = joined.select("doc", "raw", "drops", F.array_except(
        F.sequence(F.lit(0), F.size("raw") - 1), F.transform("drops", lambda d: d["line_no"])).alias("kept"))
    return kept.select(
        "doc", F.array_join(F.transform("kept", lambda i: F.get("raw", i)), "\n").alias("clean"),
        F.size(F.filter("raw", lambda x: _trim(x) != "")).cast("long").alias("n_lines"),
        F.size(F.filter("drops", lambda d: d["edits"] == 0)).cast("long").alias("n_equal"),
        F.size(F.filter("drops", lambda d: d["edits"] == 1)).cast("long").alias("n_close"))


def keep_first_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with their repeated lines removed, input columns only.

    A document of which no line is left was a copy of earlier ones and goes."""
    out = drop_repeated_lines(docs, text, doc_id)
    return (out.where((F.col("n_equal") + F.col("n_close") == 0) | (F.col("n_lines") > F.col("n_equal") + F.col("n_close")))
            .select(*[(F.col("clean") if c == text else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]))


def line_dedup_query(docs: DataFrame) -> DataFrame:
    return drop_repeated_lines(docs).select("doc.doc_id", F.col("clean").alias("text"), "n_lines", "n_equal", "n_close")


def oracle_sql(source: str = "documents", min_fuzzy: int = MIN_FUZZY) -> str:
    """DuckDB: compares all pairs of distinct lines whose first or last characters agree, place by
    place (its own edit distance counts bytes)."""
    half = min_fuzzy // 2 - 1
    return f"""
WITH l AS (SELECT doc_id, i AS line_no, raw, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM {source})),
d AS (SELECT line, min((doc_id, line_no)) AS first FROM l WHERE line <> '' GROUP BY line),
f AS (SELECT *, length(line) AS n, left(line, {half}) AS head, right(line, {half}) AS tail FROM d WHERE length(line) >= {min_fuzzy}),
pairs AS (SELECT a.line AS x, b.line AS y, a.first AS fx, b.first AS fy FROM f a JOIN f b ON a.head = b.head AND b.n BETWEEN a.n - 1 AND a.n + 1
          UNION SELECT a.line, b.line, a.first, b.first FROM f a JOIN f b ON a.tail = b.tail AND b.n BETWEEN a.n - 1 AND a.n + 1),
earlier AS (SELECT x, CASE WHEN length(x) < length(y) THEN x ELSE y END AS s, CASE WHEN length(x) < length(y) THEN y ELSE x END AS g
            FROM pairs WHERE fy < fx),
close AS (SELECT DISTINCT x AS line FROM earlier WHERE CASE WHEN length(s) = length(g)
              THEN len(list_filter(range(1, length(s) + 1), lambda i: substr(s, i, 1) <> substr(g, i, 1))) = 1
              ELSE len(list_filter(range(length(g)), lambda i: left(g, i) || substr(g, i + 2) = s)) > 0 END),
v AS (SELECT l.doc_id, l.line_no, l.raw, l.line <> '' AS real,
             l.line <> '' AND d.first < (l.doc_id, l.line_no) AS equal, close.line IS NOT NULL AS close
      FROM l LEFT JOIN d ON d.line = l.line LEFT JOIN close ON close.line = l.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE NOT (equal OR close)), '') AS text,
       count(*) FILTER (WHERE real) AS n_lines, count(*) FILTER (WHERE real AND equal) AS n_equal,
       count(*) FILTER (WHERE real AND close AND NOT equal) AS n_close
FROM (SELECT doc_id, line_no, raw, real, coalesce(equal, FALSE) AS equal, close FROM v) GROUP BY doc_id"""
