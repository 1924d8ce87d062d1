"""N-gram Jaccard join: documents whose sets of word shingles overlap, and their components.

Every shingle hashes into a group, and the group counts of a document are a point.  Two
documents share at most the sum, over the groups, of the smaller count, so an R-tree over
the points bounds all overlaps of a leaf at once; surviving pairs are verified on the sets.

One tree over all points can't be dealt out to tasks, and its boxes overlap in so many
dimensions; so the groups also say which documents meet in one task.  Documents of similar
size that link differ in at most D shingles.  With D + 1 groups, one group at least holds
the same shingles in both: its hash is a key, and linked documents share a key.  Unrelated
documents share groups that are empty in both, so there are spare groups: with D + 1 + s, linked
documents share s + 1 at least, and one that leaves no more than s empty needs no key of those.

Before the sets of a pair are compared, finer points are: the parities of the counts of some
four groups per shingle, a bit each.  Sets that differ in d shingles differ in d bits at most, so
pairs of points further apart can't link, and only the sets of the pairs that are left travel.
Unrelated sets are apart in a quarter of these bits already, so those are compared first, and
the whole parities travel for the pairs that they leave.

Copies with equal texts are one vertex.  In each key's block, first the member that shares
most keys is compared with the others; after that, only members of different components
are compared, through R-trees of bounded tiles.  No block emits all its pairs, and no link
between two components is lost.

The links found thus make the components.  All links of a document lie in its component, so
they are counted there: members are written as their difference from one of them, which is
short for near copies, and pairs of tiles are compared as matrices.  Only the counts leave a
task, never the pairs.

Defined results: NULL or empty texts have an empty set, link with nothing and are their own
component; repeated rows are copies of one another; a NULL doc_id takes part but is never a
component's smallest id unless all are NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, exp, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value, cut, min_labels, salted_join
from jobfacts.llm.wordhash import mix, shingles, word_hashes

by_value(__name__)

SHINGLE = 3
THRESHOLD = 90  # percent
POINT_GROUPS = 128
TILE = 1024
LEAF = 32
#: rows of small blocks that one group holds
GROUP_ROWS = 20_000
#: near duplicates without a contract of their own: words of a shingle, percent
NEAR_SHINGLE, NEAR_THRESHOLD = 5, 80
#: ids that may be broadcast; more are joined by a shuffle
MAX_BROADCAST = 4_000_000
#: shingles in one slice of the matrices that count links
SLICE = 2048
#: shingles of the documents that one verifying task holds
TASK_SHINGLES = 500_000

_U = np.uint64


def size_bounds(percent: int) -> np.ndarray:
    """Lower ends of the size classes: linked sets are in the same class or in adjacent ones."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(-(-ends[-1] * 100 // percent))
        if ends[-1] == ends[-2]:
            ends[-1] += 1
    return np.array(ends)


def class_groups(bounds: np.ndarray, cls: int, percent: int) -> int:
    """One more than the shingles by which two linked sets of classes ``cls - 1, cls`` differ."""
    largest = int(bounds[cls + 1]) - 1
    return 2 * largest * (100 - percent) // (100 + percent) + 1


def spare_groups(least: int, n: int) -> int:
    """Groups beside n, of which sets of ``least`` shingles seldom leave more empty."""
    spare = 0
    for _ in range(4):
        empty = (n + spare) * exp(-least / (n + spare))
        spare = ceil(empty + 2 * sqrt(empty))
    return spare


def keys_of(values: np.ndarray, bounds: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the contents of the groups, once with each neighbouring size class."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    cls = int(np.searchsorted(bounds, len(values), side="right")) - 1
    sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mix(values), dtype=_U)])
    top = values >> _U(32)
    keys = []
    for c in (cls, cls + 1):
        n = class_groups(bounds, c, percent)
        spare = spare_groups(int(bounds[max(c - 1, 0)]), n)
        n += spare
        ends = np.searchsorted((top * _U(n)) >> _U(32), np.arange(n + 1, dtype=_U))
        own = mix(sums[ends[1:]] - sums[ends[:-1]] + mix(np.arange(n, dtype=_U) + _U(c << 32)))
        held = ends[1:] > ends[:-1]
        # linked sets share more than the spare groups: if one set leaves no more of them empty, one that isn't
        keys.append(own[held] if n - held.sum() <= spare else own)
    return np.unique(np.concatenate(keys)).view(np.int64)


def point_of(values: np.ndarray) -> np.ndarray:
    groups = ((values >> _U(32)) * _U(POINT_GROUPS)) >> _U(32)
    return np.bincount(groups.astype(np.int64), minlength=POINT_GROUPS).astype(np.uint32)


def packed(point: np.ndarray) -> bytes:
    """The counts of a point in as many bits each as the largest needs: 4, 8, 16 or 32."""
    most = int(point.max(initial=0))
    if most < 16:
        return (point[0::2] | point[1::2] << 4).astype(np.uint8).tobytes()
    return point.astype(next(f"<u{k}" for k in (1, 2, 4) if most < 1 << 8 * k)).tobytes()


def unpacked(points: Sequence[bytes]) -> np.ndarray:
    """Packed points as the rows of a matrix."""
    out = np.zeros((len(points), POINT_GROUPS), dtype=np.int64)
    lengths = np.array([len(x) for x in points])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        joined = b"".join(points[i] for i in at)
        if 2 * length == POINT_GROUPS:
            pairs = np.frombuffer(joined, np.uint8).reshape(len(at), length)
            out[at, 0::2], out[at, 1::2] = pairs & 15, pairs >> 4
        else:
            out[at] = np.frombuffer(joined, f"<u{length // POINT_GROUPS}").reshape(len(at), POINT_GROUPS)
    return out


def parities_of(values: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 4 n to 8 n groups, as bits; half as many groups
    are the exclusive or of the two halves."""
    bits = max(64, 1 << (4 * max(len(values), 1) - 1).bit_length())
    at = (values & _U(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little")


def folded(bits: np.ndarray) -> np.ndarray:
    """The parities of half as many groups."""
    return bits[:len(bits) // 2] ^ bits[len(bits) // 2:]


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Groups whose parities differ: at most the number of shingles that only one of the sets has."""
    while len(a) > len(b):
        a = folded(a)
    while len(b) > len(a):
        b = folded(b)
    return int(np.bitwise_count(a ^ b).sum())


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    for text in texts:
        yield shingles(word_hashes((text.as_py() or b"").lower()), size)  # bytes.lower() changes A-Z alone


def _vertices(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(vid, text) to (vid, n, keys, point, parities, coarse), where n goes before the bits of the
    parities and of a quarter of them."""
    def run(batches):
        bounds = size_bounds(percent)
        for batch in batches:
            n, keys, points, bits, coarse = [], [], [], [], []
            for values in _sets(batch.column("text"), size):
                n.append(len(values))
                keys.append(keys_of(values, bounds, percent))
                points.append(packed(point_of(values)))
                size_of, parities = len(values).to_bytes(8, "big"), parities_of(values)
                bits.append(size_of + parities.tobytes())
                coarse.append(size_of + folded(folded(parities)).tobytes())
            yield pa.record_batch([batch.column("vid"), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                                   pa.array(points, pa.binary()), pa.array(bits, pa.binary()), pa.array(coarse, pa.binary())],
                                  ["vid", "n", "keys", "point", "parities", "coarse"])

    return rows.mapInArrow(run, "vid long, n long, keys array<long>, point binary, parities binary, coarse binary")


def _shingle_sets(rows: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sets = [values.tobytes() for values in _sets(batch.column("text"), size)]
            yield pa.record_batch([batch.column("vid"), pa.array(sets, pa.binary())], ["vid", "shingles"])

    return rows.mapInArrow(run, "vid long, shingles binary")


def _only(rows: DataFrame, ids: DataFrame, on: str, how: str, limit: int) -> DataFrame:
    """Semi or anti join with a table of ids, which is broadcast if it's counted to be small."""
    return rows.join(F.broadcast(ids) if ids.count() <= limit else ids, on, how)


def _compared(pairs: DataFrame, held: DataFrame, load: int, passes) -> DataFrame:
    """The pairs (a, b, n: shingles of a) for which ``passes(of a, of b)`` holds, as they are.

    ``held`` is (vid, held): what is compared.  The partners of one b are dealt out to tasks that hold
    ``load`` shingles each."""
    parts = cut(pairs.groupBy("b").agg(F.ceil(F.sum("n") / load).cast("int").alias("parts")), "pair-load")
    dealt = cut(salted_join(pairs, parts, ["b"]).select("a", "b", "n", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")), "pairs")
    members = dealt.join(held.withColumnRenamed("vid", "a"), "a").select("b", "part", "a", "n", "held", F.lit(False).alias("centre"))
    centres = dealt.select("b", "part").distinct().join(held.withColumnRenamed("vid", "b"), "b").select(
        "b", "part", F.col("b").alias("a"), F.lit(0).cast("long").alias("n"), "held", F.lit(True).alias("centre"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        centre = group.loc[group["centre"], "held"].iloc[0]
        others = group[~group["centre"]]
        good = np.array([passes(own, centre) for own in others["held"]], dtype=bool)
        return pd.DataFrame({"a": others["a"][good], "b": int(group["b"].iloc[0]), "n": others["n"][good]}).astype("int64")

    return members.union(centres).groupBy("b", "part").applyInPandas(verify, "a long, b long, n long")


def _near(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parities allow a link."""
    def passes(a: bytes, b: bytes) -> bool:
        sizes = int.from_bytes(a[:8], "big") + int.from_bytes(b[:8], "big")
        return (100 + percent) * apart(np.frombuffer(a, np.uint8, offset=8), np.frombuffer(b, np.uint8, offset=8)) <= (100 - percent) * sizes

    for bits, load in (("coarse", 64), ("parities", 16)):
        pairs = cut(_compared(pairs, vertices.select("vid", F.col(bits).alias("held")), load * TASK_SHINGLES, passes), bits)
    return pairs


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n: shingles of a) that link, as (a, b)."""
    def passes(a: bytes, b: bytes) -> bool:
        own, centre = np.frombuffer(a, dtype=_U), np.frombuffer(b, dtype=_U)
        at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
        both = int((centre[at] == own).sum())
        return 100 * both >= percent * (len(own) + len(centre) - both)

    return _compared(pairs, sets.withColumnRenamed("shingles", "held"), TASK_SHINGLES, passes).select("a", "b")


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(root, vid, n, head) to (root, vid, n, gone, new, head_n): the shingles of the head that a
    member lacks and those that only the member has.  Members are dealt out as in _linked."""
    load = cut(members.groupBy("root").agg(F.ceil(F.sum("n") / TASK_SHINGLES).cast("int").alias("parts")), "head-load")
    dealt = cut(salted_join(members, load, ["root"]).select("root", "vid", "n", "head", F.pmod(F.xxhash64("vid"), F.col("parts")).alias("part")),
                "head-members")
    own = dealt.join(sets, "vid").select("root", "part", "vid", "n", "shingles", F.lit(False).alias("centre"))
    heads = dealt.select("root", "part", F.col("head").alias("vid")).distinct().join(sets, "vid").select(
        "root", "part", "vid", F.lit(0).cast("long").alias("n"), "shingles", F.lit(True).alias("centre"))

    def subtract(group: pd.DataFrame) -> pd.DataFrame:
        head = np.frombuffer(group.loc[group["centre"], "shingles"].iloc[0], dtype=_U)
        own = group[~group["centre"]]
        values = [np.frombuffer(x, dtype=_U) for x in own["shingles"]]
        return pd.DataFrame({"root": own["root"], "vid": own["vid"], "n": own["n"],
                             "gone": [np.setdiff1d(head, x, assume_unique=True).tobytes() for x in values],
                             "new": [np.setdiff1d(x, head, assume_unique=True).tobytes() for x in values], "head_n": len(head)})

    return own.union(heads).groupBy("root", "part").applyInPandas(subtract, "root long, vid long, n long, gone binary, new binary, head_n long")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    sides = [(np.repeat(np.arange(len(x)), [len(v) for v in x]), np.concatenate(x)) for x in (left, right)]
    shared = np.intersect1d(sides[0][1], sides[1][1])
    both = np.zeros((len(left), len(right)), dtype=np.int32)
    for low in range(0, len(shared), SLICE):
        part = shared[low:low + SLICE]
        dense = []
        for (rows, values), x in zip(sides, (left, right)):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            matrix = np.zeros((len(x), len(part)), dtype=np.float32)
            matrix[rows[hit], at[hit]] = 1
            dense.append(matrix)
        both += (dense[0] @ dense[1].T).astype(np.int32)
    return both


def _count_links(members: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """(root, vid, n, head) of whole components to (vid, n_links): links with other members."""
    apart = cut(_differences(members, sets), "differences")
    load = F.sum(F.length("gone") + F.length("new")) / (8 * TASK_SHINGLES)
    tiles = cut(apart.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / tile, load, F.lit(1))).cast("int").alias("tiles")), "tiles")
    tiled = salted_join(apart, tiles, ["root"]).withColumn("tile", F.pmod(F.xxhash64("vid"), F.col("tiles")))
    dealt = (tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
             .withColumns({"s": F.least("tile", "other"), "t": F.greatest("tile", "other")}).drop("tiles", "other"))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        s, t, head = int(group["s"].iloc[0]), int(group["t"].iloc[0]), int(group["head_n"].iloc[0])
        sides = [group[group["tile"] == x] for x in ((s,) if s == t else (s, t))]
        if not all(len(x) for x in sides):
            return pd.DataFrame({"vid": [], "n_links": []}, dtype="int64")
        sides = sides * 2 if s == t else sides
        n = [x["n"].to_numpy() for x in sides]
        gone, new = [[[np.frombuffer(v, dtype=_U) for v in x[c]] for x in sides] for c in ("gone", "new")]
        lacking = [np.array([len(v) for v in x]) for x in gone]
        # of the head's shingles, those that neither lacks; and the new ones that both have
        both = head - lacking[0][:, None] - lacking[1][None, :] + _common(*gone) + _common(*new)
        linked = 100 * both >= percent * (n[0][:, None] + n[1][None, :] - both)
        if s == t:
            np.fill_diagonal(linked, False)
            return pd.DataFrame({"vid": sides[0]["vid"].to_numpy(), "n_links": linked.sum(axis=1, dtype="int64")})
        return pd.DataFrame({"vid": np.concatenate([x["vid"].to_numpy() for x in sides]),
                             "n_links": np.concatenate([linked.sum(axis=a, dtype="int64") for a in (1, 0)])})

    counts = dealt.groupBy("root", "s", "t").applyInPandas(count, "vid long, n_links long")
    return counts.groupBy("vid").agg(F.sum("n_links").alias("n_links"))


class _Tree:
    """A packed R-tree over points: leaves of LEAF points in order of their size and first
    coordinates, each with its points' largest coordinates and smallest size."""

    def __init__(self, points: np.ndarray):
        self.sizes = points.sum(axis=1)
        order = np.lexsort((points[:, 1], points[:, 0], self.sizes))
        self.leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
        self.high = np.stack([points[x].max(axis=0) for x in self.leaves])
        self.least = np.array([self.sizes[x].min() for x in self.leaves])
        self.most = np.array([self.sizes[x].max() for x in self.leaves])
        self.points = points


def tree_join(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose points allow a link: overlap no larger than the sum of coordinate minima."""
    x, y, left, right = _Tree(a), _Tree(b), [], []
    for i, leaf in enumerate(x.leaves):
        bound = np.minimum(x.high[i], y.high).sum(axis=1, dtype=np.int64)
        near = ((100 + percent) * bound >= percent * (x.least[i] + y.least)) & (100 * y.most >= percent * x.least[i]) & (
            100 * x.most[i] >= percent * y.least)
        for j in np.flatnonzero(near):
            other = y.leaves[j]
            shared = np.minimum(a[leaf][:, None, :], b[other][None, :, :]).sum(axis=2, dtype=np.int64)
            p, q = np.nonzero((100 + percent) * shared >= percent * (x.sizes[leaf][:, None] + y.sizes[other][None, :]))
            left.append(leaf[p])
            right.append(other[q])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


_PAIRS = [np.triu_indices(m, 1) for m in range(LEAF + 1)]


def _across(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components in a block that their points allow to link.

    ``blocks``: (key, vid, n, component, point, tiles).  A block of many members is cut into
    tiles, and each pair of tiles is one group; blocks of one tile share groups of some
    ``GROUP_ROWS`` rows, so that a group costs little beside its rows."""
    few = blocks.where("tiles = 1")
    groups = max(1, -(-few.count() // GROUP_ROWS))

    def pairs_of(points: np.ndarray, ids: np.ndarray, parts: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, ordered: bool) -> pd.DataFrame:
        keep = parts[i] != parts[j]
        if ordered:  # both sides are one tile, which gives each pair twice
            keep &= ids[i] < ids[j]
        a, b, size = ids[i][keep], ids[j][keep], n[i][keep]
        swap = a > b
        return pd.DataFrame({"a": np.where(swap, b, a), "b": np.where(swap, a, b), "n": np.where(swap, n[j][keep], size)}).astype("int64")

    def columns(group: pd.DataFrame) -> tuple[np.ndarray, ...]:
        return unpacked(group["point"].to_numpy()), group["vid"].to_numpy(), group["component"].to_numpy(), group["n"].to_numpy()

    def join_blocks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        held = columns(group)
        points, sizes = held[0], held[0].sum(axis=1)
        keys = group["key"].to_numpy()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        left, right = [], []
        for first, m in zip(starts, np.diff(np.append(starts, len(keys)))):
            if m <= LEAF:  # a leaf: all its pairs are bounded together with those of other blocks
                i, j = _PAIRS[m]
            else:
                i, j = tree_join(points[first:first + m], points[first:first + m], percent)
                i, j = i[i < j], j[i < j]
            left.append(first + i)
            right.append(first + j)
        i, j = np.concatenate(left), np.concatenate(right)
        differ = held[2][i] != held[2][j]
        i, j = i[differ], j[differ]
        good = [np.zeros(0, dtype=bool)]
        for at in range(0, len(i), 4096):
            p, q = i[at:at + 4096], j[at:at + 4096]
            good.append((100 + percent) * np.minimum(points[p], points[q]).sum(axis=1) >= percent * (sizes[p] + sizes[q]))
        good = np.concatenate(good)
        return pairs_of(*held, i[good], j[good], False)

    def join_tiles(group: pd.DataFrame) -> pd.DataFrame:
        s, t = group["s"].iloc[0], group["t"].iloc[0]
        own, other = np.flatnonzero(group["tile"] == s), np.flatnonzero(group["tile"] == t)
        held = columns(group)
        if not len(own) or not len(other) or group["component"].nunique() < 2:
            return pairs_of(*held, own[:0], other[:0], False)
        i, j = tree_join(held[0][own], held[0][other], percent)
        return pairs_of(*held, own[i], other[j], bool(s == t))

    dealt = few.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("bucket"), "key", "vid", "component", "point", "n")
    found = dealt.groupBy("bucket").applyInPandas(join_blocks, "a long, b long, n long")
    tiled = blocks.where("tiles > 1").withColumn("tile", F.pmod(F.xxhash64("vid"), F.col("tiles")))
    pairs = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    many = pairs.select("key", F.least("tile", "other").alias("s"), F.greatest("tile", "other").alias("t"), "tile", "vid", "component", "point", "n")
    return found.union(many.groupBy("key", "s", "t").applyInPandas(join_tiles, "a long, b long, n long")).distinct()


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, percent: int = THRESHOLD,
               max_broadcast: int = MAX_BROADCAST, tile: int = TILE, count_links: bool = True) -> DataFrame:
    """Per row: doc_id, vid (hash of the text), n_shingles, n_links (other texts that the text
    links with; only with ``count_links``) and component_id, the smallest doc_id that links lead to."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("vid"), F.xxhash64(F.lit(1), "text").alias("check"), "text")
    ids = rows.select("doc_id", "vid", "check")
    classes = cut(ids.groupBy("vid", "check").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "text-classes")
    several = classes.where("copies > 1").drop("copies")
    extra = cut(salted_join(ids, several, ["vid", "check"]).where("NOT doc_id <=> rep").select("doc_id", "vid").distinct(), "copies")
    small = extra.count() <= max_broadcast
    gone = extra.withColumnsRenamed({"doc_id": "_id", "vid": "_vid"})
    firsts = rows.join(F.broadcast(gone) if small else gone,
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("vid") == F.col("_vid")), "left_anti")
    firsts = firsts.select("vid", F.col("text").cast("binary").alias("text"))
    # only rows that repeat a doc_id and a text are left more than once: of texts that stand alone, none travels
    repeated = cut(classes.groupBy("vid").agg(F.sum("copies").alias("copies")).where("copies > 1").select("vid"), "repeated")

    def once(rows: DataFrame) -> DataFrame:
        return _only(rows, repeated, "vid", "left_anti", max_broadcast).union(
            _only(rows, repeated, "vid", "left_semi", max_broadcast).dropDuplicates(["vid"]))

    vertices = cut(_vertices(once(firsts), size, percent), "vertices")
    keyed = vertices.select(F.explode("keys").alias("key"), "vid", "n")
    counted = keyed.withColumn("members", F.count("*").over(Window.partitionBy("key")))
    blocks = cut(counted.where("members > 1"), "blocks")

    # the member that shares most keys, most likely what the others were copied from
    shared = cut(blocks.groupBy("vid").agg(F.sum("members").alias("weight")), "weights")
    weighed = cut(blocks.join(shared, "vid"), "weighed")
    heads = cut(weighed.groupBy("key").agg(F.max(F.struct("weight", "vid")).alias("head"))
                .select("key", F.col("head.vid").alias("b")), "heads")
    first = cut(salted_join(weighed, heads, ["key"]).where("vid != b")
                .select(F.col("vid").alias("a"), "b", "n").distinct(), "first-pairs")

    def verified(pairs: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
        """The links among the pairs, and the sets of the pairs that parities left."""
        near = _near(pairs, vertices, percent)
        ids = cut(near.select(F.col("a").alias("vid")).union(near.select("b")).distinct(), f"near-ids-{label}")
        sets = cut(_shingle_sets(_only(firsts, ids, "vid", "left_semi", max_broadcast), size).dropDuplicates(["vid"]), f"sets-{label}")
        return cut(_linked(near, sets, percent), f"links-{label}"), sets

    links, sets = verified(first, "first")

    parts = min_labels(links).withColumnRenamed("id", "vid")
    placed = cut(blocks.join(parts, "vid", "left").select("key", "vid", "n", F.coalesce("component", "vid").alias("component")), "placed")
    # blocks of the same members are compared once
    same = [F.bit_xor(F.xxhash64(F.lit(k), "vid")).alias(f"x{k}") for k in (0, 1)]
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), *same)
    unlike = cut(split.where("lo < hi").groupBy("m", "x0", "x1").agg(F.min("key").alias("key"))
                 .select("key", F.ceil(F.col("m") / tile).cast("int").alias("tiles")), "open-blocks")
    members = cut(salted_join(placed, unlike, ["key"]), "open-members").join(vertices.select("vid", "point"), "vid")
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = cut(_across(members, percent).join(done, ["a", "b"], "left_anti"), "second-pairs")
    more, others = verified(second, "second")
    links = cut(links.union(more), "all-links")

    parts = cut(vertices.select("vid", "n").join(min_labels(links).withColumnRenamed("id", "vid"), "vid", "left")
                .select("vid", "n", F.coalesce("component", "vid").alias("root")), "parts")
    owned = parts.join(classes.groupBy("vid").agg(F.min("rep").alias("rep")), "vid")
    smallest = cut(owned.groupBy("root").agg(F.min("rep").alias("component_id")), "smallest")
    found = salted_join(parts, smallest, ["root"])
    if count_links:
        ends = cut(links.select(F.col("a").alias("vid")).union(links.select("b")).groupBy("vid").agg(F.count("*").alias("degree"))
                   .join(parts, "vid"), "ends")
        # of two members, each has one link; of more, the head is one that was found to have most
        heads = cut(ends.groupBy("root").agg(F.count("*").alias("members"), F.max(F.struct("degree", "vid")).alias("head"))
                    .select("root", "members", F.col("head.vid").alias("head")), "link-heads")
        inside = cut(salted_join(ends.select("root", "vid", "n"), heads, ["root"]), "link-members")
        counts = inside.where("members = 2").select("vid", F.lit(1).cast("long").alias("n_links")).union(
            _count_links(inside.where("members > 2").drop("members"), sets.union(others).dropDuplicates(["vid"]), percent, tile))
        found = found.join(counts, "vid", "left")
    found = cut(found, "found")
    n_links = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] if count_links else []
    return salted_join(ids.select("doc_id", "vid"), found, ["vid"]).select(
        "doc_id", "vid", F.col("n").alias("n_shingles"), *n_links,
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = NEAR_SHINGLE, percent: int = NEAR_THRESHOLD) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; input columns only."""
    dropped = (components(docs, size=size, percent=percent, count_links=False).where("NOT doc_id <=> component_id")
               .select(F.col("doc_id").alias("__id"), F.col("vid").alias("__hash")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hash"))
    return docs.join(dropped, same, "left_anti")


def jaccard_query(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", "n_shingles", "n_links", "component_id")
