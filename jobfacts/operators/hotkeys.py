"""Frequent join keys: found by a sketch, split over tasks by a salt.

In a shuffled join all rows of one key meet in one task.  ``profile`` finds, before the join is planned,
the keys that hold several tasks' share of the rows of a relation: one job over the key columns
alone, in which every task sketches the frequent key hashes of its rows, so a table of any
size sends a row per task and relation to the merge, and at most ``1 / hot_share`` hashes per
relation reach the driver.  A join given such a ``Split`` spreads the rows of these keys over
as many tasks as their share asks for, and repeats the other side's rows of these keys, and of no
others, once for each: together no more copies than twice the shuffle partitions.

A sketch may name a key that is not quite frequent, or miss one just above the bound; the
join's rows are the same in either case, as both sides salt by the same rule.  Without frequent keys
a join is left as it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key with more than this share of its relation's rows is split, whatever the number of tasks
HOT_SHARE = 0.02
#: with many tasks, one with TASKS_SHARE tasks' part of the rows, down to MIN_SHARE
TASKS_SHARE, MIN_SHARE = 4, 0.0001


class Split(NamedTuple):
    """Hashes of the keys to split; into how many parts, all of them or ``each``."""

    hashes: tuple[int, ...] = ()
    salts: int = 1
    each: tuple[int, ...] = ()

    def parts(self, h: Column) -> Column:
        """Number of parts of the key with hash ``h``; 1 unless it is split."""
        by_size: dict[int, list[int]] = {}
        for value, n in zip(self.hashes, self.each or (self.salts,) * len(self.hashes)):
            by_size.setdefault(n, []).append(value)
        out = F.lit(1)
        for n, values in sorted(by_size.items()):
            out = F.when(h.isin(*values), F.lit(n)).otherwise(out)
        return out


NO_SPLIT = Split()


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_share(spark: SparkSession) -> float:
    """The share of rows from which on a key is split: small enough that an unsplit key is a few tasks' work."""
    return min(HOT_SHARE, max(MIN_SHARE, TASKS_SHARE / partitions_of(spark)))


def key_hash(*keys: Column) -> Column:
    """NULL if a part of the key is: such rows never join."""
    some_null = reduce(Column.__or__, [k.isNull() for k in keys])
    return F.when(~some_null, F.xxhash64(*keys))


def salts_for(share: float, partitions: int) -> int:
    """Twice the tasks that a share of the rows should fill, as a power of two."""
    return 1 << max(1, (max(2, round(2 * share * partitions)) - 1).bit_length())


def sketch(relations: Sequence[tuple[DataFrame, Mapping[str, Sequence[str]]]], share: float | None = None) -> dict[str, Split]:
    """``name -> Split`` for (relation, {name: key columns}): all relations in one job, each
    scanned once for its key columns."""
    spark = relations[0][0].sparkSession
    names = [n for _, keys in relations for n in keys]
    share = share or hot_share(spark)
    top = round(2 / share)
    tracked = 1 << (4 * top).bit_length()  # the sketch errs by a few times 1 / tracked of the rows

    def sketched(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
        hashed = df.select(*[key_hash(*[F.col(c) for c in columns]).alias(n) for n, columns in keys.items()])
        one = hashed.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k({n}, {top}, {tracked})").alias(n) for n in keys])
        return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col("n"), F.col(n).alias("top")) for n in keys])))

    found = reduce(DataFrame.unionByName, [sketched(df, keys) for df, keys in relations])
    out = dict.fromkeys(names, NO_SPLIT)
    for row in found.collect():  # one row a name
        hot = sorted((t["item"], t["count"] / row["n"]) for t in row["top"] if t["item"] is not None and t["count"] > share * row["n"])
        if hot:
            each = tuple(salts_for(part, partitions_of(spark)) for _, part in hot)
            out[row["name"]] = Split(tuple(h for h, _ in hot), max(each), each)
    return out


#: the joins of the fact that a frequent key can load: (role, {name: key columns})
FACT_KEYS = (
    ("jobs", {"job_request": ("service_request_id",), "job_vendor": ("assigned_vendor_id",), "job_staff": ("assigned_staff_id",)}),
    ("requests", {"request_asset": ("asset_id",), "request_area": ("area_id",)}),
    ("line_items", {"item_invoice": ("invoice_id",)}),
    ("survey_questions", {"question_survey": ("survey_id",)}),
    ("csat", {"csat_survey": ("survey_id",)}),
)
#: by whom a job was done: the pair that its survey is looked up by
WORKER_PAIR = "job_worker"


def profile(roles, wanted: Sequence[str] | None = None, share: float | None = None) -> dict[str, Split]:
    """The splits of the fact's joins (those ``wanted``, by default all)."""
    relations = []
    for role, keys in FACT_KEYS:
        keys = {n: c for n, c in keys.items() if wanted is None or n in wanted}
        df = getattr(roles, role)
        if role == "jobs" and (wanted is None or WORKER_PAIR in wanted):
            df = df.withColumn("_worker", F.coalesce("assigned_staff_id", "assigned_vendor_id"))
            keys[WORKER_PAIR] = ("service_request_id", "_worker")
        if keys:
            relations.append((df, keys))
    return sketch(relations, share)


def _is_hot(keys: Sequence[Column], hashes: Sequence[int]) -> Column:
    return F.coalesce(key_hash(*keys).isin(*hashes), F.lit(False)) if hashes else F.lit(False)


def spread(keys: Sequence[Column], split: Split, by: Sequence[Column]) -> Column:
    """The salt of a row of the side with many rows a key: by a hash of ``by``."""
    h = key_hash(*keys)
    return F.when(_is_hot(keys, split.hashes), F.pmod(F.xxhash64(*by), split.parts(h)).cast("int")).otherwise(0)


def _all_salts(keys: Sequence[Column], split: Split) -> Column:
    return F.sequence(F.lit(0), split.parts(key_hash(*keys)) - 1)


def copied(keys: Sequence[Column], split: Split) -> Column:
    """The salts of a row of the side with few rows a key: all of them for a frequent key."""
    return F.explode(F.when(_is_hot(keys, split.hashes), _all_salts(keys, split)).otherwise(F.array(F.lit(0))))


_SALT = "_hot_salt"


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", left_split: Split = NO_SPLIT,
               by: Sequence[str] = (), right_split: Split = NO_SPLIT, right_by: Sequence[str] = ()) -> DataFrame:
    """``left.join(right, keys, how)`` with the frequent keys of ``left`` spread by ``by``, and
    (inner joins only) those frequent in ``right`` alone spread by ``right_by``."""
    if right_split.hashes and how != "inner":
        raise ValueError("rows of the left side can be repeated in inner joins only")
    alone = [i for i, h in enumerate(right_split.hashes) if h not in left_split.hashes]
    only_right = right_split._replace(hashes=tuple(right_split.hashes[i] for i in alone),
                                      each=tuple(right_split.each[i] for i in alone) if right_split.each else ())
    if not left_split.hashes and not only_right.hashes:
        return left.join(right, on=list(keys), how=how)
    columns = [F.col(k) for k in keys]
    same = [F.col(k).cast(left.schema[k].dataType) for k in keys]  # a hash depends on the type
    left_salt, right_salt = spread(columns, left_split, [F.col(c) for c in by or keys]), copied(same, left_split)
    if only_right.hashes:
        left_salt = F.explode(F.when(_is_hot(columns, only_right.hashes), _all_salts(columns, only_right)).otherwise(F.array(left_salt)))
        right_salt = F.explode(F.when(_is_hot(same, left_split.hashes), _all_salts(same, left_split))
                               .otherwise(F.array(spread(same, only_right, [F.col(c) for c in right_by or keys]))))
    joined = left.withColumn(_SALT, left_salt).join(right.withColumn(_SALT, right_salt), on=[*keys, _SALT], how=how)
    return joined.drop(_SALT)
