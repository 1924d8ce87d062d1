"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobfacts.operators import hotkeys

#: ASCII white space, as Java and RE2 regular expressions
WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]+"

_LOCAL_WORK = "/tmp/checkpoints"


def by_value(module: str) -> None:
    """Send the module's functions to the workers with each job, so that these need no copy
    of this library on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and written archives: ``spark.checkpoint.dir``.

    Only a local master, where the driver is the executor, may do without the setting.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = _LOCAL_WORK
    return path.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages restart from the
    files, so a lost executor costs no recomputation beyond its running tasks."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Maximal runs of non-white characters, in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


#: rows that may be broadcast, of tables of a few narrow columns (about 100 MB at most)
MAX_BROADCAST = 1_000_000


def bounded(df: DataFrame, limit: int = MAX_BROADCAST) -> DataFrame:
    """``df`` (a written table, so that counting is cheap), marked for broadcast if its row
    count is at most ``limit``; any other is left to a shuffle."""
    return F.broadcast(df) if df.count() <= limit else df


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int | None = None,
                limit: int = MAX_BROADCAST) -> DataFrame:
    """Equi-join in which no left key, however frequent, loads one task.

    ``right`` is a written table with few rows a key.  Counted to be small, it is broadcast
    and the left rows stay where they are.  Otherwise a sketch of ``left`` finds its frequent
    keys; their rows, and no others, spread over as many tasks as their share asks for (or
    ``salts``), and ``right``'s rows of these keys are repeated for each.
    """
    if right.count() <= limit:
        return left.join(F.broadcast(right), on=keys, how=how)
    split = hotkeys.sketch([(left, {"k": keys})])["k"]
    if salts and split.hashes:
        split = hotkeys.Split(split.hashes, salts)
    return hotkeys.split_join(left, right, keys, how, split, [c for c in left.columns if _hashable(left.schema[c].dataType)])


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def min_labels(edges: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of an undirected edge table (a, b): rows (id, component).

    Alternates a neighbour minimum with pointer jumping; every round is written to the
    shared folder.  Ends when a round changes no label.  Isolated ids have no row.  A hub's edges
    and a large component's members are split like other frequent keys.
    """
    both = cut(edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
               .union(edges.select(F.col("b"), F.col("a"))).distinct(), label)
    labels = cut(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), label)
    while True:
        # an edge's end or a component's root may be frequent: both joins split such keys
        others = labels.select(F.col("id").alias("other"), "component")
        near = salted_join(both, others, ["other"]).groupBy("id").agg(F.min("component").alias("near"))
        moved = cut(labels.join(near, "id").select("id", "component", F.least("component", "near").alias("to")), label)
        jump = labels.select(F.col("id").alias("to"), F.col("component").alias("root"))
        after = cut(salted_join(moved, jump, ["to"], "left")
                    .select("id", F.least(F.col("to"), F.coalesce("root", "to")).alias("component"),
                            (F.least(F.col("to"), F.coalesce("root", "to")) != F.col("component")).alias("changed")), label)
        labels = after.select("id", "component")
        if after.where("changed").limit(1).count() == 0:
            return labels
