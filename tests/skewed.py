"""A skewed variant of the test data: one key holds a third of the rows.

Used to check that the plans stay correct and balanced when a single job, request or
worker owns a third of its table (the shape a real fleet produces: one huge account).
Every row whose id is divisible by 3 is moved onto one hot key; everything else is the
driver's data.  Keys that are unique by nature stay unique (line items, survey ids), so
the skew does not invent many-to-many joins the modelled data cannot have.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts.sources.roles import Roles

HOT_JOB = 1          # a live job at every scale factor
HOT_REQUEST = 1
HOT_WORKER = 1


def _hot(every: Column, hot: int, col: str) -> Column:
    return F.when(every % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col(col))


class SkewedRoles(Roles):
    """Roles over the same tables with a third of each child table on one hot key.

    ``map_tasks`` spreads each table over that many tasks first (round robin), as a
    cluster's many input splits would; runtime skew splitting can only cut a hot
    partition along map outputs, and the test files have one to three splits.
    """

    def __init__(self, spark, sf_dir: str, map_tasks: int = 0):
        super().__init__(spark, sf_dir)
        self.map_tasks = map_tasks

    def table(self, name: str) -> DataFrame:
        df = super().table(name)
        if self.map_tasks:
            df = df.repartition(self.map_tasks)
        if name == "lineitem":
            # invitations, note files, schedules, line items, approvers, history: a third of
            # each on one job (and one approval, one note)
            return df.withColumn("l_orderkey", _hot(F.col("l_orderkey"), HOT_JOB, "l_orderkey"))
        if name == "orders":
            # a third of all jobs (and of the notes) under one request
            return df.withColumn("o_custkey", _hot(F.col("o_orderkey"), HOT_REQUEST, "o_custkey"))
        return df

    @cached_property
    def time_tracking(self) -> DataFrame:
        tt = super().time_tracking
        return tt.withColumn("object_id", _hot(F.xxhash64("start_period"), HOT_JOB, "object_id"))

    @cached_property
    def csat(self) -> DataFrame:
        c = super().csat
        return c.withColumn("related_entity_id", _hot(F.col("survey_id"), HOT_REQUEST, "related_entity_id"))

    @cached_property
    def survey_questions(self) -> DataFrame:
        q = super().survey_questions
        return q.withColumn("related_entity_id", F.when(F.col("question_id") % 3 == 0, F.lit(str(HOT_WORKER)))
                            .otherwise(F.col("related_entity_id")))
