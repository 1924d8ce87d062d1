"""Small documents and plain-Python versions that the operators are held against."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: names that the operators use themselves
CLASHING = ("doc", "t", "w", "id", "h", "h1", "k", "key", "vid", "n", "n_words", "kept", "line", "ids", "score", "item_id", "pos", "_id", "_salt")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(c) for c in CLASHING})


def duck(tables: dict[str, list[tuple]], columns: dict[str, str], sql: str) -> list[tuple]:
    con = duckdb.connect()
    for name, rows in tables.items():
        con.execute(f"CREATE TABLE {name} ({columns[name]})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return [tuple(r[names.index(c)] for c in sorted(names)) for r in got.fetchall()]


def rows_of(df) -> list[tuple]:
    return [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]


def sorted_rows(rows):
    return sorted(rows, key=repr)


def words(rng: random.Random, n: int, vocab: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))

