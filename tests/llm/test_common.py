import random
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from jobfacts.llm import common
from tests.llm.helpers import sorted_rows

REPO = Path(__file__).resolve().parents[2]


def test_salted_join_equals_a_plain_join(spark):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        want = sorted_rows(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()))
        for limit in (10 ** 6, -1):
            got = common.salted_join(left, right, ["k"], how, salts=5, limit=limit).select("id", "k", "v").collect()
            assert sorted_rows(map(tuple, got)) == want


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(400, 400 + i) for i in range(1, 30)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = common.min_labels(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {x: find(x) for x in root}
    assert common.min_labels(spark.createDataFrame([], "a long, b long")).collect() == []


def test_nothing_else_imports_the_subpackage():
    """The entry module alone names it, and works without it."""
    users = [p for p in REPO.glob("jobfacts/**/*.py") if "llm" not in p.parts and "jobfacts.llm" in p.read_text()]
    assert users == []
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path, target=None):\n"
            "        if name.startswith('jobfacts.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert not any(k.startswith('op') for k in e.queries()) and 'pipeline' not in e.queries()\n")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=60)
