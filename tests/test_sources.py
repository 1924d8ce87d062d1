"""Declared source schemas match the files; role adapters have the documented schemas."""

import pytest

from jobfacts.sources.roles import Roles
from jobfacts.sources.tables import SCHEMAS, read_table, table_path
from tests.rolefixtures import SCHEMAS as ROLE_SCHEMAS


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_schemas_match_files(spark, sf):
    d = f"/root/testdata/{sf}"
    for name in SCHEMAS:
        inferred = spark.read.parquet(table_path(d, name)).schema
        declared = read_table(spark, d, name).schema
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name


def test_role_schemas(spark):
    r = Roles(spark, "/root/testdata/sf0.001")
    for name, cols in ROLE_SCHEMAS.items():
        got = [(f.name, f.dataType) for f in getattr(r, name).schema]
        assert got == list(cols), name


def test_cluster_settings_apply(spark):
    from jobfacts.session import CLUSTER_SETTINGS, apply_cluster_settings
    before = {k: spark.conf.get(k, None) for k in CLUSTER_SETTINGS}
    try:
        apply_cluster_settings(spark)
        for k, v in CLUSTER_SETTINGS.items():
            assert spark.conf.get(k) == v, k
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
