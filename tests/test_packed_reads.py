"""Merges are right where one read partition packs the files of several tasks, as with a default parallelism of 1."""

import pytest

from qafila.operators.components import components


@pytest.fixture
def packed(spark):
    keys = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def test_components_over_packed_files(packed):
    edges = packed.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint").repartition(6)
    assert {r.component for r in components(edges).collect()} == {0}
