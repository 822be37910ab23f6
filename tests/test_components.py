import random

import pytest

from qafila.operators.components import components


def brute(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


@pytest.mark.parametrize("task_rows", [2_000_000, 60, 20])
def test_random_graphs(spark, task_rows):
    rng = random.Random(3)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7), (900, 900)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(9)
    rows = components(df, task_rows=task_rows).collect()
    assert len(rows) == len({r.node for r in rows})
    got = {r.node: r.component for r in rows}
    assert got == brute(edges)


def test_hub_and_repeats(spark):
    edges = [(f"n{i}", "hub") for i in range(300)] * 2
    got = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert len(got) == 301 and {r.component for r in got} == {"hub"}


def test_nulls_and_empty(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
    rows = components(spark.createDataFrame([("x", None), (None, "y"), ("z", "z")], "a string, b string")).collect()
    assert [(r.node, r.component) for r in rows] == [("z", "z")]
