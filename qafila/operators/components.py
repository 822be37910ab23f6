"""Connected components by distributed union-find: local forests, merged hierarchically.

Every task reduces its own edges to a forest: each node with the smallest node of its local component. Two forests are
the same component where they share a node, so a level merges forests in two steps: a shuffle by node finds the nodes
that several forests share, and what these say, an edge between the two local components, is all that goes up to the
next level, a fraction of the rows in a fraction of the tasks. A component that no other forest shares is done and goes
up no further. The last level is one task.

Tasks of a level are as many as TASK_ROWS rows each need, at most half as many as below. Edges are placed by the end of
smaller hash, so that every level joins a share of what is left, however the input was laid out. On the way back each level renames its components by
what the level above says. No task ever holds all nodes, only the last few links between components.

Hot nodes do no harm: at level 0 edges stay where they are (no shuffle by node), a local forest holds each node once
however many edges it has, and a node shared by all forests has one row for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qafila.runtime import cut

#: Rows one merging task holds.
TASK_ROWS = 1_000_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one partition, as they stream by; the smallest node is the root."""
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = list(parent)
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pd.DataFrame({"a": part, "b": [find(x) for x in part]})


def components(edges: DataFrame, a: str = "a", b: str = "b", task_rows: int = TASK_ROWS) -> DataFrame:
    """node, component (the smallest node of it) for every node on an edge; loops name single nodes.

    Rows with a null end are left out; repeated edges and both directions are fine; no edges give no rows.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    return _merged(links, task_rows, None).select(F.col("a").alias("node"), F.col("b").alias("component"))


def _merged(links: DataFrame, task_rows: int, most: int | None) -> DataFrame:
    """a, b: every node with the smallest of its component; this level's forests, renamed by the level above."""
    forests = cut(links.mapInPandas(_forest, links.schema))
    tasks = len(forests.inputFiles())  # not read partitions: one may pack the files of several tasks
    if tasks <= 1:
        return forests
    if forests.count() <= task_rows:  # one task holds them all
        return cut(forests.coalesce(1).mapInPandas(_forest, links.schema))
    # a local component is known by its root: two with the same root share that node and are one
    shared = forests.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).filter("low <> high").select("a", "low")
    above = cut(forests.join(shared, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
    rows = above.count()
    if rows == 0:
        return forests.distinct()
    fewer = max(1, min(-(-rows // task_rows), (most or tasks) // 2))
    placed = above.coalesce(1) if fewer == 1 else above.repartition(fewer, F.least(F.xxhash64("a"), F.xxhash64("b")))
    names = _merged(placed, task_rows, fewer).select(F.col("a").alias("b"), F.col("b").alias("top"))
    return cut(forests.join(names, "b", "left").select("a", F.coalesce("top", "b").alias("b")).distinct())
