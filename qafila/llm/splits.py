"""Problem 5: train, validation and test splits that keep related records together.

Method: distributed union-find with local forests merged hierarchically (qafila.operators.components) over links between
records and their poets, then greedy largest-first assignment of groups to the split furthest below its target.

* A record links to the poet its credit means under any spelling; the spellings of a poet are linked by
  names.link_names. A credit that names nobody links nothing. Records sharing a sample_id are one node.
* A poet may be on a third of all rows. Credits are made distinct before they are joined, the sides joined by poet or
  group are broadcast where a count shows them small, and are else left to AQE's skew join; components never shuffle
  edges by node at first.
* Greedy assignment is sequential, but its outcome depends only on how many groups there are of each size. Those
  counts (of distinct sizes at most the square root of twice the items) go to the driver, the greedy rule is played on
  them, equal picks at a time, and yields how many groups of each size each split gets. Within a size groups are ranked
  by a hash across range-partitioned, sorted tasks, and the ranks are cut into runs. No task holds a size class.

Defined results: items without sample_id form one group each by their work_id; repeated items stay together; a sample_id
not in the records is its own group; empty input gives no rows. Ties between splits go to the one named first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qafila.llm.names import link_names
from qafila.operators.components import components
from qafila.runtime import cut, small

SHARES = (("train", 0.98), ("validation", 0.01), ("test", 0.01))


def poet_ids(records: DataFrame, names: DataFrame, given_names: DataFrame) -> DataFrame:
    """sample_id, person_id: the poets that the records' credits mean; a credit spelled as in names."""
    people = cut(link_names(names, given_names))
    spelled = names.select("name_id", "poet_name").join(people, "name_id").select("poet_name", "person_id").distinct()
    # one credit may stand on a third of all records: repeats collapse before the join, and the small side is by spelling
    credits = records.select("sample_id", "poet_name").filter("sample_id is not null and poet_name is not null").distinct()
    return credits.join(small(cut(spelled)), "poet_name").select("sample_id", "person_id").distinct()


def related_groups(items: DataFrame, records: DataFrame, names: DataFrame, given_names: DataFrame) -> DataFrame:
    """work_node, component for every node of the items; nodes are tagged sample_ids, work_ids and person_ids."""
    poets = cut(poet_ids(records, names, given_names))
    by_poet = poets.select(F.concat(F.lit("s:"), "sample_id").alias("a"), F.concat(F.lit("p:"), F.col("person_id").cast("string")).alias("b"))
    own = _node(items).distinct().select(F.col("node").alias("a"), F.col("node").alias("b"))
    return components(by_poet.unionByName(own))


def _node(items: DataFrame) -> DataFrame:
    return items.select(F.coalesce(F.concat(F.lit("s:"), "sample_id"), F.concat(F.lit("w:"), "work_id"), F.lit("w:")).alias("node"))


def greedy_counts(sizes: dict[int, int], shares: tuple[tuple[str, float], ...] = SHARES) -> dict[int, list[tuple[str, int]]]:
    """size -> runs of (split, groups), by the greedy rule: largest groups first, each to the split furthest below target."""
    total = sum(s * n for s, n in sizes.items())
    lack = {name: share * total for name, share in shares}
    order = [name for name, _ in shares]
    out: dict[int, list[tuple[str, int]]] = {}
    for size in sorted(sizes, reverse=True):
        left, runs = sizes[size], []
        while left:
            ranked = sorted(order, key=lambda x: (-lack[x], order.index(x)))
            first, second = ranked[0], ranked[1] if len(ranked) > 1 else None
            if second is None:
                take = left
            else:  # picks of `first` in a row: until it no longer leads
                gap = (lack[first] - lack[second]) / size
                take = max(1, min(left, int(gap) + (1 if gap > int(gap) or order.index(first) < order.index(second) else 0)))
            if len(ranked) > 1 and take == 1 and left > 3 * len(order) and lack[ranked[0]] - lack[ranked[-1]] < size:
                rounds = left // len(order) - 1  # all within one group of each other: they take turns
                runs += [(x, rounds) for x in order]
                for x in order:
                    lack[x] -= rounds * size
                left -= rounds * len(order)
                continue
            runs.append((first, take))
            lack[first] -= take * size
            left -= take
        merged: dict[str, int] = {}
        for name, n in runs:
            merged[name] = merged.get(name, 0) + n
        out[size] = [(name, merged[name]) for name in order if name in merged]
    return out


def assign_splits(groups: DataFrame, shares: tuple[tuple[str, float], ...] = SHARES) -> DataFrame:
    """component, split for groups (component, size); exact greedy counts of every size class."""
    spark = groups.sparkSession
    sizes = {r["size"]: r["n"] for r in groups.groupBy("size").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return groups.select("component", F.lit("train").alias("split"))
    runs, rows = greedy_counts(sizes, shares), []
    for size, parts in runs.items():
        at = 0
        for name, n in parts:
            rows.append((size, at, at + n, name))
            at += n
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = groups.withColumn("h", F.xxhash64("component"))
    ordered = cut(hashed.repartitionByRange(tasks, F.desc("size"), "h", "component").withColumn("task", F.spark_partition_id()))
    # ranks inside a task, then offset by what earlier tasks hold of the size: tasks x (sizes in them) rows, not groups
    held = ordered.groupBy("size", "task").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    before = held.withColumn("offset", F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    local = ordered.withColumn("r", F.row_number().over(Window.partitionBy("task", "size").orderBy("h", "component")) - 1)
    ranked = local.join(before, ["size", "task"]).withColumn("rank", F.col("r") + F.col("offset"))
    plan = spark.createDataFrame(rows, "size bigint, low bigint, high bigint, split string")
    return ranked.join(plan, "size").filter("rank >= low and rank < high").select("component", "split")


def split_items(items: DataFrame, records: DataFrame, names: DataFrame, given_names: DataFrame, shares: tuple[tuple[str, float], ...] = SHARES) -> DataFrame:
    """The items (work_id, sample_id) with group and split; repeated items once each row."""
    nodes = cut(related_groups(items, records, names, given_names))
    rows = items.select("work_id", "sample_id").withColumn("node", F.coalesce(F.concat(F.lit("s:"), "sample_id"), F.concat(F.lit("w:"), "work_id"), F.lit("w:")))
    grouped = cut(rows.join(nodes, "node"))
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    splits = cut(assign_splits(sizes, shares))
    return grouped.join(small(splits), "component").select("work_id", "sample_id", F.col("component").alias("group_id"), "split")


def poet_groups(items: DataFrame, records: DataFrame, names: DataFrame, given_names: DataFrame) -> DataFrame:
    """sample_id, group_id of the items' poems whose poet is known: the smallest name_id among the poet's spellings.

    The groups are the operator's components; a component is named by the smallest person it holds.
    """
    nodes = cut(related_groups(items, records, names, given_names))
    people = nodes.filter(F.col("node").startswith("p:")).groupBy("component").agg(F.min(F.expr("cast(substring(node, 3) as bigint)")).alias("group_id"))
    poems = nodes.filter(F.col("node").startswith("s:")).select(F.expr("substring(node, 3)").alias("sample_id"), "component")
    wanted = items.select("sample_id").distinct()
    return poems.join(wanted, "sample_id").join(small(cut(people)), "component").select("sample_id", "group_id")
