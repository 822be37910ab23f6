import random

from pyspark.sql import functions as F

from qafila.functions import seeded
from qafila.operators import selection as S


def pack(lines, limit):
    out = []
    for line in lines:
        if out and len(out[-1]) + 1 + len(line) <= limit:
            out[-1] += "\n" + line
        else:
            out.append(line)
    return out


def test_packing_against_a_plain_loop(spark):
    rng = random.Random(5)
    data = [(i, ["x" * rng.randrange(1, 40) for _ in range(rng.randrange(0, 12))]) for i in range(120)]
    got = spark.createDataFrame(data, "i int, lines array<string>").select("i", S.packed_chunks(F.col("lines"), 50).alias("c")).collect()
    assert {r.i: list(r.c) for r in got} == {i: pack(lines, 50) for i, lines in data}


def test_ranks_are_global(spark):
    data = [(i % 7, f"k{i}") for i in range(200)]
    got = S.ranked(spark.createDataFrame(data, "cost int, k string"), "cost", "k").collect()
    assert [(r.cost, r.k) for r in sorted(got, key=lambda r: r["rank"])] == sorted(data) and {r["rank"] for r in got} == set(range(1, 201))


def test_strata(spark):
    data = [("a", f"{i:03}") for i in range(50)] + [("b", "x")]
    df = spark.createDataFrame(data, "s string, id string")
    got = S.first_per_stratum(df, "s", {"a": 3, "b": 2, "c": 1}, "id").collect()
    assert sorted((r.s, r.id) for r in got) == [("a", "000"), ("a", "001"), ("a", "002"), ("b", "x")]
    assert {(r.s, r.quota, r.have) for r in S.shortfalls(df, "s", {"a": 3, "b": 2, "c": 1}).collect()} == {("b", 2, 1), ("c", 1, 0)}


def test_latest_and_work_items(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, t int, v string")
    assert [r.v for r in S.latest(df, "k", "t").collect()] == ["new"]
    poems = spark.createDataFrame([("s1", "الرجز", None, " "), ("s2", "الرمل", "t", "x")], "sample_id string, meter_name string, poem_theme string, poem_title string")
    assert sorted(r.work_id for r in S.work_items(poems).collect()) == ["mcq:s1:poem_meter", "mcq:s2:poem_meter", "mcq:s2:poem_theme", "mcq:s2:poem_title"]


def test_seeded_choices(spark):
    data = [(f"{i:064x}", "poem_meter", i % 9) for i in range(1000)]
    df = spark.createDataFrame(data, "s string, t string, n int")
    got = df.select("s", seeded.prompt_index("s", "t").alias("p"), seeded.prefix_length("s", "n").alias("k"), "n").collect()
    counts = [sum(r.p == i for r in got) for i in range(5)]
    assert all(150 <= c <= 250 for c in counts)
    assert all(r.k is None if r.n < 2 else 1 <= r.k < r.n for r in got)
    order = seeded.choice_order_py("w", ["right", "b", "c", "d"])
    assert [c["label"] for c in order] == ["أ", "ب", "ج", "د"] and [c["text"] for c in order if c["correct"]] == ["right"]
