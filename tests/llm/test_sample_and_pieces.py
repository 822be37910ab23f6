import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qafila.llm import pieces as P
from qafila.llm import sample as S

T0 = dt.datetime(2026, 1, 1)


def records(spark, ids, t=T0):
    return spark.createDataFrame([(i, t) for i in ids], "sample_id string, loaded_at timestamp")


def test_members_stay_as_data_grows(spark, tmp_path):
    early, late = [f"a{i}" for i in range(400)], [f"b{i}" for i in range(400)]
    r = S.Registry(spark, str(tmp_path / "reg"))
    r.insert(records(spark, early))
    first = {x.sample_id: x.prn for x in r.select(0.2).collect()}
    r.insert(records(spark, late + early + [None], T0 + dt.timedelta(days=1)))
    r.insert(records(spark, late))
    second = {x.sample_id: x.prn for x in r.select(0.2).collect()}
    assert first.items() <= second.items() and r.read().count() == 800
    assert {x.sample_id for x in r.select(0.3).collect()} >= set(second)
    assert 40 <= len(first) <= 130 and r.select(0.0).count() == 0 and r.select(1.0).count() == 800
    assert all(x.first_seen == T0 for x in r.select(1.0).filter("sample_id like 'a%'").collect())
    fresh = S.growing_sample(records(spark, late + early).repartition(7), 0.2)
    assert {x.sample_id: x.prn for x in fresh.collect()} == second


def test_sample_edges(spark):
    assert S.growing_sample(records(spark, []), 0.5).count() == 0
    twice = records(spark, ["x", "x", None]).withColumns({"prn": F.lit(0.0), "folder": F.lit(3)})
    assert S.growing_sample(twice, 1.0).count() == 1


def test_range_maximum():
    rng = random.Random(1)
    s = np.array([rng.randrange(5) for _ in range(70)])
    r = P.RangeMaximum(s)
    for a in range(70):
        for b in range(a, 70):
            assert r.query(a, b) == max(range(a, b + 1), key=lambda i: (s[i], i))


def poem(n, rng=None, width=10):
    rng = rng or random.Random(0)
    return "\n".join(f"{'a' * rng.randrange(1, width)} b = {'c' * rng.randrange(1, width)}" for _ in range(n))


@pytest.mark.parametrize("chunk, overlap", [(40, 0), (40, 1), (60, 2), (200, 3), (7, 1), (1, 2)])
def test_pieces_cover_and_repeat(chunk, overlap):
    rng = random.Random(chunk)
    for n in (1, 3, 20, 60):
        t = poem(n, rng)
        spans = P.cut_points(t, chunk, overlap)
        if len(t) <= chunk:
            assert spans == [(0, len(t))]
            continue
        assert all(0 < b - a <= chunk for a, b in spans)
        covered = set().union(*(range(a, b) for a, b in spans))
        assert all(t[i] == "\n" for i in set(range(len(t))) - covered)
        assert all(x[1] < y[1] and x[0] < y[0] for x, y in zip(spans, spans[1:], strict=False))
        longest = max(map(len, t.split("\n")))
        if chunk > longest * (overlap + 2):  # then every cut is at a couplet's end and every repeat is whole
            for (a, b), (c, _) in zip(spans, spans[1:], strict=False):
                assert b == len(t) or t[b] == "\n"
                assert t[a:b].split("\n")[-overlap:] == t[c:b].split("\n") if overlap else c == b + 1


def test_cut_prefers_stronger_boundaries():
    assert P.cut_points("aaa = bbb\nccc = ddd", 12, 0)[0] == (0, 9)
    t = "aaaa bbbb = cccc"
    assert t[slice(*P.cut_points(t, 13, 0)[0])] == "aaaa bbbb = "
    assert P.cut_points("aaaa bbbb", 7, 0)[0] == (0, 5)
    marks = "ب" + "َ" * 3
    assert P.cut_points(marks * 3, 6, 0)[0] == (0, 4)


def test_records(spark):
    s = spark.createDataFrame([(1, 20, 12, 0), (2, None, 5, 0), (3, 19, 12, 1)], "settings_id int, max_source_chars int, chunk_chars int, overlap_couplets int")
    rows = [(1, "x", ["aaaa", "bbbb", "cc", "dd"]), (2, "y", ["a", None, "c"]), (3, "z", None), (4, "w", []), (5, "x", ["aaaa", "bbbb", "cc", "dd"])]
    df = spark.createDataFrame(rows, "record_no bigint, sample_id string, verses array<string>").withColumns({"s": F.lit(1), "settings_id": F.lit(9)})
    text = {r.record_no: r.t for r in df.select("record_no", P.poem_text(F.col("verses")).alias("t")).collect()}
    assert text == {1: "aaaa = bbbb\ncc = dd", 2: "a = \nc", 3: None, 4: None, 5: "aaaa = bbbb\ncc = dd"}
    assert P.oversized_ids(df, s).count() == 0  # 19 is not over 19
    longer = s.withColumn("max_source_chars", F.col("max_source_chars") - 1)
    assert [(r.sample_id, r.settings_id) for r in P.oversized_ids(df, longer).collect()] == [("x", 3)]
    got = P.cut_records(df, longer).filter("record_no = 1").orderBy("piece_no").collect()
    assert [r.piece_text for r in got] == ["aaaa = bbbb", "cc = dd"]
    assert P.cut_records(df.limit(0), longer).count() == 0 and P.oversized_ids(df, s.limit(0)).count() == 0


def test_a_lower_threshold_and_a_repeated_insert_change_nothing(spark, tmp_path):
    path = str(tmp_path / "kept")
    r = S.Registry(spark, path)
    r.insert(records(spark, [f"k{i}" for i in range(200)]))
    many = {x.sample_id for x in r.sample(0.4).collect()}
    stored = spark.read.parquet(path)  # what a job that was repeated writes
    stored.withColumn("first_seen", F.col("first_seen") + F.expr("interval 1 day")).write.mode("append").partitionBy("folder").parquet(path)
    again = S.growing_sample(records(spark, []), 0.1, path=path).collect()
    assert {x.sample_id for x in again} == many and len(again) == len(many)
    assert all(x.first_seen == T0 for x in again)
