import hashlib

import pytest
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators import canonical as C

DDL = "row_idx bigint, poem_title string, poem_theme string, poem_meter bigint, poem_verses array<string>, poem_url string, poet_name string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def test_majority_metadata_and_provenance(spark):
    v = ["اول", "ثان"]
    df = rows(spark, (1, None, None, 0, v, "http://a", "p"), (2, "T", None, 10, v, "http://b", "p"), (3, "T2", "th", 10, v, "http://a", "p"), (4, "T3", "th", 10, v, "", "p"))
    (r,) = C.canonicalize(df).collect()
    assert (r.meter_id, r.meter_name, r.metadata_conflict, r.tied) == (10, "المديد", True, False)
    assert r.poem_title == "T2" and list(r.source_row_indices) == [1, 2, 3, 4] and list(r.source_urls) == ["http://a", "http://b"]
    assert r.sample_id == hashlib.sha256("اول␞ثان".encode()).hexdigest()


def test_first_row_wins_equal_scores_and_blank_counts_as_filled(spark):
    df = rows(spark, (5, "", "x", 1, ["a", "b"], None, None), (2, " ", None, 1, ["a", "b"], None, None))
    (r,) = C.canonicalize(df).collect()
    assert r.poem_title == " " and r.poet_name == ""


def test_unknown_meters_and_sources(spark):
    source = spark.createDataFrame([(1, None, None, 99, ["a", "b"], "u1", "p"), (2, None, None, 99, ["a", "b"], None, "p"), (3, None, None, 1, ["c"], "u", "p")], "row_idx bigint, poem_title string, poem_theme string, poem_meter bigint, poem_verses array<string>, poem_url string, poet_name string")
    with pytest.raises(Exception, match="Unknown meter ID: 99"):
        C.canonicalize(source, on_invalid="drop").collect()
    (r,) = C.canonicalize(source, on_invalid="drop", on_meter="flag", arrays=False).collect()
    assert r.meter_name is None and r.first_row == 1 and "source_urls" not in r
    assert sorted((s.row_idx, s.poem_url) for s in C.sources(source, "drop").collect()) == [(1, "u1"), (2, None)]


def test_ties(spark):
    df = rows(spark, (1, None, None, 3, ["a", "b"], None, None), (2, None, None, 2, ["a", "b"], None, None))
    (r,) = C.canonicalize(df, on_tie="flag").collect()
    assert (r.meter_id, r.tied) == (2, True)
    with pytest.raises(Exception, match="Tied meters of the poem first seen in row"):
        C.canonicalize(df).collect()


def test_equal_joins_of_different_lists_stay_apart(spark):
    df = rows(spark, (1, None, None, 3, ["a␞b", "c"], None, None), (2, None, None, 3, ["a", "b␞c"], None, None))
    assert C.canonicalize(df).count() == 2


@pytest.mark.parametrize("verses, meter", [(None, 1), ([], 1), (["a"], 1), (["a", "b"], None)])
def test_invalid_rows(spark, verses, meter):
    df = rows(spark, (7, None, None, meter, verses, None, None))
    assert C.canonicalize(df, on_invalid="drop").count() == 0 and C.invalid_rows(df).count() == 1
    with pytest.raises(Exception, match="Source row 7"):
        C.canonicalize(df).collect()


def test_empty_table(spark):
    assert C.canonicalize(rows(spark)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    df = rows(spark, (1, None, None, 1, ["a", "b"], None, None)).withColumns({"key": F.lit(1), "votes": F.lit(2), "verses": F.lit("x"), "b": F.lit(0)})
    assert C.canonicalize(df).count() == 1


def test_text_functions(spark):
    df = spark.createDataFrame([("ab" * 32, ["x", "y", "z", "w"]), ("0" * 64, [])], "s string, v array<string>")
    out = df.select(X.format_poem(F.col("v")).alias("t"), X.sft_split(F.col("s")).alias("p"), X.couplet_count(F.col("v")).alias("n"), X.corruption_count(F.col("s"), F.lit(2)).alias("c")).collect()
    assert [r.t for r in out] == ["x = y\nz = w", ""] and [r.n for r in out] == [2, 0]
    for r, s in zip(out, ("ab" * 32, "0" * 64), strict=True):
        b = int(s[:8], 16) % 100
        assert r.p == ("train" if b < 98 else "validation" if b == 98 else "test")
        assert r.c == int(hashlib.sha256(f"reconstruction-count:{s}".encode()).hexdigest()[:16], 16) % 2 + 1
