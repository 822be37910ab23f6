import unicodedata as ud

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qafila.llm import unify as U

ALPHABET = "aZé ـبيكهةأآا١٢" + "کیھہ۱۲۴" + "оеАΒ" + "ﻣﻨﺬ" + "َّ́ٔٓ" + "​‏­﻿" + " 　\n\t  " + "ＡｂｃＯ.،-_"


def naive(s):
    """The definition over the whole text, with no segments and no quick checks."""
    drop = {o: None for o in U._tables()[1]}
    for _ in range(3):
        s = ud.normalize("NFKC", s.translate(drop))
        s = U._WORD.sub(U._own_letters, s)
    return " ".join(s.split())


@settings(max_examples=1500, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_segments_equal_the_whole(s):
    got = U.consistent(s)
    assert got == naive(s)
    assert U.consistent(got) == got


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=30))
def test_any_text(s):
    assert U.consistent(U.consistent(s)) == U.consistent(s)
    import re

    if U.consistent(s) != s:
        assert re.search(U.SUSPECT, s)


def test_examples():
    for dirty, clean in [
        ("Thе", "The"), ("А Formal", "А Formal"), ("Песня", "Песня"), ("ﻣﻨﺬﺭ", "منذر"), ("ضیاء", "ضياء"), ("ع‏ثمان", "عثمان"), ("é", "é"), ("  a  b ", "a b"),
        ("​", ""), ("​ ​", ""), ("۱۲۴", "١٢۴"), ("بـسِم", "بـسِم"), ("", ""), ("أ", "أ"), ("AБВ", "AБB"),
    ]:
        assert U.consistent(dirty) == clean, dirty
    assert U.consistent(None) is None


def test_words():
    assert U.words("Thе قالَ، بـيت\n x_1") == ["the", "قال", "بيت", "x_1"] and U.words(None) == U.words("") == U.words(" .") == []


def test_tables(spark):
    ddl = "record_no bigint, poet_name string, poem_title string, verses array<string>, value string, field int"
    rows = [(1, "ضیاء", None, ["a", "ب  ب", None, ""], "x", 1), (2, None, " ", None, "x", 1), (3, "ok", " ", [], "x", 1), (1, "ضیاء", None, ["a"], "x", 1)]
    df = spark.createDataFrame(rows, ddl)
    got = sorted((r.record_no, r.field, r.item_no) for r in U.unify_values(df).collect())
    assert got == [(1, "poet_name", 0), (1, "poet_name", 0), (1, "verses", 1)]
    whole = {r.record_no: r for r in U.unify_records(df.limit(3)).collect()}
    assert whole[1].poet_name == "ضياء" and list(whole[1].verses) == ["a", "ب ب", None, ""] and whole[2].verses is None and whole[3].poem_title == ""
    assert U.unify_values(df.filter(F.lit(False))).count() == 0


def test_very_long(spark):
    s = "ب" * 200_000 + "ی" * 10
    assert U.consistent(s) == "ب" * 200_000 + "ي" * 10
