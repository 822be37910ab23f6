"""Queries take every couplet and document, not only the first of them."""

import json
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from qafila import catalog
from qafila.functions import seeded
from qafila.functions import text as X
from qafila.operators import selection as S
from qafila.plans.selection import poems

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def rows(spark, name):
    return catalog.queries()[name](spark, DIR).collect()


def test_chunks_go_on_from_an_offset(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"], k) for k in (0, 1, 4, 5)] + [([], 0)], "x array<string>, k int")
    got = [[(c.start, c.couplets, c.before, c.after, c.first) for c in r.c] for r in df.select(S.couplet_chunks(F.col("x"), F.col("k")).alias("c")).collect()]
    assert got == [
        [(0, ["a", "b", "c"], None, "d", True), (3, ["d", "e"], "c", None, False)],
        [(1, ["b", "c", "d"], "a", "e", True), (4, ["e"], "d", None, False)],
        [(4, ["e"], "d", None, True)], [], [],
    ]


def test_a_prompt_for_every_chunk(spark):
    wanted = poems(spark, DIR).select(F.sum(F.ceil(F.col("couplet_count") / 3)).alias("n"), F.count("*").alias("poems")).first()
    assert len(rows(spark, "reasoning_prompts")) == wanted.n > wanted.poems


def test_completion_begins_with_the_seeded_prefix(spark):
    got = {r.sample_id: (r.k, r.digest) for r in rows(spark, "completion_render")}
    con = duckdb.connect()
    for r in poems(spark, DIR).filter("couplet_count >= 2").select("sample_id", "couplet_count", X.couplets(F.col("verses")).alias("lines")).collect():
        n, k = r.couplet_count, seeded.prefix_length_py(r.sample_id, r.couplet_count)
        text = "اكتب\n\nالبداية:\n" + "\n".join(r.lines[:k]) + f"\n\nأكمل {n - k} من {n} بيتا."
        assert got[r.sample_id] == (k, con.execute("select sha256(?)", [text]).fetchone()[0])
    assert len({k for k, _ in got.values()}) > 1


def test_grounding_words_of_every_document(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    fold = str.maketrans("أإآٱ", "اااا")
    word = re.compile(r"[\w\u0600-\u06ff]+")
    want = {}
    for r in docs:
        found = word.findall(X.MARK_RE.sub("", r.text).translate(fold).lower()) if r.text is not None else None
        want[r.doc_id] = None if found is None else " ".join(sorted({w for w in found if len(w) >= 3}))
    got = {r.doc_id: r.words for r in rows(spark, "grounding_words")}
    assert got == want and any(re.search("[ء-ي]{3}", w or "") for w in got.values())


def test_every_couplet_is_normalised_and_every_verse_projected(spark):
    couplets, shown = rows(spark, "couplet_normal_form"), {r.sample_id: json.loads(r.public) for r in rows(spark, "field_hiding")}
    p = poems(spark, DIR).select("sample_id", "record_no", "couplet_count", F.size("verses").alias("n")).collect()
    assert sorted((r.record_no, r.couplet_no) for r in couplets) == sorted((r.record_no, i) for r in p for i in range(1, r.couplet_count + 1))
    assert all(shown[r.sample_id] == [{"i": i, "first": i % 2 == 0} for i in range(r.n)] for r in p)
