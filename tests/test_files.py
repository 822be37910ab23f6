import json
import os
import re

import pytest
from pyspark.sql import functions as F

from qafila.operators import contracts
from qafila.operators import curation as U
from qafila.operators import render as R
from qafila.sources import files

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    files.write_jsonl(spark.createDataFrame([(1, "ن"), (2, None)], "a int, b string"), path)
    with open(tmp_path / "extra.txt", "w") as f:
        f.write("\n{broken\n")
    good = files.read_jsonl(spark, path, "a int, b string")
    assert sorted((r.a, r.b) for r in files.require_readable(good).collect()) == [(1, "ن"), (2, None)]
    bad = files.read_jsonl(spark, str(tmp_path / "extra.txt"), "a int")
    with pytest.raises(Exception, match="Not a JSON object: {broken"):
        files.require_readable(bad).collect()
    with pytest.raises(Exception, match="Not a JSON object in line 2: {broken"):
        files.require_readable(files.read_jsonl(spark, str(tmp_path / "extra.txt"), "a int", numbered=True)).collect()
    files.write_jsonl(spark.createDataFrame([(3, "x")], "a int, b string"), path, "append")
    assert files.read_jsonl(spark, path, "a int").count() == 3


def test_line_numbers_across_blocks(spark, tmp_path):
    with open(tmp_path / "many.txt", "w") as f:
        f.writelines(f"line {i}\n" for i in range(1, 2001))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = files.numbered_lines(spark, str(tmp_path / "many.txt")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2000 and all(r.value == f"line {r.line_no}" for r in rows)


def test_driver_side_log_and_environment(tmp_path):
    log, env = str(tmp_path / "log.jsonl"), str(tmp_path / ".env")
    files.append_event({"a": "ن"}, log)
    files.append_event({"a": 1}, log, version=None)
    assert [json.loads(x) for x in open(log, encoding="utf-8")] == [{"checkpoint_version": 3, "a": "ن"}, {"a": 1}]
    with open(env, "w") as f:
        f.write("# a comment\n\nexport ENDPOINT_1_URL='http://a'\nENDPOINT_2_URL=http://b\nENDPOINT_KEY=k\nENDPOINT_2_MODEL=\"m\"\n")
    got = files.endpoints_from_env(files.read_env(env))
    assert [(e["url"], e["api_key"], e["model"]) for e in got] == [("http://a", "k", None), ("http://b", "k", "m")]


def test_records_and_splits(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    assert not files.write_records(df.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    assert files.write_records(df, str(tmp_path / "one"))
    both = files.read_splits(spark, {"train": str(tmp_path / "one"), "test": str(tmp_path / "one")})
    assert sorted(r.split for r in both.collect()) == ["test", "train"]
    with pytest.raises(ValueError):
        files.read_splits(spark, {})


def test_documents_and_fingerprints(tmp_path):
    path = str(tmp_path / "r.json")
    files.write_document({"a": "ن"}, path)
    assert files.read_document(path) == {"a": "ن"} and open(path).read().endswith("}\n")
    assert files.digest({"b": 1, "a": 2}) == files.digest({"a": 2, "b": 1})
    one = files.fingerprint(path)
    assert len(one) == 64 and files.fingerprint(str(tmp_path)) != one


def test_endpoint_settings():
    assert [e["endpoint_id"] for e in files.endpoints_from_env({"ENDPOINT_1_URL": "http://a", "ENDPOINT_2_URL": "http://b"})] == ["endpoint_1", "endpoint_2"]
    for env in ({}, {"ENDPOINT_URL": "http://a", "ENDPOINT_1_URL": "http://b"}, {"ENDPOINT_2_URL": "http://a"}, {"ENDPOINT_URL": "ftp"}, {"ENDPOINT_URL": "http://a", "ENDPOINT_MAX": "0"}):
        with pytest.raises(ValueError):
            files.endpoints_from_env(env)


def test_curation(spark):
    df = spark.createDataFrame([(1, "p", "x", "نص من فاس وفاسي"), (2, None, "x", "فاس"), (3, "q", None, None)], "row_idx bigint, poet_name string, poet_location string, bio string")
    assert [r.poet_name for r in U.authors_at(df, "x").collect()] == ["p"]
    first = U.first_texts(df, df.limit(0).select("poet_name"), "bio")
    assert {r.row_idx: list(r.trigger_terms) for r in U.trigger_terms(first, "bio", ["فاس"]).collect()} == {1: ["فاس"], 2: ["فاس"]}


def test_compose_response(spark):
    poem = "a = b\nc = d"
    cases = {f"{poem}\nx": "x", f"x\nالقصيدة:\n{poem}\n\n\n\ny": "x\n\ny", f"x  \n{R.RESULT}\nz": "x", "": ""}
    df = spark.createDataFrame([(k, poem) for k in cases], "r string, p string").select("r", R.compose_response(F.col("r"), F.col("p")).alias("o"))
    assert {r.r: r.o for r in df.collect()} == {k: f"{v}\n\n{R.RESULT}\n\n{poem}" for k, v in cases.items()}
    with pytest.raises(Exception, match="Unknown meter name"):
        spark.range(1).select(R.feet(F.lit("none"))).collect()


def test_own_examples_parse(spark):
    (r,) = spark.range(1).select(R.instruction_messages(F.lit("sound"), F.lit("الرجز"), F.lit(2), F.lit("x"), 10).alias("m")).collect()
    assert [m.role for m in r.m] == ["system", "user", "assistant", "user", "assistant", "user"]
    assert [m.content for m in r.m if m.role == "assistant"] == [a for _, a in R.SHOTS]
    for (_, answer), meter, n in zip(R.SHOTS, ("الرجز", "النثر"), (2, 3), strict=True):
        assert contracts.instruction_errors_py(contracts.instruction_of(json.loads(answer)), meter, n, [], 200) == []


def test_core_never_imports_the_training_data_subpackage():
    name = re.compile(r"^\s*(?:from|import)\s+qafila\.llm", re.M)
    for folder, _, names in os.walk(os.path.join(HERE, "qafila")):
        if os.path.basename(folder) != "llm":
            assert not [n for n in names if n.endswith(".py") and name.search(open(os.path.join(folder, n)).read())]
