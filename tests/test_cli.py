from qafila import cli
from qafila.sources import files


def test_curate_generate_summarise(spark, tmp_path):
    v = [f"كلمة طويلة {i}" for i in range(4)]
    rows = [(i, "ع", "غ", 2, v if i < 2 else [*v, f"a{i}", "b"], "http://x", "p", "قديم", "فصيح") for i in range(5)]
    raw, poems, out, report = (str(tmp_path / n) for n in ("raw", "poems", "out", "report.json"))
    spark.createDataFrame(rows, "row_idx bigint, poem_title string, poem_theme string, poem_meter bigint, poem_verses array<string>, poem_url string, poet_name string, poet_era string, poem_language_type string").write.parquet(raw)
    assert cli.main(["curate", "--input", raw, "--output", poems, "--classical"], spark) == 0
    assert spark.read.parquet(poems).count() == 4
    assert cli.main(["generate", "--input", poems, "--output", out, "--task", "mcq", "--limit", "3", "--manifest", report, "--log", str(tmp_path / "log"), "--trace", str(tmp_path / "trace")], spark) in (0, 1)
    told = files.read_document(report)
    assert told["generated"] + told["failed"] == 9 == spark.read.parquet(out).count() + told["failed"] and told["complete"] == (told["failed"] == 0)
    assert set(told["template_id_counts"]) == {"poem_meter", "poem_theme", "poem_title"} and sum(told["sft_split_counts"].values()) == told["generated"]
    assert [e["event"] for e in files.read_events(str(tmp_path / "trace"))] == ["run_start", "run_end"]
    assert cli.main(["pilot", "--input", poems, "--output", str(tmp_path / "pilot"), "--task", "mcq"], spark) in (0, 1)
    env = str(tmp_path / "env")
    with open(env, "w") as f:
        f.write("ENDPOINT_1_URL=http://127.0.0.1:9/a\nENDPOINT_2_URL=http://127.0.0.1:9/b\n")
    assert cli.main(["generate", "--input", poems, "--output", out, "--task", "mcq", "--env", env], spark) == 2
    assert cli.main(["summarise", "--input", str(tmp_path / "none"), "--output", out], spark) == 2
