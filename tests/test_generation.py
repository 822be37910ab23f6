"""The poem-writing tasks: every couplet is reasoned about, and the response holds the exact poem."""

import json

import pytest
from pyspark.sql import functions as F

from qafila.functions import seeded
from qafila.operators import contracts as C
from qafila.operators import conversations as K
from qafila.operators import generation as G
from qafila.operators import selection as S

SCHEMA = "sample_id string, poet_name string, meter_name string, poem_theme string, poem_title string, verses array<string>"


def lines(n):
    return [f"صدر البيت رقم {i} = عجز البيت رقم {i}" for i in range(1, n + 1)]


@pytest.fixture(scope="module")
def poems(spark):
    rows = [(f"{n:02x}" * 32, "p", "النثر" if n == 5 else "الرجز", None, "عنوان", [v for x in lines(n) for v in x.split(" = ")]) for n in (0, 1, 3, 5, 8)]
    return S.measured(spark.createDataFrame(rows, SCHEMA))


def drafts(response):
    return [x.removeprefix("الصياغة المنقحة: ") for x in response.split("\n") if x.startswith("الصياغة المنقحة: ")]


def test_generation_reasons_about_every_couplet(poems):
    got = {r.couplet_count: r for r in G.sft_records(poems, "poem-generation").collect()}
    assert sorted(got) == [1, 3, 5, 8]
    for n, r in got.items():
        assert drafts(r.response) == lines(n)
        assert r.response.endswith("النتيجة النهائية:\n\n" + "\n".join(lines(n))) and r.response.startswith("نظرة")
        assert r.instruction.startswith(C.HEADINGS[0]) and r.provided_couplet_count == 0
        assert (r.validation_status == "passed") == (r.generation_attempts == 1 + -(-n // 3))
    none = G.generate(poems.filter("couplet_count = 0"), "poem-generation").first()
    assert none.value is None and none.error == "no couplet to reason about"


def test_completion_goes_on_after_the_seeded_prefix(poems):
    rows = G.sft_records(poems, "poem-completion").collect()
    assert sorted(r.couplet_count for r in rows) == [3, 5, 8]
    for r in rows:
        n, k = r.couplet_count, seeded.prefix_length_py(r.sample_id, r.couplet_count)
        assert r.provided_couplet_count == k and "البداية:\n" + "\n".join(lines(k)) + "\n\n" in r.instruction
        assert drafts(r.response) == lines(n)[k:] and r.response.endswith("\n\n" + "\n".join(lines(n)))


def test_a_broken_chunk_fails_its_poem_only(poems):
    class Stubborn(G.OfflineBackend):
        """Never gets the chunk at couplet 4 right; its judge must see source and candidate, its repairs what is wrong."""

        def chat(self, messages, seed):
            if messages[0]["content"].startswith(K.JUDGE):
                assert "<source>\n{" in messages[1]["content"] and "<candidate>\n{" in messages[1]["content"] and "rhyme_check" not in messages[1]["content"]
                return '{"passed":true,"errors":[]}'
            ask, repaired = K.request_in(messages)
            assert not repaired or messages[-1]["content"].startswith("أصلح:\n- ")
            return "nothing" if ask.get("start") == 4 else json.dumps(self.answer(ask), ensure_ascii=False)

    got = {r.n: r for r in G.generate(poems, "poem-generation", Stubborn()).join(poems.select("sample_id", F.col("couplet_count").alias("n")), "sample_id").collect()}
    assert [got[n].error for n in (1, 3)] == [None, None]
    assert all(got[n].value is None and got[n].error == "reasoning chunk 4 remained invalid after repairs: no JSON object" for n in (5, 8))


def test_instruction_rules_in_python_are_those_of_the_column(spark):
    heads, verse = "\n".join(C.HEADINGS), "بيت طويل بما يكفي للنقل"
    texts = [f"{heads}\n2 الرجز " + "x" * 200, heads, "قبل " + heads + " 2 الرجز", "\n".join(reversed(C.HEADINGS)) + "2", f"{heads} 2 الرجز {verse} " + "x" * 200, "قصير", ""]
    df = spark.createDataFrame([(t, "الرجز", 2, [f" {verse} ", "قصير", None]) for t in texts], "t string, m string, n int, v array<string>")
    got = df.select("t", C.instruction_errors(F.col("t"), F.col("m"), F.col("n"), F.col("v"), 200).alias("e")).collect()
    for r in got:
        assert C.instruction_errors_py(r.t, "الرجز", 2, [f" {verse} ", "قصير", None], 200) == r.e
    with pytest.raises(C.Broken, match="out of order"):
        G._accept_instruction({"instruction": texts[3] + " الرجز " + "x" * 200}, {"meter": "الرجز", "n": 2, "verses": []})


def test_demonstrations_keep_their_contracts():
    backend = G.OfflineBackend()
    for t in (*G.TASKS.values(), G._REASONING, G._ANALYSIS):
        shot = {"kind": t.name} | K.EXAMPLES[t.name]
        assert t.accept(backend.answer(shot), shot | {"verses": []})


def test_judge_and_repair():
    """A rejected answer is asked for again with the judge's words; a judge that gives no verdict fails the item."""
    seen = []

    class Strict(G.OfflineBackend):
        def chat(self, messages, seed):
            seen.append(messages)
            if messages[0]["content"].startswith(K.JUDGE):
                return self.verdicts.pop(0)
            return json.dumps(self.answer(K.request_in(messages)[0]), ensure_ascii=False)

    ask = json.dumps({"kind": "mcq"} | K.EXAMPLES["mcq"], ensure_ascii=False)
    b = Strict()
    b.verdicts = ["?", '{"passed":false,"errors":["too easy"]}', '{"passed":true,"errors":[]}']
    got = G.attempt(G.TASKS["mcq"], "w", ask, b)
    assert got["attempts"] == 2 and got["error"] is None and "- too easy" in seen[3][-1]["content"] and len(seen) == 5
    b.verdicts = ['{"passed":true,"errors":["x"]}'] * 9
    got = G.attempt(G.TASKS["mcq"], "w", ask, b)
    assert got["error"] == "remained invalid after repairs: validation response was invalid after 3 attempts"


@pytest.mark.parametrize("name", ["mcq", "poem-generation"])
def test_a_log_answers_what_it_holds(spark, poems, tmp_path, name):
    """The second run asks nothing; other settings ask again; what failed is asked again."""
    log = G.Log(spark, str(tmp_path / "log"))

    class Silent:
        def chat(self, messages, seed):
            raise AssertionError("asked again")

    first = sorted(map(tuple, G.generate(poems, name, log=log).collect()), key=str)
    again = sorted(map(tuple, G.generate(poems.filter("couplet_count > 0"), name, Silent(), log).collect()), key=str)
    assert again == [x for x in first if x[1] != "00" * 32] and again
    with pytest.raises(Exception, match="asked again"):
        G.generate(poems, name, Silent(), log, {"temperature": 0.5}).collect()


def test_oversized_poems_are_asked_about_by_notes(poems):
    rows = G.generate(poems, "poem-generation", settings={"max_source_chars": 150, "chunk_chars": 80})
    assert {r.error for r in rows.collect()} <= {None, "no couplet to reason about"}
    with pytest.raises(Exception, match="poem is too long"):
        G.oversized(poems, 150).collect()


def test_tasks_say_what_their_answers_depend_on():
    t = G.task("mcq")
    assert t.fingerprint({"temperature": 1, "min_chars": 5}) == t.fingerprint({"temperature": 1, "min_chars": 6}) != t.fingerprint({"temperature": 2})
    assert G.task("poem-completion").fingerprint({"prefix_policy": 1}) != G.task("poem-completion").fingerprint({"prefix_policy": 2})
    assert t.trace()["task_type"] == "mcq" and all(t.estimate and sum(n for _, n in t.fixtures) == 80 for t in G.TASKS.values())
