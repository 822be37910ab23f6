"""Work items through a text-generation backend: ask, check the contract, ask a judge, repair, give up after a limit.

The loop runs inside one Arrow-batched function per work item, cheap checks before the judge, so a row never crosses the
cluster between attempts. The two poem-writing tasks have a second stage: a row for every three couplets goes through the
same loop, and one shuffle brings the chunks of a poem together. Stages keep a log if one is given (Log). The backend is any object with chat(messages, seed) -> str; the default is a deterministic
offline one whose faults are chosen by hash, so every branch of the loop is exercised and reruns agree.

A failed item is a row with its error, never a failed task; only an outage of the backend (Outage) fails the job.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.functions import seeded
from qafila.functions import text as X
from qafila.operators import contracts as C
from qafila.operators import conversations as K
from qafila.operators import render as R
from qafila.operators.selection import couplet_chunks, packed_chunks, with_prompt, work_items
from qafila.runtime import cut

#: Fewest characters of an instruction, as its prompt asks.
MIN_INSTRUCTION = 200


class Backend(Protocol):
    def chat(self, messages: list[dict], seed: int) -> str: ...


class Outage(RuntimeError):
    """No endpoint can be reached."""


def _pick(*parts: object, n: int) -> int:
    return int(hashlib.sha256(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) % n


class OfflineBackend:
    """Answers built from the request. By hash of the seed about one first answer in five breaks its contract, one in nine
    is rejected by the judge, and one verdict in six is malformed at first; a repaired answer keeps its contract."""

    def __init__(self, fault_of: int = 5, reject_of: int = 9, garble_of: int = 6) -> None:
        self.fault_of, self.reject_of, self.garble_of = fault_of, reject_of, garble_of

    def chat(self, messages: list[dict], seed: int) -> str:
        if messages[0]["content"].startswith(K.JUDGE):
            return self._judge(seed)
        ask, repaired = K.request_in(messages)
        if not repaired and _pick(seed, "fault", n=self.fault_of) == 0:
            return "```json\n{\"oops\": true}\n```"
        return K.as_json(self.answer(ask))

    def answer(self, ask: dict) -> dict:
        return getattr(self, "_" + ask["kind"].replace("-", "_"))(ask)

    def _judge(self, seed: int) -> str:
        seed, turn = seed - JUDGE_SEED, 0
        if seed >= JUDGE_TURN:
            seed, turn = seed - JUDGE_TURN, 1
        if not turn and _pick(seed, "garble", n=self.garble_of) == 0:
            return "not a verdict"
        if _pick(seed, "reject", n=self.reject_of) == 0:
            return '{"passed":false,"errors":["weak"]}'
        return '{"passed":true,"errors":[]}'

    def _chunk_analysis(self, ask: dict) -> dict:
        return {"note": f"قطعة من {len(ask['chunk'])} حرفا"}

    def _mcq(self, ask: dict) -> dict:
        wrong = [f"{ask['truth']} {w}" for w in ("آخر", "ثان", "ثالث")]
        detail = "تقييم مفصل للجواب بحسب ما في النص كله"
        return {
            "question": ask["question"], "correct_answer": ask["truth"], "distractors": wrong,
            "reasoning": {"approach": "ننظر في النص ثم في كل جواب", "evidence": [ask["poem"].split("\n")[0]], "conclusion": "والجواب هو ما وافق السجل المذكور",
                          "answer_assessments": [{"answer": a, "assessment": detail} for a in (ask["truth"], *wrong)]},
        }

    def _poem_reconstruction(self, ask: dict) -> dict:
        lines, repairs = ask["poem"].split("\n"), []
        for i in range(ask["count"]):
            words = lines[i].split()
            repairs.append({"couplet_index": i + 1, "corrupted_fragment": "خلل" + words[0], "corrected_fragment": words[0], "diagnosis": "لفظ لا يلائم ما بعده من الكلام",
                            "context_evidence": "السياق يدل على لفظ غير هذا اللفظ", "repair_reason": "رد اللفظ إلى ما يستقيم به البيت"})
            lines[i] = " ".join(["خلل" + words[0], *words[1:]])
        return {"corrupted_poem": "\n".join(lines), "repairs": repairs}

    def _poem_generation(self, ask: dict) -> dict:
        return {"instruction": "\n".join([*C.HEADINGS, f"{ask['n']} {ask['meter']}", "تفصيل " * 20])}

    _poem_completion = _poem_generation

    def _reasoning_chunk(self, ask: dict) -> dict:
        head = {"overview": "نظرة في النص كله قبل النظر في أبياته"} if ask["overview"] else {}
        return head | {"verse_reasoning": [self._block(ask["start"] + i, c) for i, c in enumerate(ask["couplets"])]}

    def _block(self, number: int, couplet: str) -> dict:
        word = max(sorted(C.words_of(couplet)), key=len, default="")
        return {
            "verse_index": number, "intended_meaning": "معنى يلائم موضع البيت من النص كله", "connection_to_previous": "صلة ظاهرة بما سبق من الكلام وبما يلحقه",
            "imagery_and_diction": "صورة قريبة وألفاظ سهلة تلائم المقام", "first_draft": f"{word} في صدر = {word} في عجز", "problem_with_first_draft": f"تكرار {word} في الشطرين يضعف البيت",
            "revised_draft": couplet, "first_hemistich_scansion": "الصدر مستقيم على النمط المطلوب", "second_hemistich_scansion": "العجز مستقيم على النمط المطلوب", "rhyme_check": "القافية موافقة لسائر أبيات النص",
        }


@dataclass(frozen=True)
class Task:
    """A workflow: which rows it takes, what it asks, what it accepts, what is known of it. Extend by adding one to TASKS."""

    name: str
    items: Callable[[DataFrame], DataFrame]  # work_id, sample_id, ask (JSON)
    accept: Callable[[dict, dict], object]
    max_repairs: int = 2
    chunked: bool = False  # whether reasoning over the couplets follows
    judged: bool = True
    estimate: str | None = None  # the column of selection.estimate that counts its requests
    stages: tuple[str, ...] = ("sample",)  # what its log may hold
    settings: tuple[str, ...] = ("temperature", "top_p", "max_tokens", "max_source_chars")  # what a fingerprint covers
    metadata: tuple[str, ...] = ("poet_name", "meter_name")  # columns its records carry
    unit: str = "poem"  # what a pilot and a benchmark count
    fixtures: tuple[tuple[str, int], ...] = (("request", 40), ("validation", 40))  # the request mix of a benchmark

    def contract(self, settings: dict) -> dict:
        """The settings of a run that this task's answers depend on."""
        return {"task_type": self.name} | {k: settings.get(k) for k in self.settings}

    def fingerprint(self, settings: dict) -> str:
        return hashlib.sha256(json.dumps(self.contract(settings), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def trace(self) -> dict:
        """What a run says of the task when it begins."""
        return {"task_type": self.name, "stages": list(self.stages), "max_repairs": self.max_repairs, "settings": list(self.settings), "unit": self.unit}


def _ask(kind: str, **columns) -> F.Column:
    return F.to_json(F.struct(F.lit(kind).alias("kind"), *(c.alias(k) for k, c in columns.items())))


def _poem_items(kind: str):
    def items(poems: DataFrame) -> DataFrame:
        """With the columns the chunk stage needs; `provided` counts the couplets given away at the beginning."""
        if kind == "poem-completion":
            poems = poems.filter("couplet_count >= 2")
            provided = seeded.prefix_length("sample_id", "couplet_count")
        else:
            provided = F.lit(0)
        ask = _ask(kind, poem=F.col("poem_text"), meter=F.col("meter_name"), n=F.col("couplet_count"))
        return poems.select(F.concat(F.lit(kind + ":"), "sample_id").alias("work_id"), "sample_id", ask.alias("ask"), "meter_name", "poem_text", "verses", provided.alias("provided"))

    return items


def _mcq_items(poems: DataFrame) -> DataFrame:
    rows = with_prompt(work_items(poems)).join(poems.select("sample_id", "poem_text"), "sample_id")
    ask = _ask("mcq", poem=F.col("poem_text"), truth=F.col("ground_truth"), question=F.concat(F.lit("ما المسجل لهذا النص؟ صيغة "), F.col("prompt_no").cast("string")))
    return rows.select("work_id", "sample_id", ask.alias("ask"))


def _reconstruction_items(poems: DataFrame) -> DataFrame:
    count = X.corruption_count(F.col("sample_id"), F.col("couplet_count"))
    rows = poems.filter("couplet_count > 0")
    return rows.select(F.concat(F.lit("poem-reconstruction:"), "sample_id").alias("work_id"), "sample_id", _ask("poem-reconstruction", poem=F.col("poem_text"), count=count).alias("ask"))


def _accept_instruction(value: dict, ask: dict) -> dict:
    text = C.instruction_of(value)
    errors = C.instruction_errors_py(text, ask.get("meter"), ask["n"], ask["verses"], MIN_INSTRUCTION)
    C.need(not errors, "; ".join(errors))
    return {"instruction": text}


def _accept_chunk(value: dict, ask: dict) -> dict:
    overview, blocks = C.reasoning_chunk(value, ask["start"], ask["couplets"], ask["overview"])
    return {"overview": overview, "verse_reasoning": blocks}


def _accept_note(value: dict, ask: dict) -> dict:
    C.need(value.keys() == {"note"} and isinstance(value["note"], str) and bool(value["note"].strip()), "not only a note")
    return {"note": value["note"].strip()}


_WRITING = {"chunked": True, "stages": ("instruction", "reasoning_chunk", "sample"), "fixtures": (("instruction", 8), ("instruction_validation", 8), ("reasoning", 32), ("reasoning_validation", 32))}
_WRITES = ("temperature", "top_p", "max_tokens", "min_chars", "max_source_chars")
TASKS: dict[str, Task] = {
    t.name: t
    for t in (
        Task("poem-generation", _poem_items("poem-generation"), _accept_instruction, estimate="generation", settings=(*_WRITES, "chunk_chars"), **_WRITING),
        Task("poem-completion", _poem_items("poem-completion"), _accept_instruction, estimate="completion", settings=(*_WRITES, "prefix_policy"), **_WRITING),
        Task("mcq", _mcq_items, lambda v, a: C.question_candidate(v, a["question"], a["truth"]), estimate="mcq", unit="question"),
        Task("poem-reconstruction", _reconstruction_items, lambda v, a: C.reconstruction_candidate(v, a["poem"].split("\n"), a["count"]), estimate="reconstruction"),
    )
}


def task(name: str) -> Task:
    if name not in TASKS:
        raise ValueError(f"unknown task {name}")
    return TASKS[name]


#: Seeds of the judge lie above those of the answers, of a verdict asked for again above those.
JUDGE_SEED, JUDGE_TURN, VERDICTS = 1 << 40, 1 << 41, 3
_DEMONSTRATED = OfflineBackend()


def verdict(ask: dict, candidate: object, backend: Backend, seed: int, told: str | None = None) -> list[str]:
    """What the judge holds against a candidate, given source and candidate; asked again while its answer is no verdict."""
    messages = K.judging(ask, candidate, told)
    for turn in range(VERDICTS):
        try:
            said = C.object_of(backend.chat(messages, seed + JUDGE_SEED + (JUDGE_TURN if turn else 0)))
        except C.Broken:
            continue
        errors = said.get("errors")
        listed = isinstance(errors, list) and all(isinstance(e, str) and e.strip() for e in errors)
        if said.keys() == {"passed", "errors"} and isinstance(said["passed"], bool) and listed and said["passed"] == (not errors):
            return errors
    raise C.Broken(f"validation response was invalid after {VERDICTS} attempts")


def attempt(t: Task, work_id: str, ask: str, backend: Backend, **known) -> dict:
    """One work item to the end: the accepted value or the last error, and how many answers it took.

    Every answer is held against the contract first and shown to the judge only if it keeps it. What is wrong goes back
    with the refused answer. What is known of the item besides its request goes to the contract, not to the backend.
    """
    request, seed = json.loads(ask), int(hashlib.sha256(work_id.encode()).hexdigest()[:8], 16)
    messages = base = K.asking(request, _DEMONSTRATED.answer, ask)
    error = None
    for k in range(t.max_repairs + 1):
        raw = backend.chat(messages, seed + k)
        try:
            value = t.accept(C.object_of(raw), request | known)
            errors = verdict(request, value, backend, seed + k, ask) if t.judged else []
            if not errors:
                return {"value": K.as_json(value), "error": None, "attempts": k + 1}
            error = "judge rejected: " + "; ".join(errors)
        except C.Broken as e:
            errors = [error := str(e)]
        messages = K.repairing(base, raw, errors)
    return {"value": None, "error": f"remained invalid after repairs: {error}", "attempts": t.max_repairs + 1}


class Log:
    """What earlier runs accepted: key, fingerprint, value, attempts, error, at. Runs append to it stage by stage, so one
    that is broken off is taken up where it stopped; an answer counts only under the fingerprint it was given for."""

    DDL = "key string, fingerprint string, value string, attempts int, error string, at timestamp"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.DDL).parquet(self.path)
        except Exception as e:  # no run yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.DDL)

    def accepted(self) -> DataFrame:
        """Of each key and fingerprint the last answer that was accepted."""
        last = self.read().filter("error is null").groupBy("key", "fingerprint").agg(F.max_by(F.struct("value", "attempts"), "at").alias("x"))
        return last.select("key", "fingerprint", F.col("x.value").alias("had"), F.col("x.attempts").alias("had_attempts"))

    def append(self, made: DataFrame) -> None:
        made.select("key", "fingerprint", "value", "attempts", "error", F.current_timestamp().alias("at")).write.mode("append").parquet(self.path)


def _stage(t: Task, rows: DataFrame, backend: Backend, keep: list[str], known: tuple[str, ...] = (), log: Log | None = None, contract: str = "") -> DataFrame:
    """The kept columns with value, error and attempts of each row's request (column key seeds it); no request, no attempt.

    With a log, requests it holds an accepted answer for are not asked again, and what is new is added to it.
    """
    made = [T.StructField("value", T.StringType()), T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())]
    had = ("had", "had_attempts") if log else ()
    if log:
        rows = rows.withColumn("fingerprint", F.sha2(F.concat_ws("|", F.lit(contract), "ask"), 256)).join(log.accepted(), ["key", "fingerprint"], "left")
        keep = [*keep, *(c for c in ("key", "fingerprint") if c not in keep), "had"]

    def one(key: str, ask: str | None, value: str | None, attempts, *more) -> dict:
        if ask is None:
            return {"value": None, "error": None, "attempts": 0}
        if isinstance(value, str):
            return {"value": value, "error": None, "attempts": int(attempts)}
        return attempt(t, key, ask, backend, **dict(zip(known, more, strict=True)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prior = [batch[c] for c in had] or [[None] * len(batch)] * 2
            done = [one(*row) for row in zip(batch["key"], batch["ask"], *prior, *(batch[c] for c in known), strict=True)]
            yield pd.DataFrame({**{c: batch[c] for c in keep}, **{f.name: [x[f.name] for x in done] for f in made}})

    out = rows.mapInPandas(run, T.StructType([rows.schema[c] for c in keep] + made))
    if log:  # written once, so that nothing is asked twice
        out = cut(out)
        log.append(out.filter("had is null and attempts > 0"))
        out = out.drop("had", "fingerprint")
    return out


_REASONING = Task("reasoning-chunk", lambda rows: rows, _accept_chunk)
_ANALYSIS = Task("chunk-analysis", lambda rows: rows, _accept_note, judged=False)
_CHUNK = "overview string, verse_reasoning array<struct<verse_index:int," + ",".join(f"{f}:string" for f in C.BLOCK_FIELDS[1:]) + ">>"


def _summarised(rows: DataFrame, backend: Backend, most: int, chunk_chars: int, log: Log | None, contract: str) -> DataFrame:
    """rows with the request of each oversized poem about the notes of its chunks, in order, instead of its text."""
    big = rows.filter(F.length("poem_text") > most).select("work_id", F.posexplode(packed_chunks(X.couplets(F.col("verses")), chunk_chars)).alias("at", "chunk"))
    asks = big.select("work_id", "at", F.concat_ws(":", "work_id", F.lit("note"), F.col("at").cast("string")).alias("key"), _ask("chunk-analysis", chunk=F.col("chunk")).alias("ask"))
    noted = _stage(_ANALYSIS, asks, backend, ["work_id", "at"], log=log, contract=contract)
    noted = noted.groupBy("work_id").agg(F.array_sort(F.collect_list(F.struct("at", F.from_json("value", "note string")["note"].alias("note")))).alias("x"))
    notes = noted.select("work_id", F.array_join(F.transform("x", lambda e: e["note"]), "\n").alias("summary"))
    ask = F.from_json("ask", "kind string, poem string, meter string, n int").withField("poem", F.col("summary"))
    return rows.join(notes, "work_id", "left").withColumn("ask", F.when(F.col("summary").isNotNull(), F.to_json(ask)).otherwise(F.col("ask"))).drop("summary")


def _written(made: DataFrame, backend: Backend, log: Log | None = None, contract: str = "", augment: Callable[[Column, Column, Column], Column] = R.completion_instruction_of) -> DataFrame:
    """Reasoning over every couplet after the provided ones, three at a time, then the response: reasoning and exact poem.

    A poem whose instruction failed goes through as one row without a request. What is the same for all chunks of a poem
    travels with its first one. augment(instruction, lines, provided) is what is said of the couplets given away.
    """
    lines, provided = F.col("lines"), F.col("provided")
    text = F.from_json("value", "instruction string")["instruction"]
    told = made.withColumn("lines", X.couplets(F.col("verses"))).withColumn("text", text)
    told = told.withColumn("instruction", F.when(provided > 0, augment(F.col("text"), lines, provided)).otherwise(F.col("text")))
    c = F.col("c")
    start, first = F.coalesce(c["start"], F.lit(-1)), F.coalesce(c["first"], F.lit(True))
    ask = _ask("reasoning-chunk", instruction=F.col("instruction"), meter=F.col("meter_name"), n=F.size(lines), start=c["start"] + 1, couplets=c["couplets"], before=c["before"], after=c["after"], overview=c["first"])
    once = lambda name: F.when(first, F.col(name)).alias(name)
    rows = told.withColumn("c", F.explode_outer(F.when(F.col("error").isNull(), couplet_chunks(lines, provided))))
    rows = rows.select(
        "work_id", "sample_id", F.concat_ws(":", "work_id", start.cast("string")).alias("key"), start.alias("start"), F.when(c.isNotNull(), ask).alias("ask"), "provided", F.size(lines).alias("n"),
        F.col("attempts").alias("told_attempts"), F.col("error").alias("told_error"), once("instruction"), once("meter_name"), once("poem_text"),
    )
    same = ["work_id", "provided", "n", "told_attempts", "told_error", "instruction", "meter_name", "poem_text"]
    done = _stage(_REASONING, rows, backend, ["sample_id", "start", *same], log=log, contract=contract).withColumn("v", F.from_json("value", _CHUNK))
    x = F.array_sort(F.collect_list(F.struct("start", "error", "attempts", "v.overview", "v.verse_reasoning", *same)))
    whole = done.groupBy("sample_id").agg(x.alias("x")).withColumn("h", F.get("x", F.lit(0)))
    h = F.col("h")
    whole = whole.withColumn("blocks", F.flatten(F.transform("x", lambda e: F.coalesce(e["verse_reasoning"], F.array()))))
    broken = F.filter(F.transform("x", lambda e: F.concat(F.lit("reasoning chunk "), (e["start"] + 1).cast("string"), F.lit(" "), e["error"])), lambda e: e.isNotNull())
    wanted = F.when(h["n"] > h["provided"], F.sequence(h["provided"] + 1, h["n"]))
    error = F.coalesce(
        h["told_error"],
        F.when(h["start"] < 0, F.lit("no couplet to reason about")),
        F.get(broken, F.lit(0)),
        F.when(F.transform("blocks", lambda b: b["verse_index"]) != wanted, F.lit("reasoning does not cover every couplet once")),
    )
    reasoning = R.render_reasoning(h["overview"], F.col("blocks"), R.is_prose(h["meter_name"]))
    whole = whole.withColumn("error", error).withColumn("reasoning", F.when(F.col("error").isNull(), reasoning))
    return whole.select(
        h["work_id"].alias("work_id"), "sample_id", R.compose_response(F.col("reasoning"), h["poem_text"]).alias("value"), "error",
        (h["told_attempts"] + F.aggregate("x", F.lit(0), lambda n, e: n + e["attempts"])).alias("attempts"),
        (1 + F.when(h["start"] < 0, 0).otherwise(F.size("x"))).alias("stages"), h["instruction"].alias("instruction"), h["provided"].alias("provided"),
    )


def generate(poems: DataFrame, name: str, backend: Backend | None = None, log: Log | None = None, settings: dict | None = None, augment=R.completion_instruction_of) -> DataFrame:
    """work_id, sample_id, value, error, attempts of every work item of a task, and of how many stages.

    Poem-writing tasks also give the accepted instruction and how many couplets it gives away; their value is the response.
    settings: of the run; max_source_chars and chunk_chars say from what length on a poem is asked about by the notes of
    its chunks. With a log nothing is asked that it answers under the same fingerprint.
    """
    t, backend, settings = task(name), backend or OfflineBackend(), settings or {}
    contract = t.fingerprint(settings)
    rows = t.items(poems).withColumn("key", F.col("work_id"))
    if t.chunked:
        if settings.get("max_source_chars") and t.name == "poem-generation":
            rows = _summarised(rows, backend, settings["max_source_chars"], settings["chunk_chars"], log, contract)
        told = _stage(t, rows, backend, ["work_id", "sample_id", "meter_name", "poem_text", "verses", "provided"], known=("verses",), log=log, contract=contract)
        return _written(told, backend, log, contract, augment)
    made = _stage(t, rows, backend, ["work_id", "sample_id"], log=log, contract=contract).select("work_id", "sample_id", "value", "error", "attempts")
    return made.withColumns({"stages": F.lit(1), "instruction": F.lit(None).cast("string"), "provided": F.lit(None).cast("int")})


def oversized(poems: DataFrame, max_source_chars: int) -> DataFrame:
    """The poems; one longer than allowed raises when the plan runs. For tasks that cannot work on notes."""
    message = F.concat(F.lit("poem is too long: "), F.col("sample_id"))
    return poems.filter(F.when(F.length("poem_text") > max_source_chars, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def records_of(made: DataFrame, poems: DataFrame, name: str, metadata: tuple[str, ...] = ()) -> DataFrame:
    """Trainer-facing rows of the outcomes that succeeded, with their place in the order of work; more columns of the poems
    may be asked for as metadata."""
    order = F.col("first_row") if "first_row" in poems.columns else F.col("record_no") if "record_no" in poems.columns else F.lit(None)
    more = [c for c in metadata if c not in ("poet_name", "meter_name", "couplet_count", "sample_id")]
    about = poems.select("sample_id", "poet_name", "meter_name", "couplet_count", order.cast("bigint").alias("work_order"), *more)
    status = F.when(F.col("attempts") > F.col("stages"), "passed_after_repair").otherwise("passed")
    return made.filter("error is null").join(about, "sample_id").select(
        "sample_id", F.col("work_id").alias("record_id"), F.lit(name).alias("task_type"), "poet_name", "meter_name", "couplet_count", F.col("provided").alias("provided_couplet_count"), "instruction",
        F.col("value").alias("response"), X.sft_split(F.col("sample_id")).alias("sft_split"), F.col("attempts").alias("generation_attempts"), status.alias("validation_status"), "work_order", *more,
    )


def sft_records(poems: DataFrame, name: str, backend: Backend | None = None, log: Log | None = None, settings: dict | None = None) -> DataFrame:
    """Trainer-facing rows of the items that succeeded."""
    return records_of(generate(poems, name, backend, log, settings), poems, name, task(name).metadata)


def mcq_choices(poems: DataFrame, backend: Backend | None = None) -> DataFrame:
    """work_id with the four choices in seeded order."""
    made = generate(poems, "mcq", backend).filter("error is null")
    parsed = F.from_json("value", "correct_answer string, distractors array<string>")
    rows = made.select("work_id", F.concat(F.array(parsed["correct_answer"]), parsed["distractors"]).alias("answers"))
    return rows.withColumn("choices", seeded.choice_order("work_id", "answers"))
