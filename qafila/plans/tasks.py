"""Prompts, contracts and the four task workflows over poem_records, with the offline backend."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from qafila.functions import seeded
from qafila.functions import text as X
from qafila.operators import contracts as C
from qafila.operators import generation as G
from qafila.operators import outputs as O
from qafila.operators import render as R
from qafila.operators.selection import couplet_chunks
from qafila.plans.selection import ITEMS, P, poems
from qafila.runtime import cut


def message_arrays(spark, d):
    """The instruction conversation of every poem, flattened to one row per message."""
    rows = poems(spark, d).select("sample_id", R.instruction_messages(F.lit("sound"), F.col("meter_name"), F.col("couplet_count"), F.col("poem_text"), 200).alias("m"))
    return rows.select("sample_id", F.posexplode("m").alias("n", "x")).select("sample_id", "n", "x.role", F.sha2("x.content", 256).alias("digest"))


def template_choice(spark, d):
    return poems(spark, d).select("sample_id", R.template_of(F.col("sample_id")).alias("template_id"))


def reasoning_prompts(spark, d):
    """The prompt of every three-couplet chunk of every poem, with its neighbours; all but the first continue."""
    p = poems(spark, d).select("sample_id", F.explode(couplet_chunks(X.couplets(F.col("verses")), F.lit(0))).alias("c"))
    c = F.col("c")
    m = R.reasoning_messages(F.lit("نظرة"), c["before"], F.array_join(c["couplets"], "\n"), c["after"], c["first"])
    return p.select("sample_id", c["start"].alias("start"), F.size(m).alias("messages"), F.sha2(m[3]["content"], 256).alias("digest"))


def repair_prompts(spark, d):
    base = R.judge_messages(F.col("poem_text"), F.lit("{}"))
    m = R.repair_messages(base, F.lit("raw"), F.array(F.lit("one"), F.col("meter_name")))
    return poems(spark, d).select("sample_id", F.size(m).alias("messages"), F.sha2(F.array_join(F.transform(m, lambda x: x["content"]), "|"), 256).alias("digest"))


def _block(i, text):
    fields = [x for x in C.BLOCK_FIELDS if x != "verse_index"]
    return F.struct(i.alias("verse_index"), *(F.concat(F.lit(f + " "), text).alias(f) for f in fields))


def reasoning_render(spark, d):
    """A block for every couplet."""
    blocks = F.transform(X.couplets(F.col("verses")), lambda x, i: _block(i + 1, x))
    return poems(spark, d).select("sample_id", F.sha2(R.render_reasoning(F.lit(" نظرة "), blocks, R.is_prose(F.col("meter_name"))), 256).alias("digest"))


def response_render(spark, d):
    reasoning = F.concat(F.lit("\n"), F.col("poem_text"), F.lit("\nكلام  \n\n\n\nالقصيدة:\nبعد\nالنتيجة النهائية:\nزائد"))
    return poems(spark, d).select("sample_id", F.sha2(R.compose_response(reasoning, F.col("poem_text")), 256).alias("digest"))


def completion_render(spark, d):
    """The instruction with the seeded number of couplets as its beginning."""
    p = poems(spark, d).filter("couplet_count >= 2").withColumn("k", seeded.prefix_length("sample_id", "couplet_count"))
    beginning = F.array_join(F.slice(X.couplets(F.col("verses")), F.lit(1), F.col("k")), "\n")
    return p.select("sample_id", "k", F.sha2(R.completion_instruction(F.lit("اكتب \n"), beginning, F.col("couplet_count"), F.col("k")), 256).alias("digest"))


def mcq_render(spark, d):
    labels = F.array(*(F.struct(F.lit(x).alias("label"), F.concat(F.col("meter_name"), F.lit(f" {i}")).alias("text"), F.lit(i == 2).alias("correct")) for i, x in enumerate("أبجد")))
    notes = F.map_from_entries(F.transform(labels, lambda c: F.struct(c["text"], F.concat(F.lit("تقييم "), c["text"]))))
    q = R.question_text(F.col("poem_text"), F.lit("ما الوزن؟"), labels)
    a = R.answer_text(F.lit("ننظر"), F.array(F.lit("شاهد")), labels, notes, F.lit("خلاصة"))
    return poems(spark, d).select("sample_id", F.sha2(q, 256).alias("question"), F.sha2(a, 256).alias("answer"))


def reconstruction_render(spark, d):
    repair = F.struct(F.lit(1).alias("couplet_index"), F.lit("خ").alias("corrupted_fragment"), F.col("meter_name").alias("corrected_fragment"), F.lit("ت").alias("diagnosis"), F.lit("س").alias("context_evidence"), F.lit("ر").alias("repair_reason"))
    return poems(spark, d).select("sample_id", F.sha2(R.repairs_text(F.array(repair), F.col("poem_text")), 256).alias("digest"))


def instruction_contract(spark, d):
    """Instructions with planted faults by couplet count: every broken rule is counted."""
    p = poems(spark, d).withColumn("k", F.col("couplet_count") % 4)
    heads = F.lit("\n".join(C.HEADINGS))
    text = (
        F.when(F.col("k") == 0, F.concat(heads, F.lit("\n"), F.col("couplet_count").cast("string"), F.lit(" "), F.col("meter_name"), F.lit(" " + "x" * 200)))
        .when(F.col("k") == 1, F.concat(F.lit("قبل "), heads, F.lit("\n"), F.col("meter_name")))
        .when(F.col("k") == 2, F.concat(F.lit("\n".join(reversed(C.HEADINGS))), F.col("couplet_count").cast("string"), F.get("verses", F.lit(0))))
        .otherwise(F.lit("قصير"))
    )
    errors = C.instruction_errors(text, F.col("meter_name"), F.col("couplet_count"), F.col("verses"), 150)
    return p.select("sample_id", F.size(errors).cast("bigint").alias("n_errors"))


def invalid_responses(spark, d):
    """Responses of three kinds against the strict contract of a question: what is wrong, and how often."""
    raw = F.element_at(F.array(F.lit('{"question":"x"}'), F.lit("no json"), F.lit('{"question":1,"correct_answer":"","distractors":[],"reasoning":{}}')), F.col("couplet_count") % 3 + 1)
    check = C.checked(C.question_candidate)
    rows = poems(spark, d).select(check(raw, F.lit("سؤال طويل بما يكفي"), F.lit("جواب")).alias("r"))
    return rows.groupBy("r.ok", "r.error").agg(F.count("*").alias("n"))


def task_outcomes(spark, d, name):
    return G.generate(poems(spark, d), name).groupBy("attempts", "error").agg(F.count("*").alias("n"))


def sft_records(spark, d):
    p, out = cut(poems(spark, d)), None
    for name in G.TASKS:
        rows = G.sft_records(p, name)
        out = rows if out is None else out.unionByName(rows)
    return out.select("record_id", "sample_id", "task_type", "sft_split", "generation_attempts", "validation_status", F.sha2("response", 256).alias("digest"))


def generation_records(spark, d):
    """The records of the three tasks whose outcome SQL can follow: who passed, how, and the poem a response ends with."""
    p, out = cut(poems(spark, d)), None
    for name in ("poem-generation", "mcq", "poem-reconstruction"):
        tail = F.sha2(F.substring_index("response", f"{R.RESULT}\n\n", -1), 256) if G.task(name).chunked else F.lit(None).cast("string")
        rows = G.sft_records(p, name).select("record_id", "sample_id", "task_type", "work_order", "sft_split", "generation_attempts", "validation_status", tail.alias("poem"))
        out = rows if out is None else out.unionByName(rows)
    return out


def run_counters(spark, d):
    """How often each value of each dimension occurs among the records of the same three tasks, and why others failed."""
    p, out = cut(poems(spark, d)), None
    for name in ("poem-generation", "mcq", "poem-reconstruction"):
        made = cut(G.generate(p, name))
        for rows in (O.with_dimensions(G.records_of(made, p, name)), O.failures_of(made)):
            c = O.counters(rows)
            out = c if out is None else out.unionByName(c)
    return out.groupBy("dim", "value").agg(F.sum("n").alias("n"))


def mcq_choices(spark, d):
    rows = G.mcq_choices(poems(spark, d))
    right = F.get(F.filter("choices", lambda c: c["correct"]), F.lit(0))
    return rows.select("work_id", right["label"].alias("label"), F.array_join(F.transform("choices", lambda c: F.concat(c["label"], F.lit(")"), c["text"])), " ").alias("rendered"))


QUERIES = {f.__name__: f for f in (
    message_arrays, template_choice, reasoning_prompts, repair_prompts, reasoning_render, response_render, completion_render, mcq_render, reconstruction_render,
    instruction_contract, invalid_responses, sft_records, generation_records, run_counters, mcq_choices,
)} | {f"outcomes_{n.replace('-', '_')}": partial(task_outcomes, name=n) for n in G.TASKS}


def _s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_FEET = "CASE meter_name " + " ".join(f"WHEN {_s(k)} THEN {_s(v)}" for k, v in R.FEET.items()) + " END"
_ASKING = f"{_s(R.TEMPLATES['sound'])} || chr(10) || 'البحر: ' || meter_name || chr(10) || 'عدد الأبيات: ' || couplet_count || chr(10) || 'الحد الأدنى: 200' || chr(10) || CASE WHEN meter_name = 'النثر' THEN 'النص نثر: انظر في الإيقاع الداخلي.' ELSE 'كل شطر على هذا النمط: ' || {_FEET} END || chr(10) || CASE WHEN meter_name = 'النثر' THEN 'خطة عملية لصناعة نص شعري منثور:' ELSE 'خطة عملية لصناعة بيت على بحر ' || meter_name || ':' END || chr(10) || poem_text"
_HIT = lambda x, what, n: f"(('0x' || substr(sha256(CAST({x} AS VARCHAR) || ':{what}'), 1, 8))::UBIGINT % {n} = 0)"
_REJECTED = "remained invalid after repairs: judge rejected: weak"


def _tried(rows: str, name: str) -> str:
    """CTEs: of rows with a key how many answers the offline backend needs, and whether the last one is refused too."""
    return f"""{name}_s AS (SELECT *, ('0x' || substr(sha256(key), 1, 8))::UBIGINT AS s FROM ({rows})),
      {name}_b AS (SELECT *, {_HIT("s", "fault", 5)} OR {_HIT("s", "reject", 9)} AS b0, {_HIT("s + 1", "reject", 9)} AS b1, {_HIT("s + 2", "reject", 9)} AS b2 FROM {name}_s),
      {name} AS (SELECT * EXCLUDE (s, b0, b1, b2), CASE WHEN NOT b0 THEN 1 WHEN NOT b1 THEN 2 ELSE 3 END AS attempts, b0 AND b1 AND b2 AS failed FROM {name}_b)"""


_SPLIT = "CASE WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 < 98 THEN 'train' WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 = 98 THEN 'validation' ELSE 'test' END"
_MCQ = _tried(f"SELECT 'mcq:' || sample_id || ':' || template_id AS key, sample_id, record_no FROM ({ITEMS.replace('SELECT sample_id,', 'SELECT sample_id, record_no,')}) WHERE ground_truth IS NOT NULL", "mcq")
_RECONSTRUCTION = _tried("SELECT 'poem-reconstruction:' || sample_id AS key, sample_id, record_no FROM p WHERE couplet_count > 0", "rec")
_GENERATION = f"""{_tried("SELECT 'poem-generation:' || sample_id AS key, * FROM p", "told")},
    {_tried("SELECT key || ':' || i AS key, key AS work, CAST(i AS INT) AS start FROM (SELECT key, unnest(range(0, len(lines), 3)) AS i FROM told WHERE NOT failed)", "chunk")},
    sums AS (SELECT work, sum(attempts) AS attempts, count(*) AS stages, min(start) FILTER (failed) AS broken FROM chunk GROUP BY 1),
    gen AS (SELECT told.key, sample_id, record_no, poem_text, CAST(told.attempts + coalesce(sums.attempts, 0) AS INT) AS attempts, 1 + coalesce(stages, 0) AS stages,
        CASE WHEN told.failed THEN '{_REJECTED}' WHEN len(lines) = 0 THEN 'no couplet to reason about' WHEN broken IS NOT NULL THEN 'reasoning chunk ' || (broken + 1) || ' {_REJECTED}' END AS error
      FROM told LEFT JOIN sums ON told.key = sums.work)"""
_LABELS = (("المعنى", "intended_meaning"), ("الصلة بما قبله", "connection_to_previous"), ("الصورة", "imagery_and_diction"), ("صياغة أولى", "first_draft"), ("قرار المراجعة", "problem_with_first_draft"), ("الصياغة المنقحة", "revised_draft"), ("الفحص الأول", "first_hemistich_scansion"), ("الفحص الثاني", "second_hemistich_scansion"), ("القافية", "rhyme_check"))
_BLOCKS = "array_to_string(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN meter_name = 'النثر' THEN 'الوحدة' ELSE 'البيت' END || ' ' || i || ':' || chr(10) || " + " || chr(10) || ".join(f"'{a}: {b} ' || lines[i]" for a, b in _LABELS) + "), chr(10) || chr(10))"
_CH = [f"'{x}) ' || meter_name || ' {i}'" for i, x in enumerate("أبجد")]

SQL = {
    "outcomes_mcq": f"WITH {P}, {_MCQ} SELECT attempts, CASE WHEN failed THEN '{_REJECTED}' END AS error, count(*) AS n FROM mcq GROUP BY 1, 2",
    "outcomes_poem_reconstruction": f"WITH {P}, {_RECONSTRUCTION} SELECT attempts, CASE WHEN failed THEN '{_REJECTED}' END AS error, count(*) AS n FROM rec GROUP BY 1, 2",
    "outcomes_poem_generation": f"WITH {P}, {_GENERATION} SELECT attempts, error, count(*) AS n FROM gen GROUP BY 1, 2",
    "generation_records": f"""WITH {P}, {_GENERATION}, {_MCQ}, {_RECONSTRUCTION},
      r AS (SELECT key, sample_id, record_no, 'poem-generation' AS t, attempts, stages, sha256(poem_text) AS poem FROM gen WHERE error IS NULL
        UNION ALL SELECT key, sample_id, record_no, 'mcq', attempts, 1, NULL FROM mcq WHERE NOT failed UNION ALL SELECT key, sample_id, record_no, 'poem-reconstruction', attempts, 1, NULL FROM rec WHERE NOT failed)
      SELECT key AS record_id, sample_id, t AS task_type, record_no AS work_order, {_SPLIT} AS sft_split, CAST(attempts AS INT) AS generation_attempts, CASE WHEN attempts > stages THEN 'passed_after_repair' ELSE 'passed' END AS validation_status, poem FROM r""",
    "run_counters": f"""WITH {P}, {_GENERATION}, {_MCQ}, {_RECONSTRUCTION},
      r AS (SELECT key, sample_id, 'poem-generation' AS t, attempts > stages AS again FROM gen WHERE error IS NULL UNION ALL SELECT key, sample_id, 'mcq', attempts > 1 FROM mcq WHERE NOT failed UNION ALL SELECT key, sample_id, 'poem-reconstruction', attempts > 1 FROM rec WHERE NOT failed),
      x AS (SELECT r.*, meter_name, couplet_count, CASE WHEN t = 'mcq' THEN split_part(key, ':', 3) END AS template FROM r JOIN p USING (sample_id)),
      lost AS (SELECT error FROM gen WHERE error IS NOT NULL UNION ALL SELECT '{_REJECTED}' FROM mcq WHERE failed UNION ALL SELECT '{_REJECTED}' FROM rec WHERE failed),
      m AS (SELECT 'task_type' AS dim, t AS value FROM x UNION ALL SELECT 'sft_split', {_SPLIT} FROM x UNION ALL SELECT 'template_id', template FROM x
        UNION ALL SELECT 'metadata_field', CASE template WHEN 'poem_meter' THEN 'meter_name' ELSE template END FROM x UNION ALL SELECT 'meter_name', meter_name FROM x
        UNION ALL SELECT 'corruption_count', CAST(('0x' || substr(sha256('reconstruction-count:' || sample_id), 1, 16))::UBIGINT % least(3, couplet_count) + 1 AS VARCHAR) FROM x WHERE t = 'poem-reconstruction'
        UNION ALL SELECT 'validation_status', CASE WHEN again THEN 'passed_after_repair' ELSE 'passed' END FROM x
        UNION ALL SELECT 'failure_category', CASE WHEN contains(error, 'rejected') THEN 'semantic_rejection' ELSE 'generation_error' END FROM lost)
      SELECT dim, value, count(*) AS n FROM m WHERE value IS NOT NULL GROUP BY 1, 2""",
    "invalid_responses": f"WITH {P} SELECT false AS ok, CASE couplet_count % 3 WHEN 0 THEN 'wrong keys' WHEN 1 THEN 'no JSON object' ELSE 'no question' END AS error, count(*) AS n FROM p GROUP BY 1, 2",
    "message_arrays": f"WITH {P}, m AS (SELECT sample_id, [{_s(R.SYSTEM)}, {', '.join(_s(x) for shot in R.SHOTS for x in shot)}, {_ASKING}] AS c FROM p) SELECT sample_id, CAST(n AS INT) AS n, (['system', 'user', 'assistant', 'user', 'assistant', 'user'])[n + 1] AS role, sha256(c[n + 1]) AS digest FROM (SELECT sample_id, c, unnest(range(0, 6)) AS n FROM m)",
    "template_choice": f"WITH {P} SELECT sample_id, ([{', '.join(_s(t) for t in R.TEMPLATES)}])[CAST(('0x' || substr(sha256('template:' || sample_id), 1, 8))::UBIGINT % {len(R.TEMPLATES)} AS BIGINT) + 1] AS template_id FROM p",
    "reasoning_prompts": f"""WITH {P}, c AS (SELECT sample_id, lines, unnest(range(0, len(lines), 3)) AS s FROM p)
        SELECT sample_id, CAST(s AS INT) AS start, 4 AS messages, sha256('الأبيات:' || chr(10) || array_to_string(lines[s + 1:s + 3], chr(10)) || CASE WHEN s > 0 THEN chr(10) || 'البيت السابق: ' || lines[s] ELSE '' END
          || CASE WHEN s + 4 <= len(lines) THEN chr(10) || 'البيت التالي: ' || lines[s + 4] ELSE '' END || chr(10) || CASE WHEN s = 0 THEN 'أعد overview و verse_reasoning.' ELSE 'أعد verse_reasoning. النظرة العامة: نظرة' END) AS digest FROM c""",
    "reasoning_render": f"WITH {P} SELECT sample_id, sha256('نظرة' || chr(10) || chr(10) || {_BLOCKS}) AS digest FROM p",
    "repair_prompts": f"WITH {P} SELECT sample_id, 4 AS messages, sha256({_s(R.JUDGE)} || '|<source>' || chr(10) || poem_text || chr(10) || '</source>' || chr(10) || '<candidate>' || chr(10) || '{{}}' || chr(10) || '</candidate>|raw|أصلح:' || chr(10) || '- one' || chr(10) || '- ' || meter_name) AS digest FROM p",
    "response_render": f"WITH {P} SELECT sample_id, sha256('كلام' || chr(10) || chr(10) || 'بعد' || chr(10) || chr(10) || 'النتيجة النهائية:' || chr(10) || chr(10) || poem_text) AS digest FROM p",
    "mcq_render": f"WITH {P} SELECT sample_id, sha256('القصيدة:' || chr(10) || poem_text || chr(10) || chr(10) || 'السؤال:' || chr(10) || 'ما الوزن؟' || chr(10) || chr(10) || 'الخيارات:' || chr(10) || {' || chr(10) || '.join(_CH)}) AS question, sha256('ننظر' || chr(10) || '- شاهد' || chr(10) || {' || chr(10) || '.join(f"'- ' || {c} || ': تقييم ' || meter_name || ' {i}'" for i, c in enumerate(_CH))} || chr(10) || 'خلاصة' || chr(10) || 'الإجابة: ' || {_CH[2]}) AS answer FROM p",
    "reconstruction_render": f"WITH {P} SELECT sample_id, sha256('البيت 1:' || chr(10) || 'خ ← ' || meter_name || chr(10) || 'ت' || chr(10) || 'س' || chr(10) || 'ر' || chr(10) || chr(10) || poem_text) AS digest FROM p",
    "instruction_contract": f"""WITH {P}, x AS (SELECT *, couplet_count % 4 AS k, chr(10) || '' AS nl FROM p),
        t AS (SELECT *, CASE k WHEN 0 THEN {_s(chr(10).join(C.HEADINGS))} || chr(10) || couplet_count || ' ' || meter_name || ' {"x" * 200}' WHEN 1 THEN 'قبل ' || {_s(chr(10).join(C.HEADINGS))} || chr(10) || meter_name WHEN 2 THEN {_s(chr(10).join(reversed(C.HEADINGS)))} || couplet_count || verses[1] ELSE 'قصير' END AS i FROM x)
        SELECT sample_id, CAST((length(i) < 150)::INT + (k = 3)::INT + (k IN (1, 2))::INT + (k = 2)::INT + (NOT contains(i, CAST(couplet_count AS VARCHAR)))::INT + (NOT contains(i, meter_name))::INT
          + (len(list_filter(verses, lambda v: length(regexp_replace(v, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) >= 12 AND contains(i, regexp_replace(v, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')))) > 0)::INT AS BIGINT) AS n_errors FROM t""",
}
