"""Prompts, conversations and responses as string projections. The wording is this project's own."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators.contracts import HEADINGS

SYSTEM = "أنت محرر نصوص عربية. أعد كائن JSON واحدا بالمفاتيح المطلوبة لا غير."
JUDGE = 'أنت مراجع. أعد {"passed": true أو false, "errors": [..]} لا غير.'
#: Own wording of the six viewpoints from which an instruction may be written.
TEMPLATES = {
    "sound": "صف إيقاع النص وقافيته وجرسه.",
    "sense": "صف تدرج المعاني ووحدة النص.",
    "image": "صف الصور والتشبيهات.",
    "mood": "صف المقام والنبرة وصوت المتكلم.",
    "address": "صف المخاطب والمناسبة، وصرح إن لم تعرف.",
    "wording": "صف المعجم والتراكيب.",
}
#: Long and short syllables of one half line, by meter; written for this project from the classical feet.
FEET = {
    "البسيط": "--u- -u- --u- -u-", "الخفيف": "-u-- --u- -u--", "الرجز": "--u- --u- --u-", "الرمل": "-u-- -u-- -u-", "السريع": "--u- --u- -u-",
    "الطويل": "u-- u--- u-- u---", "الكامل": "uu-u- uu-u- uu-u-", "المتدارك": "-u- -u- -u- -u-", "المتقارب": "u-- u-- u-- u--", "المجتث": "--u- -u--",
    "المديد": "-u-- -u- -u--", "المضارع": "u--- -u--", "المقتضب": "---u -uu-", "المنسرح": "--u- ---u -uu-", "النثر": "", "الهزج": "u--- u---", "الوافر": "u-uu- u-uu- u--",
}
RESULT = "النتيجة النهائية:"
DUMPS = ("القصيدة:", "القصيدة النهائية:", "النص النهائي:")


def _shot(topic: str, mood: str, count: int, meter: str) -> str:
    """An instruction with all its headings, count and meter, long enough."""
    parts = (topic, mood, "ألفاظ قريبة من الطبيعة والسفر", "حرف واحد في أواخر الأبيات", meter, FEET[meter] or "لا نمط", f"{meter}: {count} من غير نقل لفظ من النص، مع التدرج من الوصف إلى الخاتمة في كل وحدة")
    return json.dumps({"instruction": "\n".join(f"{h} {x}" for h, x in zip(HEADINGS, parts, strict=True))}, ensure_ascii=False)


#: Demonstrations of an instruction: (request, answer).
SHOTS = (("بيتان على الرجز", _shot("وصف نهر", "هدوء", 2, "الرجز")), ("نص منثور من ثلاث وحدات", _shot("وصف ليل", "حنين", 3, "النثر")))


def is_prose(meter: Column) -> Column:
    return meter == X.PROSE


def feet(meter: Column) -> Column:
    """The pattern of a meter by name; unknown names raise."""
    table = F.create_map(*(F.lit(x) for kv in FEET.items() for x in kv))
    return F.coalesce(F.try_element_at(table, meter), F.raise_error(F.concat(F.lit("Unknown meter name: "), meter)))


def plan_heading(meter: Column) -> Column:
    return F.when(is_prose(meter), F.lit("خطة عملية لصناعة نص شعري منثور:")).otherwise(F.concat(F.lit("خطة عملية لصناعة بيت على بحر "), meter, F.lit(":")))


def form_guidance(meter: Column) -> Column:
    return F.when(is_prose(meter), F.lit("النص نثر: انظر في الإيقاع الداخلي.")).otherwise(F.concat(F.lit("كل شطر على هذا النمط: "), feet(meter)))


def template_of(sample_id: Column) -> Column:
    """A template by hash: the same on every retry, unlike an unseeded choice."""
    ids = F.array(*map(F.lit, TEMPLATES))
    return F.get(ids, (F.conv(F.substring(F.sha2(F.concat(F.lit("template:"), sample_id), 256), 1, 8), 16, 10).cast("bigint") % len(TEMPLATES)).cast("int"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def instruction_messages(template: Column, meter: Column, couplets: Column, poem: Column, minimum: int) -> Column:
    """One system, two demonstrations of two, one user: six messages."""
    table = F.create_map(*(F.lit(x) for kv in TEMPLATES.items() for x in kv))
    ask = F.concat_ws("\n", table[template], F.concat(F.lit("البحر: "), meter), F.concat(F.lit("عدد الأبيات: "), couplets.cast("string")), F.lit(f"الحد الأدنى: {minimum}"), form_guidance(meter), plan_heading(meter), poem)
    parts = [message("system", F.lit(SYSTEM))]
    for q, a in SHOTS:
        parts += [message("user", F.lit(q)), message("assistant", F.lit(a))]
    return F.array(*parts, message("user", ask))


def reasoning_messages(overview: Column, before: Column, chunk: Column, after: Column, first: Column) -> Column:
    """Four messages; a first chunk asks for an overview, a later one is given it."""
    ask = F.concat_ws(
        "\n",
        F.lit("الأبيات:"), chunk,
        F.when(before.isNotNull(), F.concat(F.lit("البيت السابق: "), before)), F.when(after.isNotNull(), F.concat(F.lit("البيت التالي: "), after)),
        F.when(first, F.lit("أعد overview و verse_reasoning.")).otherwise(F.concat(F.lit("أعد verse_reasoning. النظرة العامة: "), F.coalesce(overview, F.lit("")))),
    )
    return F.array(message("system", F.lit(SYSTEM)), message("user", F.lit("بيت واحد للتجربة")), message("assistant", F.lit('{"verse_reasoning":[]}')), message("user", ask))


def judge_messages(source: Column, candidate: Column) -> Column:
    return F.array(message("system", F.lit(JUDGE)), message("user", F.concat(F.lit("<source>\n"), source, F.lit("\n</source>\n<candidate>\n"), candidate, F.lit("\n</candidate>"))))


def repair_messages(messages: Column, raw: Column, errors: Column) -> Column:
    """The conversation, the refused answer and what is wrong with it."""
    complaint = F.concat(F.lit("أصلح:\n"), F.array_join(F.transform(errors, lambda e: F.concat(F.lit("- "), e)), "\n"))
    return F.concat(messages, F.array(message("assistant", raw), message("user", complaint)))


def render_reasoning(overview: Column, blocks: Column, prose: Column) -> Column:
    """Blocks (verse_index and text fields) as labelled sections."""
    unit = F.when(prose, F.lit("الوحدة")).otherwise(F.lit("البيت"))
    labels = (("المعنى", "intended_meaning"), ("الصلة بما قبله", "connection_to_previous"), ("الصورة", "imagery_and_diction"), ("صياغة أولى", "first_draft"), ("قرار المراجعة", "problem_with_first_draft"), ("الصياغة المنقحة", "revised_draft"), ("الفحص الأول", "first_hemistich_scansion"), ("الفحص الثاني", "second_hemistich_scansion"), ("القافية", "rhyme_check"))
    one = lambda b: F.concat_ws("\n", F.concat(unit, F.lit(" "), b["verse_index"].cast("string"), F.lit(":")), *(F.concat(F.lit(f"{label}: "), b[field]) for label, field in labels))
    return F.concat_ws("\n\n", X.strip(overview), F.array_join(F.transform(blocks, one), "\n\n"))


def compose_response(reasoning: Column, poem: Column) -> Column:
    """Cut at a result marker, labelled and leading dumps of the poem dropped, blank lines collapsed, the exact poem appended."""
    text = F.get(F.split(reasoning, RESULT, 2), F.lit(0))
    for d in DUMPS:
        text = F.replace(text, F.concat(F.lit(d + "\n"), poem), F.lit(""))
    lead = F.regexp_replace(text, r"(?U)^\s+", "")
    text = F.when(F.startswith(lead, poem), F.substring(lead, F.length(poem) + 1, F.length(lead))).otherwise(text)
    lines = F.filter(F.split(text, "\n"), lambda x: ~X.strip(x).isin(*DUMPS))
    text = F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, r"(?U)\s+$", "")), "\n")
    text = F.regexp_replace(X.strip(text), r"\n{3,}", "\n\n")
    return F.concat(text, F.lit(f"\n\n{RESULT}\n\n"), poem)


def completion_instruction(instruction: Column, beginning: Column, total: Column, provided: Column) -> Column:
    rest = (total - provided).cast("string")
    return F.concat(F.regexp_replace(instruction, r"(?U)\s+$", ""), F.lit("\n\nالبداية:\n"), beginning, F.lit("\n\nأكمل "), rest, F.lit(" من "), total.cast("string"), F.lit(" بيتا."))


def completion_instruction_of(instruction: Column, lines: Column, provided: Column) -> Column:
    """completion_instruction from the poem's couplets and how many of them are given away."""
    return completion_instruction(instruction, F.array_join(F.slice(lines, F.lit(1), provided), "\n"), F.size(lines), provided)


def question_text(poem: Column, question: Column, choices: Column) -> Column:
    rendered = F.array_join(F.transform(choices, lambda c: F.concat(c["label"], F.lit(") "), c["text"])), "\n")
    return F.concat(F.lit("القصيدة:\n"), poem, F.lit("\n\nالسؤال:\n"), question, F.lit("\n\nالخيارات:\n"), rendered)


def answer_text(approach: Column, evidence: Column, choices: Column, assessments: Column, conclusion: Column) -> Column:
    """Assessments are a map from the answer; a choice finds its own under any case, spacing or Unicode composition."""
    right = F.get(F.filter(choices, lambda c: c["correct"]), F.lit(0))
    form = lambda c: F.collate(F.regexp_replace(X.strip(c), r"(?U)\s+", " "), "UNICODE_CI")
    of = lambda c: F.get(F.filter(F.map_entries(assessments), lambda e: form(e["key"]) == form(c["text"])), F.lit(0))["value"]
    each = F.transform(choices, lambda c: F.concat(F.lit("- "), c["label"], F.lit(") "), c["text"], F.lit(": "), F.coalesce(of(c), F.lit(""))))
    return F.concat_ws("\n", approach, F.array_join(F.transform(evidence, lambda e: F.concat(F.lit("- "), e)), "\n"), F.array_join(each, "\n"), conclusion, F.concat(F.lit("الإجابة: "), right["label"], F.lit(") "), right["text"]))


def repairs_text(repairs: Column, poem: Column) -> Column:
    one = lambda r: F.concat_ws("\n", F.concat(F.lit("البيت "), r["couplet_index"].cast("string"), F.lit(":")), F.concat(r["corrupted_fragment"], F.lit(" ← "), r["corrected_fragment"]), r["diagnosis"], r["context_evidence"], r["repair_reason"])
    return F.concat_ws("\n\n", F.array_join(F.transform(repairs, one), "\n\n"), poem)
