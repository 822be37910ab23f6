"""The conversations of the generation loop: what is asked, how it is judged, how a repair is asked for.

A request is one JSON object (its kind says which contract holds); what surrounds it is wording, and the wording is this
project's own. Demonstrations are requests about a made-up couplet with answers that pass their own contracts.
"""

from __future__ import annotations

import json
from functools import lru_cache

Message = dict[str, str]

#: What is asked for, by kind.
SYSTEMS = {
    "poem-generation": "أنت محرر نصوص عربية. اكتب تعليمات لنظم النص المعطى من غير نقل ألفاظه. أعد كائن JSON واحدا: instruction.",
    "poem-completion": "أنت محرر نصوص عربية. اكتب تعليمات لإتمام النص المعطى من غير نقل ألفاظه. أعد كائن JSON واحدا: instruction.",
    "reasoning-chunk": "أنت محرر نصوص عربية. علل كل بيت من الأبيات المعطاة. أعد كائن JSON واحدا: verse_reasoning، وفي القطعة الأولى overview.",
    "mcq": "أنت واضع أسئلة. ضع للجواب المعطى ثلاثة بدائل خاطئة وعلل كل جواب. أعد كائن JSON واحدا: question, correct_answer, distractors, reasoning.",
    "poem-reconstruction": "أنت مصحح نصوص. أفسد لفظا في عدد الأبيات المطلوب ثم صحح كل خلل. أعد كائن JSON واحدا: corrupted_poem, repairs.",
    "chunk-analysis": "أنت محرر نصوص عربية. لخص القطعة المعطاة. أعد كائن JSON واحدا: note.",
}
#: What is asked of the judge, by kind; each opening the same way.
JUDGE = "أنت مراجع."
JUDGES = {
    "poem-generation": "هل تصف التعليمات النص ولا تنقله؟",
    "poem-completion": "هل تصف التعليمات النص ولا تنقله؟",
    "reasoning-chunk": "هل يطابق التعليل أبياته ولا يناقض ما قبله؟",
    "mcq": "هل الجواب المعلم وحده صحيح والبدائل خاطئة؟",
    "poem-reconstruction": "هل كل خلل مقصود وكل تصحيح معلل؟",
}
#: Fields the contract has checked already and the judge need not read.
HIDDEN = {"reasoning-chunk": ("first_hemistich_scansion", "second_hemistich_scansion", "rhyme_check")}
_COUPLET = "نهر يجري = زهر يسري"
#: Requests of the demonstrations.
EXAMPLES = {
    "poem-generation": {"poem": _COUPLET, "meter": "الرجز", "n": 1},
    "poem-completion": {"poem": _COUPLET, "meter": "الرجز", "n": 1},
    "reasoning-chunk": {"instruction": "وصف نهر", "meter": "الرجز", "n": 1, "start": 1, "couplets": [_COUPLET], "before": None, "after": None, "overview": True},
    "mcq": {"poem": _COUPLET, "truth": "الرجز", "question": "ما بحر هذا البيت القصير؟"},
    "poem-reconstruction": {"poem": _COUPLET, "count": 1},
    "chunk-analysis": {"chunk": _COUPLET},
}


def say(role: str, content: str) -> Message:
    return {"role": role, "content": content}


def as_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False)


@lru_cache(maxsize=32)
def _opening(kind: str, demonstrate) -> tuple[Message, ...]:
    shot = {"kind": kind} | EXAMPLES[kind]
    return say("system", SYSTEMS[kind]), say("user", as_json(shot)), say("assistant", as_json(demonstrate(shot)))


def asking(ask: dict, demonstrate, told: str | None = None) -> list[Message]:
    """System, one demonstration (demonstrate(request) gives its answer), request (told: its JSON, if that is at hand)."""
    return [*_opening(ask["kind"], demonstrate), say("user", told or as_json(ask))]


def shown(kind: str, candidate: object) -> object:
    """The candidate without what is hidden from the judge."""
    hidden = HIDDEN.get(kind, ())
    if not hidden or not isinstance(candidate, dict):
        return candidate
    return candidate | {"verse_reasoning": [{k: v for k, v in b.items() if k not in hidden} for b in candidate["verse_reasoning"]]}


def judging(ask: dict, candidate: object, told: str | None = None) -> list[Message]:
    kind = ask["kind"]
    both = f"<source>\n{told or as_json(ask)}\n</source>\n<candidate>\n{as_json(shown(kind, candidate))}\n</candidate>"
    return [say("system", f"{JUDGE} {JUDGES[kind]} " + 'أعد {"passed": true أو false, "errors": [..]} لا غير.'), say("user", both)]


def repairing(messages: list[Message], raw: str, errors: list[str]) -> list[Message]:
    """The conversation, the refused answer and what is wrong with it."""
    return [*messages, say("assistant", raw), say("user", "أصلح:\n" + "\n".join(f"- {e}" for e in errors))]


def request_in(messages: list[Message]) -> tuple[dict, bool]:
    """The request of a conversation, and whether a repair of its answer is asked for."""
    at = len(messages) - 1
    while messages[at]["role"] != "user" or not messages[at]["content"].startswith("{"):
        at -= 1
    return json.loads(messages[at]["content"]), at < len(messages) - 1
