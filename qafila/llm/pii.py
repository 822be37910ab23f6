"""Problem 9: personal details in free text, found in a deobfuscated view and mapped back to the source.

Method: offset-preserving deobfuscation. A transducer rewrites the text into a view that is easy to search (digits
of any script to ASCII, full-width and look-alike characters to plain ones, special spaces to U+0020, invisible
characters and vowel marks dropped, spelled digits and at/dot disguises resolved), and records for every character
of the view the source character it came from. Identifiers are detected in the view; their spans are mapped back.

Kinds: email, phone, id_number, address, person_name. Where spans overlap, the one that starts first stands, of
those that start together the longest. Defined results: null text has no details and stays null, an empty text stays
empty; extra columns are carried along. Detection looks at the whole text.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.llm.unify import LATIN_TWINS, MARKS, consistent
from qafila.runtime import cut, spread

PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person_name": "[PERSON_NAME]"}


# ---------------------------------------------------------------- transducer
class _OneToOne(dict):
    """Per-character rewriting that keeps lengths; filled as characters are met."""

    def __missing__(self, o: int) -> int:
        c = chr(o)
        d = ud.decimal(c, None)
        if d is not None:
            out = str(d)
        elif c in "\r\n":
            out = c
        elif c.isspace():
            out = " "
        elif c in LATIN_TWINS:
            out = c  # decided per word, see _twins
        else:
            n = ud.normalize("NFKC", c)
            out = n if len(n) == 1 else c
            if c in "‐‑‒–−":
                out = "-"
        self[o] = ord(out)
        return self[o]


_ONE = _OneToOne()
_GONE = re.compile("[­͏؜᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]|" + MARKS.pattern)
_TWIN = re.compile("[Ͱ-ԯ]")
_MIXED = re.compile(r"[A-Za-z][^\W\d_]*[Ͱ-ԯ]|[Ͱ-ԯ][^\W\d_]*[A-Za-z]")
_WORD = re.compile(r"[^\W\d_]+")
_TO_LATIN = str.maketrans(LATIN_TWINS)

# Digits written as words.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "صفر": "0", "واحد": "1", "اثنان": "2", "اثنين": "2", "ثلاثة": "3", "أربعة": "4", "خمسة": "5", "ستة": "6", "سبعة": "7", "ثمانية": "8", "تسعة": "9",
}
_SPELLED = re.compile(r"\b(?:(?:" + "|".join(_DIGIT_WORDS) + r")\b[ -]{0,2}){7,}", re.I)
_SPELLED_ONE = re.compile("|".join(_DIGIT_WORDS), re.I)
_AT = r"(?:\s*[\[({<]\s*(?:at|آت|ات|@)\s*[\])}>]\s*|\s?@\s?)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|نقطة|\.)\s*[\])}>]\s*|\.|\s(?:dot|نقطة)\s)"
#: A dot inside the local part, where a plain one needs no rewriting.
_SPELLED_DOT = r"(?:\s*[\[({<]\s*(?:dot|نقطة|\.)\s*[\])}>]\s*|\s(?:dot|نقطة)\s)"
#: An address with its disguises; plain words "at" and "dot" count only together.
_DISGUISED = re.compile(
    rf"(?P<local>(?:[\w+'-]+{_SPELLED_DOT})*[\w.+'-]*[\w+'-])(?P<at>{_AT}|\s(?:at|آت)\s(?=[\w-]+(?:\.[\w-]+)*\s(?:dot|نقطة)\s))(?P<domain>[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[a-z]{{2,}})(?![\w-])",
    re.I | re.A,
)
_DOT_ANY, _DOT_SPELLED = re.compile(_DOT, re.I), re.compile(_SPELLED_DOT, re.I)
_AT_WORD = re.compile(r"(?<![^\W_])(?:at|آت|ات)(?![^\W_])", re.I)


def _may_spell_digits(low: str) -> bool:
    """Seven digit words stand in a row only where seven are counted."""
    return sum(map(low.count, _DIGIT_WORDS)) >= 7


def _may_disguise(low: str) -> bool:
    return "@" in low or (("dot" in low or "نقطة" in low or "." in low) and _AT_WORD.search(low) is not None)


def deobfuscate(text: str) -> tuple[str, list[int] | None, list[int] | None]:
    """The view, and of each of its characters the source start and end (None: the same positions)."""
    view = text.translate(_ONE) if not text.isascii() else text
    if not text.isascii() and _TWIN.search(view) and _MIXED.search(view):
        view = _WORD.sub(lambda m: m.group(0).translate(_TO_LATIN) if re.search("[A-Za-z]", m.group(0)) else m.group(0), view)
    starts: list[int] | None = None
    if _GONE.search(view):
        starts = [i for i, c in enumerate(view) if not _GONE.match(c)]
        view = "".join(view[i] for i in starts)
    ends = None if starts is None else [i + 1 for i in starts]
    low = view.lower()
    for may, rule, rewrite in ((_may_spell_digits, _SPELLED, _spelled), (_may_disguise, _DISGUISED, _plain_address)):
        if may(low) and rule.search(view):
            view, starts, ends = _respliced(view, starts or list(range(len(view))), ends or list(range(1, len(view) + 1)), rule, rewrite)
    return view, starts, ends


def _respliced(view: str, starts: list[int], ends: list[int], rule: re.Pattern, rewrite) -> tuple[str, list[int], list[int]]:
    chars, new_starts, new_ends, last = [], [], [], 0

    def keep(a: int, b: int) -> None:
        chars.append(view[a:b])
        new_starts.extend(starts[a:b])
        new_ends.extend(ends[a:b])

    for m in rule.finditer(view):
        keep(last, m.start())
        for piece, a, b in rewrite(m):
            if piece == view[a:b]:
                keep(a, b)
            else:
                chars.append(piece)
                new_starts.extend([starts[a]] * len(piece))
                new_ends.extend([ends[b - 1]] * len(piece))
        last = m.end()
    keep(last, len(view))
    return "".join(chars), new_starts, new_ends


def _spelled(m: re.Match) -> Iterator[tuple[str, int, int]]:
    """(text of the view, start, end) of the digits, and what stood after the last."""
    for d in _SPELLED_ONE.finditer(m.group(0)):
        yield _DIGIT_WORDS[d.group(0).lower()], m.start() + d.start(), m.start() + d.end()
    tail = len(m.group(0)) - len(m.group(0).rstrip(" -"))
    if tail:
        yield m.group(0)[-tail:], m.end() - tail, m.end()


def _plain_address(m: re.Match) -> Iterator[tuple[str, int, int]]:
    for name, dots in (("local", _DOT_SPELLED), ("domain", _DOT_ANY)):
        at = m.start(name)
        for d in dots.finditer(m.string, *m.span(name)):
            yield m.string[at : d.start()], at, d.start()
            yield ".", *d.span()
            at = d.end()
        yield m.string[at : m.end(name)], at, m.end(name)
        if name == "local":
            yield "@", *m.span("at")


# ---------------------------------------------------------------- detectors over the view
_EMAIL = re.compile(r"(?<![\w.+'-])[A-Z0-9_+](?:[A-Z0-9_.+'-]*[A-Z0-9_+-])?@(?:[A-Z0-9](?:[A-Z0-9-]*[A-Z0-9])?\.)+[A-Z]{2,}(?![\w-])", re.I | re.A)

_SEP = r"[ .\-/]"
_PHONE = re.compile(
    r"(?<![\w+@/:.,-])(?:"
    rf"(?:\+|00)\d{{1,4}}{_SEP}?(?:\(0\)){_SEP}?\d{{1,4}}(?:{_SEP}?\d{{2,4}}){{1,4}}"  # +99 (0)12 345 6789
    r"|(?:\+|00)\d{1,4}[ .-]\d{1,4}(?:[ .-]\d{2,4}){1,4}"  # +99 12 345 6789
    r"|(?:\+|00)\d{9,13}"
    rf"|\(0\d{{1,4}}\){_SEP}?\d{{2,4}}(?:{_SEP}?\d{{2,4}}){{1,3}}"  # (012) 345-6789
    rf"|\(\d{{3}}\) ?\d{{3}}{_SEP}\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}|\d{{3}}\.\d{{3}}\.\d{{4}}"  # (555) 123-4567
    r"|0\d{2}-\d{3}-\d{4}|0\d{2}\.\d{3}\.\d{4}|0\d{2} \d{3} \d{4}|0\d{2}/\d{7}|0\d{2} \d{2} \d{2} \d{3}|0\d{9}"
    r")(?![\w@]|[-/]\d|[.,:]\d)"
)
#: Shapes shared with identity numbers: a phone only if a phone word stands before.
_PHONE_WORD = re.compile(r"(?:tel|phone|call|whatsapp|mobile|ring me on|fax|هاتف|جوال|اتصلوا على|تلفون|واتساب)[^\d\w]{0,4}$", re.I)

_ID_LABEL = re.compile(
    r"(?<!\w)(?:passport|identity card|identity|national (?:number|id|insurance)|residence permit|permit|ssn|social security|(?:driver'?s?|driving) licen[cs]e|tax id|id(?: card)?(?= ?(?:no|number|nr|#|:))"
    r"|جواز السفر|جواز سفر|بطاقة الهوية|بطاقة|رقم الهوية|الهوية|الرقم الوطني|هوية|رخصة الإقامة|الإقامة)"
    r"(?: ?(?:number|no\.?|nr\.?|#|رقمها|رقمه|رقم))*(?: is| هو| هي)?[ :.\n]{1,3}",
    re.I,
)
_ID_VALUE = re.compile(
    r"(?:[A-Z]{1,3}[- ]?\d{5,12}[A-Z]?|\d{6,14}[A-Z]?|\d{1,4}(?:[.\-/]\d{1,5}){1,4}|\d{2,5}(?: \d{2,5}){1,2})(?![\w@]|[./-]\d)", re.I | re.A
)

_STREET = r"(?:street|st|road|rd|avenue|ave|lane|ln|alley|terrace|quay|square|boulevard|blvd|crescent)\b\.?"
#: Other words for streets, capitalised and with a town behind.
_PLACE = r"(?-i:Hill|Drive|Way|Court|Place|Close|Row|Park|Walk|Mews|View|Grove|Rise|Green|Gate|Yard|Passage|Highway|Parkway|Circle|Gardens)"
_NAMED = r"[^\W\d_]+(?:[ '-][^\W\d_]+)?"
_TOWN = r"[^\W\d_]+(?: (?!(?:by|and|on|is|at|in|for)\b)[^\W\d_]+)?"
_GAP = r"(?:, ?| ?\r?\n|, ?\r?\n)"
_EN_ADDRESS = re.compile(
    r"(?<![\w/-])(?:"
    rf"(?:(?:flat|apt\.?|apartment|unit|suite) \d+(?:-?[a-z])?, ?)?\d{{1,4}}(?:-?[a-z])? {_NAMED} {_STREET}"
    rf"|(?<!\w)[^\W\d_]+ (?:street|st|road|rd|avenue|ave|lane|ln|alley|terrace|quay)\b\.? \d{{1,4}}(?:-?[a-z])?(?=, ?\d{{4,6}} |, ?[^\W\d_])"
    rf"|\d{{1,4}}(?:-?[a-z])? (?-i:[A-Z])[^\W\d_]+(?: (?-i:[A-Z])[^\W\d_]+)? {_PLACE}(?=, ?(?-i:[A-Z])[^\W\d_])"
    r"|p\. ?o\. ?box \d+|po box \d+|post office box \d+"
    rf")(?:{_GAP}(?:\d{{4,6}} )?{_TOWN}(?: \d{{4,6}})?)?",
    re.I,
)
#: Where such an address may begin; the rule itself is tried there only.
_HOUSE = re.compile(r"(?<![\w/-])\d{1,4}(?:-?[A-Za-z])? (?=[^\W\d_])")
_FLATS = ("flat", "apt", "apartment", "unit", "suite")
_BOX = re.compile(r"p\. ?o\. ?box|po box|post office box")
_STREET_NO = re.compile(r"(?<=[^\W\d_] )(?:street|st|road|rd|avenue|ave|lane|ln|alley|terrace|quay)\b\.? \d")


def _addresses(view: str, low: str) -> Iterator[tuple[int, int]]:
    starts = {m.start() for m in _HOUSE.finditer(view)}
    for flat in _FLATS:
        at = low.find(flat)
        while at >= 0:
            starts.add(at)
            at = low.find(flat, at + 1)
    if "box" in low:
        starts.update(m.start() for m in _BOX.finditer(low))
    for m in _STREET_NO.finditer(low):
        begin = m.start() - 1
        while begin and low[begin - 1].isalpha():
            begin -= 1
        starts.add(begin)
    for at in starts:
        if m := _EN_ADDRESS.match(view, at):
            yield m.span()


_AR_TOWN = r"(?:، ?[^\W\d_]+(?: [^\W\d_]+){0,1})?"
_AR_ADDRESS = re.compile(
    r"(?<!\w)(?:"
    rf"حي [^\W\d_]+(?:، ?(?:زقاق|شارع|بناية|منزل|شقة|عمارة|بيت|طابق) [\w]+)+{_AR_TOWN}"
    rf"|شارع [^\W\d_]+(?:، ?| )(?:بناية|منزل|رقم|عمارة|بيت) \d+(?:، ?(?:شقة|منزل|طابق) \d+)*{_AR_TOWN}"
    rf"|(?:شقة \d+، ?)?(?:بناية |منزل |عمارة )?\d{{1,4}}،? شارع [^\W\d_]+{_AR_TOWN}"
    rf"|ص ?\. ?ب ?\.? ?\d+{_AR_TOWN}|صندوق بريد \d+{_AR_TOWN}"
    r")"
)

# ---------------------------------------------------------------- names
# A Latin name: words with a capital each (of any case only where see _latin_name), initials, particles before the family.
_W = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_PARTICLE = r"(?:(?:ibn|bin|bint|b\.|van|von|der|de|del|di|da|la|le) )"
_LATIN_NAME = re.compile(rf"(?P<last>{_W}), (?P<first>{_W})(?![^\W\d_])|(?:[^\W\d_]\. ?){{1,2}}{_PARTICLE}*{_W}|{_W} (?:[^\W\d_]\. ?)?(?:(?:ibn|bin|bint|b\.) {_W} )*{_PARTICLE}*{_W}", re.I)
_A = r"[ء-غـ-ي]"
_ARABIC_NAME = rf"(?:{_A}{{3,}}، {_A}{{2,}}|(?:{_A}\. ?){{1,2}}{_A}{{3,}}|{_A}{{2,}} {_A}\. {_A}{{3,}}|{_A}{{2,}}(?: (?:بن|ابن|بنت) {_A}{{2,}})* {_A}{{3,}}(?: {_A}{{3,}})?)"
_LATIN_TITLE = re.compile(r"(?:dr|mr|mrs|ms|miss|prof|professor|sheikh|rev|sir)\.? ", re.I)
_TITLE = r"(?:(?:السيدة?|الأستاذة?|الدكتورة?|الشيخة?|د\.|أ\.) ?)?"
# Words that may stand capitalised where a name could, and are none.
_NO_NAME = frozenset(
    "a all an and any as at best both but by call cc copied contact dear each email every fax few for from he hello her here his i if in is it its kind love many me most my no not "
    "of on only or order our phone please prof professor regards replies see sent she signed sincerely so some tel thank thanks that the their them these they this those to two three "
    "us was we what when where which who whoever why with write yes yours you your dr mr mrs ms miss sheikh rev sir street road avenue lane box po page line verse volume".split()
)
#: What a name follows, searched in the lower-cased view; each starts with letters that are looked for first.
_BEFORE = [
    (first, re.compile(r"(?<![^\W_])" + rule))
    for first, rule in (
        ("name", r"(?:my name is|(?:full )?name ?:) ?"), ("i am", r"i am (?:called )?"), ("i'm", "i'm "), ("this is", "this is "), ("yours", r"yours(?: truly| sincerely| faithfully)?,\s+"),
        ("regards", r"regards,\s+"), ("best", r"best(?: wishes)?,\s+"), ("sincerely", r"sincerely,\s+"), ("cheers", r"cheers,\s+"), ("thank", r"(?:thanks|thank you),\s+"),
        ("signed", r"signed(?: by|,|:) "), ("signature", r"signature ?: ?"), ("contact", r"contact(?: person)? ?:? "), ("author", r"author ?: ?"), ("from", r"from ?: ?"), ("attn", r"attn\.? ?:? "),
        (" by ", r"(?:sent|written|copied|copied for us|transcribed|read|owned|prepared|typed|translated|collated) by "), ("belong", r"belong(?:s|ed) to "), ("thank", r"(?:please thank|thanks to|thank) "),
        ("behalf", "on behalf of "), ("care of", "care of "), ("c/o", "c/o "),
        ("my ", r"my (?:colleague|friend|brother|sister|father|mother|cousin|aunt|uncle|teacher|student|neighbou?r|assistant|wife|husband|son|daughter|manager|doctor|lawyer|landlord),? "),
        ("call", "call(?:ed)? "), ("ask", "ask(?:ed)?(?: for)? "), ("meet", "meet "), ("met", "met "), ("wr", r"(?:write|wrote) to "), ("visit", "visit(?:ed)? "), ("phone", "phoned? "),
        ("dr", r"dr\.? "), ("mr", r"mrs?\.? "), ("ms", r"ms\.? "), ("miss", "miss "), ("prof", r"prof(?:essor|\.)? "), ("sheikh", "sheikh "), ("rev", r"rev\.? "), ("sir", "sir "),
    )
]
#: What people are said to do, with their name before it.
_AFTER = re.compile(r" (?:reads?|disagrees?|agrees|wrote|writes|copied|sent|called|met|signed|lives|said|says|asked|replied|adds|confirmed|transcribed|translated)(?![^\W_])")
_BACK = re.compile(rf"(?<![^\W_])(?:{_W},? |(?:[^\W\d_]\. ?))(?:[^\W\d_]\. ?|{_PARTICLE})*{_W}$")
_ENDS = re.compile(r"\s*(?:[.,;:!?\n\r]|$)")
_ARABIC_BEFORE = [
    (firsts, re.compile(rule))
    for firsts, rule in (
        (("كتبه", "كتبها", "اسمي", "وقعه", "المخلص", "توقيع", "الاسم", "تحيات"), rf"(?:كتبه|كتبها|اسمي|وقعه|المخلصة?|التوقيع|توقيع|الاسم|تحياتي،|تحيات) ?:? {_TITLE}(?P<n>{_ARABIC_NAME})"),
        (("إلينا", "نقله", "نسخه", "نسخها", "زميل", "صديق"), rf"(?:أرسلها إلينا|أرسله إلينا|نقله|نسخه|نسخها|زميلي|زميلتي|صديقي|صديقتي) (?:السيدة?|الأستاذة?|الدكتورة?|الشيخ|د\.)? ?(?P<n>{_ARABIC_NAME})"),
        (("شكرا",), rf"شكرا (?:للأستاذة?|للسيدة?|للدكتورة?|ل) ?(?P<n>{_ARABIC_NAME})(?= على)"),
        (("قرأ",), rf"قرأ (?P<n>{_ARABIC_NAME})(?= هذا البيت)"),
    )
]
_STREETS = ("street", "st", "road", "rd", "avenue", "ave", "lane", "ln", "alley", "terrace", "quay", "square", "boulevard", "blvd", "crescent", "box ") + tuple("hill drive way court place close row park walk mews view grove rise green gate yard passage highway circle gardens".split())
_AR_STREETS = ("شارع", "حي ", "ص.ب", "ص .ب", "ص. ب", "ص . ب", "صندوق بريد")


_DIGIT = re.compile("[0-9]")


def _phones(view: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(view):
        if not 9 <= sum(c.isdigit() for c in m.group(0)) <= 16:
            continue
        if m.group(0).isdigit() and len(m.group(0)) <= 10 and not _PHONE_WORD.search(view[max(0, m.start() - 20) : m.start()]):
            continue  # ten digits in a row are a phone only behind a word that says so
        yield m.span()


_ID_WORDS = ("passport", "identity", "national", "permit", "ssn", "social", "licen", "tax", "id", "جواز", "بطاقة", "هوية", "الوطني", "رخصة", "الإقامة")


def _ids(view: str, low: str) -> Iterator[tuple[int, int]]:
    for label in _ID_LABEL.finditer(view) if any(w in low for w in _ID_WORDS) else ():
        m = _ID_VALUE.match(view, label.end())
        if m and sum(c.isdigit() for c in m.group(0)) >= 5:
            yield m.span()


def _latin_name(view: str, at: int, known: frozenset[str], whole: bool = False) -> tuple[int, int] | None:
    """The name that starts at a place. Its words have capitals; all in lower case it must have a known given name, or an
    initial and nothing behind it in its clause."""
    while title := _LATIN_TITLE.match(view, at):
        at = title.end()
    m = _LATIN_NAME.match(view, at)
    if m is None or not view[at].isascii() or (whole and m.end() != len(view)):
        return None
    words = [w for w in re.split(r"[ ,.]+", m.group(0)) if w]
    full = [w for w in words if len(w) > 1 and w.lower() not in ("ibn", "bin", "bint", "van", "von", "der", "de", "del", "di", "da", "la", "le")]
    if any(w.lower() in _NO_NAME for w in full) or len(full[-1]) < 2:
        return None
    capital = [(w[3:] if w[:3].lower() in ("al-", "el-") else w)[0].isupper() for w in full]
    if all(capital):
        return m.span()
    if not any(capital) and (any(w in known for w in full) or (len(words) > len(full) and (whole or _ENDS.match(view, m.end())))):
        return m.span()
    return None


def _names(view: str, low: str, credits, known: frozenset[str]) -> Iterator[tuple[int, int]]:
    found = []
    for first, rule in _BEFORE:
        if first in low:
            found += [_latin_name(view, m.end(), known) for m in rule.finditer(low)]
    for m in _AFTER.finditer(low):
        # the two or three words before, if they are a name up to here
        far = max(0, m.start() - 80)
        back = _BACK.search(view[far : m.start()])
        if back and (hit := _latin_name(view[: m.start()], far + back.start(), known, whole=True)):
            shouted = view[m.start() + 1].isupper()  # capitals say nothing in a text of capitals
            first = re.match(_W, view[hit[0] :]).group(0).lower()
            found.append(hit if first in known or len(first) == 1 or (view[hit[0]].isupper() and not shouted) else None)
    for firsts, rule in _ARABIC_BEFORE:
        if any(f in low for f in firsts):
            found += [m.span("n") for m in rule.finditer(view)]
    for hit in filter(None, found):
        if _spelling(view[slice(*hit)]) not in credits and _spelling(view[max(0, view.rfind("\n", 0, hit[0]) + 1) : hit[1]].strip()) not in credits:
            yield hit


def _spelling(name: str) -> int:
    """The number a spelling of a name is compared by: a 64-bit hash of its consistent form."""
    return xxhash.xxh64_intdigest(consistent(name) or "") - (1 << 63)


def spans(text: str | None, credits: frozenset[int] | set[int] = frozenset(), known: frozenset[str] = frozenset()) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every personal detail, in code points of the source text.

    credits: numbers (_spelling) of the names that are no case; known: given names, lower case.
    """
    if not text:
        return []
    view, starts, ends = deobfuscate(text)
    low = view.lower()
    if len(low) != len(view):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in view)
    hits = [("email", *m.span()) for m in _EMAIL.finditer(view)] if "@" in view else []
    if _DIGIT.search(view):
        hits += [("phone", *s) for s in _phones(view)]
        hits += [("id_number", *s) for s in _ids(view, low)]
        if any(f in low for f in _STREETS):
            hits += [("address", *s) for s in _addresses(view, low)]
        if any(f in low for f in _AR_STREETS):
            hits += [("address", *m.span()) for m in _AR_ADDRESS.finditer(view)]
    hits += [("person_name", *s) for s in _names(view, low, credits, known)]
    rank = {"email": 0, "id_number": 1, "phone": 2, "address": 3, "person_name": 4}
    out: list[tuple[str, int, int]] = []
    for kind, a, b in sorted(set(hits), key=lambda h: (h[1], -h[2], rank[h[0]])):
        if out and a < out[-1][2]:
            continue
        out.append((kind, a, b))
    return out if starts is None else [(k, starts[a], ends[b - 1]) for k, a, b in out]


#: Spellings of credits sent to every task (8 bytes each: 40 MB at most); beyond, names are held against them by a join.
CREDIT_ROWS = 5_000_000
#: given_names is a reference table; a larger one is refused, not cut.
MAX_GIVEN = 100_000


@F.pandas_udf(T.LongType())
def _spellings(names: pd.Series) -> pd.Series:
    return names.map(_spelling, na_action="ignore").astype("Int64")


def _credits(credits: DataFrame | None) -> DataFrame | None:
    """spelling: the numbers of all credited names."""
    if credits is None:
        return None
    return credits.filter("poet_name is not null").select("poet_name").distinct().select(_spellings("poet_name").alias("spelling")).distinct()


def _detector(docs: DataFrame, text: str, spellings: DataFrame | None, given_names: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """docs with details (kind, start_pos, end_pos, spelling), and the spellings still to be left out by a join."""
    spark, known, left = docs.sparkSession, frozenset(), spellings
    if given_names is not None:
        rows = given_names.select(F.lower("latin_form").alias("g")).filter("g is not null").distinct().limit(MAX_GIVEN + 1).collect()
        if len(rows) > MAX_GIVEN:
            raise ValueError(f"more than {MAX_GIVEN} given names")
        known = frozenset(r.g for r in rows)
    none: frozenset[int] = frozenset()
    sent = spark.sparkContext.broadcast(none)
    if spellings is not None:
        spellings = cut(spellings)
        left = spellings
        if spellings.count() <= CREDIT_ROWS:
            sent, left = spark.sparkContext.broadcast(frozenset(spellings.toPandas()["spelling"].tolist())), None

    joined = left is not None

    @F.pandas_udf(_DETAILS)
    def run(texts: pd.Series) -> pd.Series:
        rows = []
        for t in texts:
            found = spans(t, sent.value, known)
            rows.append([{"kind": k, "start_pos": a, "end_pos": b, "spelling": _spelling(t[a:b]) if joined and k == "person_name" else None} for k, a, b in found])
        return pd.Series(rows)

    return docs.withColumn("details", run(F.col(text))), left


_DETAILS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start_pos", T.LongType()), T.StructField("end_pos", T.LongType()), T.StructField("spelling", T.LongType())]))


def _splice(text, details):
    """The text with a placeholder for each detail; an expression over the sorted spans, so the JVM does it."""
    mark = F.create_map(*(F.lit(x) for kv in PLACEHOLDER.items() for x in kv))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    step = lambda acc, d: F.struct(F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (d["start_pos"] - acc["at"]).cast("int")), mark[d["kind"]]).alias("out"), d["end_pos"].alias("at"))
    return F.aggregate(details, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def redact(docs: DataFrame, text: str = "text", credits: DataFrame | None = None, given_names: DataFrame | None = None) -> DataFrame:
    """docs with two more columns: details (kind, start_pos, end_pos) and redacted.

    Row-local, no shuffle of its own, unless there are more than CREDIT_ROWS spellings of credits (poet_name): then the
    documents are numbered and written first, and those with a credited name are found by a join.
    """
    plain = lambda d: F.struct(d["kind"].alias("kind"), d["start_pos"].alias("start_pos"), d["end_pos"].alias("end_pos"))
    found, left = _detector(docs, text, _credits(credits), given_names)
    if left is not None:
        found = cut(found.withColumn("_row", F.monotonically_increasing_id()))
        named = found.select("_row", F.explode("details").alias("d")).select("_row", "d.start_pos", "d.spelling")
        wrong = named.join(left, "spelling", "left_semi").groupBy("_row").agg(F.collect_set("start_pos").alias("_credited"))
        found = found.join(wrong, "_row", "left").withColumn("details", F.filter("details", lambda d: ~F.array_contains(F.coalesce("_credited", F.array().cast("array<bigint>")), d["start_pos"])))
        found = found.drop("_row", "_credited")
    found = found.withColumn("details", F.transform("details", plain))
    return found.withColumn("redacted", F.when(F.size("details") == 0, F.col(text)).otherwise(_splice(F.col(text), F.col("details"))))


def find_details(docs: DataFrame, key: str = "doc_id", text: str = "text", credits: DataFrame | None = None, given_names: DataFrame | None = None) -> DataFrame:
    """key, kind, start_pos: one row per occurrence. Texts are spread first, as a small file may be one task."""
    found, left = _detector(spread(docs.select(key, F.col(text).alias("text"))), "text", _credits(credits), given_names)
    rows = found.select(key, F.explode("details").alias("d")).select(key, "d.kind", "d.start_pos", "d.spelling")
    if left is not None:
        rows = rows.join(left, "spelling", "left_anti")
    return rows.select(key, "kind", "start_pos")
