"""Problem 6: one consistent form for visually identical text.

Method: normalisation quick-check properties isolate unstable segments, only those are normalised with their
boundary context, and the canonical segments are spliced into the unchanged text.

* The code points that can make a text unstable are derived once per process from the Unicode database: those
  whose compatibility composition differs, those with a combining class or that can compose with what precedes
  them (quick check "no" or "maybe"), those that show nothing, white space other than U+0020 and the letters and
  digits that have a look-alike.
* A segment is the maximal run between plain spaces around an unstable code point. A plain space neither composes
  nor reorders, so it is a safe boundary, and the run holds the whole word that the look-alike rule needs.

Look-alikes are two tables of letters, written down below from how the letters are drawn in common typefaces: Latin letters
with their Cyrillic (with the Abkhaz, Kurdish and Komi letters), Greek and Armenian twins, Arabic letters with those of
Persian, Urdu, Kurdish and Uyghur. Other scripts (Cherokee, Lisu, mathematical letters that NFKC does not fold) are left
as they are: a look-alike that is not in the tables stays and is no case.

Defined results: null stays null; an empty text stays empty; a text of blanks becomes empty (and is no case of
p6_found). Extra columns are carried along untouched.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts drawn like a Latin letter.
LATIN_TWINS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "Ѕ": "S", "І": "I", "Ј": "J", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "г": "r", "ү": "y", "ո": "n", "օ": "o", "ս": "u", "ց": "g",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "υ": "u", "κ": "k", "ϲ": "c", "ϳ": "j", "γ": "y",
}
# Letters of other Arabic-script languages drawn like an Arabic letter, and the digits drawn alike.
ARABIC_TWINS = {
    "ک": "ك", "ڪ": "ك", "ی": "ي", "ې": "ي", "ے": "ي", "ھ": "ه", "ہ": "ه", "ە": "ه", "ۃ": "ة",
    "۰": "٠", "۱": "١", "۲": "٢", "۳": "٣", "۷": "٧", "۸": "٨", "۹": "٩",
}
#: SURVEY I9: Arabic marks and tatweel.
MARKS = re.compile("[ؐ-ًؚ-ٰٟۖ-ۭـ]")
#: Shown although of the format category: signs written before or around numbers.
_SHOWN_FORMAT = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD}
#: Show nothing although not of the format category.
_BLANK_OTHERS = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}


def _shows_nothing(o: int, c: str, cat: str) -> bool:
    return o in _BLANK_OTHERS or (cat == "Cf" and o not in _SHOWN_FORMAT) or (cat == "Cc" and not c.isspace())


def _ranges(points: list[int]) -> str:
    out, i = [], 0
    while i < len(points):
        j = i
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        out.append(re.escape(chr(points[i])) + ("-" + re.escape(chr(points[j])) if j > i else ""))
        i = j + 1
    return "".join(out)


@lru_cache(maxsize=1)
def _tables() -> tuple[re.Pattern, dict[int, None], re.Pattern]:
    unstable, invisible, trailing = [], {}, set()
    ideographs = (range(0x3400, 0x4DC0), range(0x4E00, 0xA000), range(0x20000, 0x2F800), range(0x30000, 0xE0000))
    skipped = {*range(0xD800, 0xE000), *range(0xAC00, 0xD7A4)}.union(*ideographs)  # surrogates and what is stable as a block
    for o in range(0xE0200):
        if o in skipped:
            continue
        c = chr(o)
        cat = ud.category(c)
        if cat in ("Cn", "Co"):
            continue
        parts = ud.decomposition(c)
        if parts and parts[0] != "<":  # what can compose with a preceding starter
            trailing.update(int(x, 16) for x in parts.split()[1:])
        if _shows_nothing(o, c, cat):
            invisible[o] = None
            unstable.append(o)
        elif (c.isspace() and not c.isascii()) or c in LATIN_TWINS or c in ARABIC_TWINS or ud.combining(c) or not ud.is_normalized("NFKC", c):
            unstable.append(o)
    points = sorted({*unstable, *trailing, *range(0x1161, 0x1176), *range(0x11A8, 0x11C3)})
    return re.compile(f"[{_ranges(points)}]"), invisible, re.compile(r"\s+")


#: ASCII white space changes nothing but itself and is left to one pass over the whole text.
_SPACING = re.compile(r"^\s|\s$|\s\s|[^\S ]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]")
_ARABIC = re.compile(r"[ؠ-يٮ-ەۺ-ۿݐ-ݿ]")
_TWIN_LATIN = re.compile("[" + "".join(LATIN_TWINS) + "]")
_TWIN_ARABIC = re.compile("[" + "".join(ARABIC_TWINS) + "]")
_TO_LATIN = str.maketrans(LATIN_TWINS)
_TO_ARABIC = str.maketrans(ARABIC_TWINS)
#: A word for the look-alike rule: letters with the marks on them.
_WORD = re.compile(r"[^\W_](?:[^\W_]|[̀-ͯؐ-ؚـً-ٰٟۖ-ۭ])*")


def _own_letters(m: re.Match) -> str:
    w = m.group(0)
    if _TWIN_ARABIC.search(w):  # every twin here is of the Arabic script itself, so the word is one of it
        w = w.translate(_TO_ARABIC)
    if _TWIN_LATIN.search(w) and _LATIN.search(w):
        w = w.translate(_TO_LATIN)
    return w


def _segment(s: str) -> str:
    _, invisible, space = _tables()
    s = ud.normalize("NFKC", s.translate(invisible)).translate(invisible)
    if _TWIN_LATIN.search(s) or _TWIN_ARABIC.search(s):
        s = _WORD.sub(_own_letters, s)
    return space.sub(" ", ud.normalize("NFKC", s))


#: Certainly stable: ASCII, the Arabic letters, digits and punctuation, single vowel marks, Latin-1 letters and dashes.
_STABLE = "،؛؟ء-غـ-ْ٠-٬¡§«°¶»¿-ÿ‐‒-―‘-‟"
_MAYBE = re.compile(f"[^\x09-\x0d\x20-\x7e{_STABLE}]|[ً-ْ]{{2}}")
#: For the JVM: true for every value that may be unstable; all others are left out before any Python runs.
SUSPECT = rf"[^\x20-\x7e{_STABLE}]|[ً-ْ]{{2}}|^ | $|  "


def consistent(text: str | None) -> str | None:
    """The consistent form of one value (TESTDATA, Terms)."""
    if text is None:
        return None
    text = _spliced(text)
    return _tables()[2].sub(" ", text).strip(" ") if _SPACING.search(text) else text


def _spliced(text: str) -> str:
    """The text with its unstable segments in consistent form; white space is left as it is."""
    if not _MAYBE.search(text):
        return text
    unstable = _tables()[0]
    return " ".join(_segment(x) if _MAYBE.search(x) and unstable.search(x) else x for x in text.split(" "))


_WORDS = re.compile(r"\w+")


#: Marks that never compose: taken off first, they change no word and spare vocalised text the slow path.
_VOWELS = re.compile("[ً-ْ]+")


def words(text: str | None) -> list[str]:
    """The words of a text (TESTDATA, Terms); of null none."""
    return [] if not text else _WORDS.findall(MARKS.sub("", _spliced(_VOWELS.sub("", text)).lower()))


def may_be_unstable(c: Column) -> Column:
    return c.rlike(SUSPECT)


@F.pandas_udf(T.StringType())
def consistent_udf(values: pd.Series) -> pd.Series:
    return values.map(consistent, na_action="ignore")


def consistent_column(c: Column) -> Column:
    """The consistent form. Only values that may be unstable are changed by Python; see may_be_unstable."""
    return F.when(may_be_unstable(c), consistent_udf(c)).otherwise(c)


FIELDS = ("verses", "poet_name", "poem_title")


def field_values(records: DataFrame) -> DataFrame:
    """record_no, field, item_no, value: one row per value of the three fields, nulls left out."""
    cell = lambda field: F.array(F.struct(F.lit(field).alias("field"), F.lit(0).alias("item_no"), F.col(field).alias("value")))
    verses = F.transform(
        F.coalesce(F.col("verses"), F.array().cast("array<string>")),
        lambda v, i: F.struct(F.lit("verses").alias("field"), i.alias("item_no"), v.alias("value")),
    )
    return (
        records.select("record_no", F.explode(F.concat(verses, cell("poet_name"), cell("poem_title"))).alias("x"))
        .select("record_no", "x.field", "x.item_no", "x.value")
        .filter(F.col("value").isNotNull())
    )


def unify_values(records: DataFrame) -> DataFrame:
    """record_no, field, item_no, value, unified of every value that differs from its consistent form.

    The filter on what may be unstable runs inside the scan's stage, so stable text never leaves the JVM.
    A value that is blank (nothing visible) is no case.
    """
    suspects = field_values(records).filter(may_be_unstable(F.col("value")))
    return (
        suspects.withColumn("unified", consistent_udf("value"))
        .filter((F.col("unified") != F.col("value")) & (F.col("unified") != ""))
    )


def unify_records(records: DataFrame) -> DataFrame:
    """The records with verses, poet_name and poem_title in consistent form; all other columns as they are."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def each(lists: pd.Series) -> pd.Series:
        return lists.map(lambda xs: None if xs is None else [consistent(x) for x in xs])

    unstable = F.exists("verses", lambda v: F.coalesce(may_be_unstable(v), F.lit(False)))
    return records.withColumns({
        "verses": F.when(unstable, each("verses")).otherwise(F.col("verses")),
        "poet_name": consistent_column(F.col("poet_name")),
        "poem_title": consistent_column(F.col("poem_title")),
    })
