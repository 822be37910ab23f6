"""Text, hash and array expressions. All but the named UDFs stay in the JVM."""

from __future__ import annotations

import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Joins verses before hashing: the visible symbol U+241E.
VERSE_MARK = "␞"
MARKS_CLASS = "[\\u0610-\\u061a\\u064b-\\u065f\\u0670\\u06d6-\\u06ed\\u0640]"
# The meter vocabulary; the id is the position.
METERS = (
    "البسيط", "الخفيف", "الرجز", "الرمل", "السريع", "الطويل", "الكامل", "المتدارك", "المتقارب", "المجتث", "المديد",
    "المضارع", "المقتضب", "المنسرح", "النثر", "الهزج", "الوافر",
)
PROSE = "النثر"
MARK_RE = re.compile("[ؐ-ًؚ-ٰٟۖ-ۭـ]")


def poem_hash(verses: Column) -> Column:
    """Lower-case hex SHA-256 of the verses joined by U+241E; null for null."""
    return F.sha2(F.array_join(verses, VERSE_MARK), 256)


def couplet_count(verses: Column) -> Column:
    return F.floor(F.size(verses) / 2).cast("int")


def couplets(verses: Column) -> Column:
    """The lines `left = right`; [] for an empty array. Built from the array, so no line break inside a verse counts."""
    lines = F.transform(
        F.sequence(F.lit(0), F.size(verses) - 2, F.lit(2)),
        lambda i: F.concat(F.coalesce(F.get(verses, i), F.lit("")), F.lit(" = "), F.coalesce(F.get(verses, i + 1), F.lit(""))),
    )
    return F.when(F.size(verses) >= 2, lines).otherwise(F.array().cast("array<string>"))


def format_poem(verses: Column) -> Column:
    return F.array_join(couplets(verses), "\n")


def valid_verses(verses: Column) -> Column:
    return F.coalesce((F.size(verses) > 0) & (F.size(verses) % 2 == 0), F.lit(False))


def meter_name(meter_id: Column) -> Column:
    """The name of a meter id; null out of range (raise_unknown_meter raises instead)."""
    return F.get(F.array(*map(F.lit, METERS)), meter_id.cast("int"))


def raise_unknown_meter(meter_id: Column) -> Column:
    return F.coalesce(meter_name(meter_id), F.raise_error(F.concat(F.lit("Unknown meter ID: "), F.coalesce(meter_id.cast("string"), F.lit("null")))))


def hex_number(digest: Column, digits: int) -> Column:
    """The first hex digits as an exact number (up to 16 digits: unsigned 64 bits)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("decimal(20,0)")


def sft_split(sample_id: Column) -> Column:
    """Stable 98/1/1 split by the first eight hex digits."""
    bucket = F.conv(F.substring(sample_id, 1, 8), 16, 10).cast("bigint") % 100
    return F.when(bucket < 98, "train").when(bucket == 98, "validation").otherwise("test")


def corruption_count(sample_id: Column, n_couplets: Column) -> Column:
    """1 to min(3, couplets), by hash."""
    seed = hex_number(F.sha2(F.concat(F.lit("reconstruction-count:"), sample_id), 256), 16)
    return (seed % F.least(F.lit(3), n_couplets).cast("decimal(20,0)") + 1).cast("int")


def request_seed(sample_id: Column, offset: Column | int = 0) -> Column:
    return F.conv(F.substring(sample_id, 1, 8), 16, 10).cast("bigint") + offset


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    stripped = strip(c)
    return F.when(stripped != "", stripped)


def strip_marks(c: Column) -> Column:
    return F.regexp_replace(c, MARKS_CLASS, "")


def fold_alif(c: Column) -> Column:
    return F.translate(strip_marks(c), "أإآٱ", "اااا")


def grounding_words(c: Column) -> Column:
    """Distinct words of at least three characters, without marks and with alifs folded."""
    found = F.regexp_extract_all(F.lower(fold_alif(c)), F.lit(r"(?U)([\w؀-ۿ]+)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: F.length(w) >= 3))


def has_choice_label(c: Column) -> Column:
    return c.rlike(r"(?U)^\s*[\(\[]?[أبجد][\)\]\-.:：]")


def strip_code_fence(c: Column) -> Column:
    inner = F.regexp_replace(strip(c), r"(?i)(^\s*```(?:json)?\s*)|(\s*```\s*$)", "")
    return strip(inner)


def failure_category(message: Column) -> Column:
    """Ordered rules; the first that holds names the category."""
    return (
        F.when(message.contains("validation response") & message.contains("invalid"), "validator_format")
        .when(message.contains("revised_draft must exactly match"), "source_copy")
        .when(message.contains("rejected"), "semantic_rejection")
        .when(message.contains("remained invalid after repairs"), "deterministic_contract")
        .otherwise("generation_error")
    )


def request_error_class(kind: Column, status: Column) -> Column:
    """retryable, authentication or fatal for a failed request."""
    return (
        F.when(status.isin(401, 403), "authentication")
        .when(status.isin(408, 429) | (status >= 500), "retryable")
        .when(status.isNull() & kind.isin("timeout", "transport", "malformed"), "retryable")
        .otherwise("fatal")
    )


def size_stratum(n_couplets: Column, oversized: Column) -> Column:
    return (
        F.when(oversized, "oversized")
        .when(n_couplets <= 3, "couplets_1_3")
        .when(n_couplets <= 9, "couplets_4_9")
        .when(n_couplets <= 24, "couplets_10_24")
        .when(n_couplets <= 74, "couplets_25_74")
        .otherwise("couplets_75_plus")
    )


def redact(c: Column, secrets: list[str]) -> Column:
    """Every secret replaced, longest first so that one inside another does not leave a rest."""
    for s in sorted(filter(None, secrets), key=len, reverse=True):
        c = F.replace(c, F.lit(s), F.lit("[REDACTED]"))
    return c


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Seconds or an HTTP date; never below 0; null if neither."""
    date = F.try_to_timestamp(F.regexp_replace(header, "^[A-Za-z]+, ", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    seconds = F.coalesce(header.try_cast("double"), date.cast("double") - now.cast("double"))
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def back_off(attempt: Column) -> Column:
    """Without the jitter, which is not reproducible."""
    return F.least(F.pow(F.lit(2.0), attempt), F.lit(16.0))


# ---------------------------------------------------------------- what the JVM has no function for
def _collapse(s: str) -> str:
    return " ".join(s.split())


def normal_couplet_py(s: str) -> str:
    s = ud.normalize("NFC", s).strip()
    sides = s.split("=")
    return " = ".join(x.strip() for x in sides) if len(sides) == 2 else s


def normal_answer_py(s: str) -> str:
    return _collapse(ud.normalize("NFC", s).casefold())


def normal_fragment_py(s: str) -> str:
    return _collapse(ud.normalize("NFC", s))


@F.pandas_udf(T.StringType())
def normal_couplet(x: pd.Series) -> pd.Series:
    """NFC; the sides of exactly one `=` stripped and joined by ` = `."""
    return x.map(normal_couplet_py, na_action="ignore")


@F.pandas_udf(T.StringType())
def normal_answer(x: pd.Series) -> pd.Series:
    return x.map(normal_answer_py, na_action="ignore")


@F.pandas_udf(T.StringType())
def normal_fragment(x: pd.Series) -> pd.Series:
    return x.map(normal_fragment_py, na_action="ignore")
