"""Choices seeded by a hash and drawn from the Mersenne Twister; Arrow-batched, as the JVM has no such generator."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = ("أ", "ب", "ج", "د")


def _rng(text: str, digits: int | None = 16) -> random.Random:
    digest = hashlib.sha256(text.encode()).hexdigest()
    return random.Random(int(digest[:digits] if digits else digest, 16))


def prompt_index_py(sample_id: str, template_id: str, n: int = 5) -> int:
    return _rng(f"mcq-prompt:{sample_id}:{template_id}").choice(range(n))


def choice_order_py(work_id: str, answers: list[str]) -> list[dict]:
    """The correct answer comes first in; out come labelled choices in seeded order."""
    order = [(a, i == 0) for i, a in enumerate(answers)]
    _rng(f"mcq-order:{work_id}").shuffle(order)
    return [{"label": label, "text": a, "correct": ok} for label, (a, ok) in zip(LABELS, order, strict=False)]


def prefix_length_py(sample_id: str, n_couplets: int) -> int | None:
    return _rng(f"poem-completion:v2:{sample_id}", None).randrange(1, n_couplets) if n_couplets >= 2 else None


@F.pandas_udf(T.IntegerType())
def prompt_index(sample_id: pd.Series, template_id: pd.Series) -> pd.Series:
    """0-based index of the prompt of a work item; null for null keys."""
    return pd.Series([None if s is None or t is None else prompt_index_py(s, t) for s, t in zip(sample_id, template_id, strict=True)], dtype="Int32")


_CHOICES = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType()), T.StructField("correct", T.BooleanType())]))


@F.pandas_udf(_CHOICES)
def choice_order(work_id: pd.Series, answers: pd.Series) -> pd.Series:
    return pd.Series([None if w is None or a is None else choice_order_py(w, list(a)) for w, a in zip(work_id, answers, strict=True)])


@F.pandas_udf(T.IntegerType())
def prefix_length(sample_id: pd.Series, n_couplets: pd.Series) -> pd.Series:
    """Couplets given away at the beginning; null where fewer than two."""
    return pd.Series([None if s is None or pd.isna(n) else prefix_length_py(s, int(n)) for s, n in zip(sample_id, n_couplets, strict=True)], dtype="Int32")
