"""Problem 4: cutting oversized poems at natural boundaries, with a stated overlap.

Method: a sparse table answers range-maximum queries over boundary strengths. For each piece the strongest cut within
the permissible length window is asked for, ties broken rightward; the next piece starts before the cut by the couplets
to be repeated.

Strengths: couplet end 4, between the hemistichs 3, white space or punctuation 2, between two letters 1, inside a
letter with its marks 0 (taken only where nothing else fits). The window of a piece that starts at a with c characters
allowed is (last cut, a + c], so every piece brings new text. Of the wanted couplets as many are repeated as leave at
least one new character beside them: a repeat that would fill the whole piece is shortened to fewer couplets, at last
none. After a cut inside a couplet the repeat starts at the beginning of the couplets last begun.

Defined results: a text at the limit or under it is not cut; a null max_source_chars is no limit; null verses make no
text; a null hemistich counts as empty and a hemistich without partner stands alone on its line; repeated records give
repeated pieces (they are keyed by record_no). A chunk_chars under 1 or null leaves the text whole. Extra columns are
ignored.
"""

from __future__ import annotations

import unicodedata as ud

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.runtime import spread

#: generation_settings is a parameter table; more rows than this are refused, not dropped.
MAX_SETTINGS = 10_000


def poem_text(verses: Column) -> Column:
    """Couplets `left = right` joined by newlines, from the verses as stored."""
    safe = F.transform(verses, lambda v: F.coalesce(v, F.lit("")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(verses) - 1, F.lit(2)),
        lambda i: F.concat_ws(" = ", F.slice(safe, i + 1, F.lit(2))),
    )
    return F.when(F.size(verses) > 0, F.array_join(pairs, "\n"))


class RangeMaximum:
    """Sparse table over strengths; of equal strengths the rightmost position wins.

    Levels reach to the widest window that is asked for (4 bytes for each position and level).
    """

    def __init__(self, strengths: np.ndarray, widest: int | None = None) -> None:
        self.s = strengths
        self.rows = [np.arange(len(strengths), dtype=np.int32)]
        width, most = 1, min(len(strengths), widest or len(strengths))
        while 2 * width <= most:
            left, right = self.rows[-1][:-width], self.rows[-1][width:]
            self.rows.append(np.where(strengths[right] >= strengths[left], right, left))
            width *= 2

    def query(self, a: int, b: int) -> int:
        """The position of the maximum in [a, b]."""
        k = (b - a + 1).bit_length() - 1
        left, right = int(self.rows[k][a]), int(self.rows[k][b - (1 << k) + 1])
        return right if self.s[right] >= self.s[left] else left


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def strengths_of(text: str) -> np.ndarray:
    """strength[i]: of a cut before position i."""
    code = _codes(text)
    out = np.ones(len(code) + 1, dtype=np.int8)
    different, which = np.unique(code, return_inverse=True)
    kinds = np.array([(2 if chr(c).isspace() or ud.category(chr(c))[0] == "P" else 0 if ud.combining(chr(c)) or chr(c) in "‍️" else 1) for c in different.tolist()], dtype=np.int8)
    kind = kinds[which]
    out[1:][kind == 2] = 2
    out[:-1][kind == 0] = 0
    at = text.find(" = ")
    while at >= 0:
        out[at + 3] = 3
        at = text.find(" = ", at + 1)
    out[1:][code == 10] = 4
    out[-1] = 5
    return out


def cut_points(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces; end excludes the newline it may be followed by."""
    n = len(text)
    if chunk is None or chunk < 1 or n <= chunk:
        return [(0, n)]
    index = RangeMaximum(strengths_of(text), chunk + 1)
    heads = np.r_[0, np.flatnonzero(_codes(text) == 10) + 1]  # where couplets begin
    out, start, done = [], 0, 0
    while True:
        # a newline at the cut is not part of the piece, so the window may reach one further onto it
        room = start + chunk
        high = min(n, room + 1 if room < n and text[room] == "\n" else room)
        cut = n if n <= room else index.query(done + 1, high)
        end = cut - 1 if cut < n and text[cut - 1] == "\n" and cut - 1 > start else cut
        out.append((start, end))
        if cut >= n:
            return out
        begun = int(np.searchsorted(heads, cut, side="left"))  # couplets begun before the cut
        start = cut
        for k in range(min(overlap, begun), 0, -1):
            back = int(heads[begun - k])
            if cut - back < chunk and back > out[-1][0]:
                start = back
                break
        done = cut


def _settings(settings: DataFrame) -> list:
    rows = settings.select("settings_id", "max_source_chars", "chunk_chars", "overlap_couplets").filter(F.col("max_source_chars").isNotNull()).limit(MAX_SETTINGS + 1).collect()
    if len(rows) > MAX_SETTINGS:
        raise ValueError(f"more than {MAX_SETTINGS} generation settings")
    return rows


def oversized(records: DataFrame, settings: DataFrame) -> DataFrame:
    """The records' texts with each setting whose limit they exceed. No join: the few settings are literals."""
    rows = _settings(settings)
    kind = "array<struct<settings_id:int,max_source_chars:int,chunk_chars:int,overlap_couplets:int>>"
    limits = F.array(*(F.struct(*(F.lit(v).cast("int").alias(k) for k, v in r.asDict().items())) for r in rows)).cast(kind) if rows else F.array().cast(kind)
    return (
        records.select("record_no", "sample_id", poem_text(F.col("verses")).alias("poem_text"))
        .withColumn("s", F.explode(F.filter(limits, lambda s: F.length("poem_text") > s.max_source_chars)))
        .select("record_no", "sample_id", "poem_text", "s.*")
    )


_PIECES = T.ArrayType(T.StructType([T.StructField("start_pos", T.IntegerType()), T.StructField("piece_text", T.StringType())]))


def cut_records(records: DataFrame, settings: DataFrame) -> DataFrame:
    """record_no, sample_id, settings_id, piece_no, start_pos, piece_text of every oversized record."""

    @F.pandas_udf(_PIECES)
    def run(texts: pd.Series, chunk: pd.Series, overlap: pd.Series) -> pd.Series:
        def one(t, c, o):
            spans = cut_points(t, 0 if pd.isna(c) else int(c), 0 if pd.isna(o) else int(o))
            return [{"start_pos": a, "piece_text": t[a:b]} for a, b in spans]

        return pd.Series([one(*x) for x in zip(texts, chunk, overlap, strict=True)])

    big = spread(oversized(records, settings))
    return big.select("record_no", "sample_id", "settings_id", F.posexplode(run("poem_text", "chunk_chars", "overlap_couplets")).alias("piece_no", "p")).select(
        "record_no", "sample_id", "settings_id", "piece_no", "p.start_pos", "p.piece_text"
    )


def oversized_ids(records: DataFrame, settings: DataFrame) -> DataFrame:
    """sample_id, settings_id of every record that was cut: those with pieces, by the operator's own output."""
    return cut_records(records, settings).filter(F.col("piece_no") == 0).select("sample_id", "settings_id").distinct()
