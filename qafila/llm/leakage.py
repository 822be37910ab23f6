"""Problem 8: passages of held-out items inside corpus documents.

Method: Wu-Manber multi-pattern search over words. The patterns are all windows of MIN_WORDS consecutive words of the
evaluation items, so all have one length. The shift table, keyed by blocks of two words, says how far the window may
move; almost everywhere it moves by the whole length. Where the shift is zero, the hash of the block selects a bucket of
patterns, the hash of the first two words (prefix check) thins it, and a direct comparison of all words confirms.

Words are compared by their 64-bit hashes, twelve of them in a row. A machine is a few flat arrays, about 30 bytes for
each word of the items, and is built without copying a pattern: windows are places in one array of words.

The evaluation items are a stated query set run against all documents, in blocks of bounded size (BLOCK_CHARS: at most
60 MB of arrays), each compiled once on the driver and sent to the executors as one broadcast. Where there are several,
the documents are turned into words once and written to the shared folder, not once a block.

Defined results: null, empty and short texts leak nothing; items of fewer than MIN_WORDS words match nothing; a passage
that several items share is reported for each of them; repeated items and documents each have their rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.llm.neardup import word_hashes
from qafila.runtime import cut, spread

MIN_WORDS = 12
#: Characters of evaluation text compiled into one pattern block.
BLOCK_CHARS = 8_000_000


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A key of every block of two neighbouring words."""
    return (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[1:] + (hashes[:-1] >> np.uint64(29)))


def _both(tail: np.ndarray, head: np.ndarray) -> np.ndarray:
    """A key of a window's last and first block."""
    return (tail * np.uint64(0xBF58476D1CE4E5B9)) ^ (head >> np.uint64(7)) ^ (head << np.uint64(57))


class WuManber:
    """Patterns of one length over word hashes."""

    def __init__(self, items: Iterable[tuple[int, str | None]], length: int = MIN_WORDS) -> None:
        self.length, self.default = length, length - 1
        parts = [(item, h) for item, h in ((item, word_hashes(text)) for item, text in items) if len(h) >= length]
        sizes = np.array([len(h) for _, h in parts], dtype=np.int64)
        self.words = np.concatenate([h for _, h in parts]) if parts else np.zeros(0, np.uint64)
        begins = np.r_[0, np.cumsum(sizes)[:-1]] if parts else np.zeros(0, np.int64)
        within = np.arange(len(self.words)) - np.repeat(begins, sizes)  # place of a word in its item
        left = np.repeat(sizes, sizes) - within
        pairs = _pairs(self.words)
        # the block at a place ends a window's word e at best; blocks across two items are none
        real = np.flatnonzero(left[:-1] > 1)
        shifts = length - np.minimum(length, within[real] + 2)
        order = np.lexsort((shifts, pairs[real]))
        keys = pairs[real][order]
        first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        self.keys, self.shift = keys[first], shifts[order][first].astype(np.int16)
        starts = np.flatnonzero(left >= length)
        tails = pairs[starts + length - 2] if len(starts) else np.zeros(0, np.uint64)
        order = np.argsort(tails, kind="stable")
        self.tails, self.starts = tails[order], starts[order].astype(np.int32)
        self.both = np.unique(_both(tails, pairs[starts])) if len(starts) else np.zeros(0, np.uint64)
        self.owner = np.repeat(np.array([item for item, _ in parts], dtype=np.int64), sizes)

    def items_in(self, words: str | np.ndarray | None) -> set[int]:
        """The items of which a text, or the hashes of its words, holds a passage."""
        return self.search([words])[0]

    def search(self, texts: list) -> list[set[int]]:
        """items_in for many texts. The shifts of all their blocks are looked up at once, and where they are zero whether
        a pattern of the bucket begins as the window does; a text without such a window holds nothing."""
        hashed = [word_hashes(t) if t is None or isinstance(t, str) else t for t in texts]
        out: list[set[int]] = [set() for _ in texts]
        flat = np.concatenate([*hashed, np.zeros(1, np.uint64)])
        if len(flat) < 2 or not len(self.keys):
            return out
        pairs = _pairs(flat)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        steps = np.where(self.keys[at] == pairs, self.shift[at], self.default)
        ends = np.cumsum([len(h) for h in hashed])
        # windows that end in a block of shift zero and begin as a pattern of its bucket does
        last = np.flatnonzero(steps == 0)
        last = last[last >= self.length - 2]
        both = _both(pairs[last], pairs[last + 2 - self.length])
        found = np.minimum(np.searchsorted(self.both, both), len(self.both) - 1)
        for i in np.unique(np.searchsorted(ends, last[self.both[found] == both], "right")).tolist():
            if i < len(hashed) and len(hashed[i]) >= self.length:
                begin = ends[i] - len(hashed[i])
                out[i] = self._walk(hashed[i], pairs[begin : ends[i] - 1], steps[begin : ends[i] - 1].tolist())
        return out

    def _walk(self, hashes: np.ndarray, pairs: np.ndarray, steps: list[int]) -> set[int]:
        found: set[int] = set()
        n, length = len(hashes), self.length
        end = length - 2  # the block that ends the window
        while end < n - 1:
            if step := steps[end]:
                end += step
                continue
            a, b = np.searchsorted(self.tails, pairs[end], "left"), np.searchsorted(self.tails, pairs[end], "right")
            begin = end + 2 - length
            for w in self.starts[a:b][self._heads(self.starts[a:b]) == pairs[begin]]:
                if (self.words[w : w + length] == hashes[begin : end + 2]).all():
                    found.add(int(self.owner[w]))
            end += 1
        return found

    def _heads(self, starts: np.ndarray) -> np.ndarray:
        x, y = self.words[starts], self.words[starts + 1]
        return (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + (x >> np.uint64(29)))


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks: its size is measured first, so that no block outgrows the bound."""
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_chars))
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    for k in range(n):
        yield [(r.item_id, r.text) for r in (items.filter(part == k) if n > 1 else items).collect()]


def _search(machine):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(values: pd.Series) -> pd.Series:
        texts = [v if v is None or isinstance(v, str) else np.asarray(v, dtype=np.int64).view(np.uint64) for v in values]
        found = []
        for i in range(0, len(texts), 256):
            found += [sorted(x) for x in machine.value.search(texts[i : i + 256])]
        return pd.Series(found, index=values.index)

    return run


@F.pandas_udf(T.ArrayType(T.LongType()))
def _hashed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: word_hashes(t).view(np.int64))


def leaked_items(docs: DataFrame, items: DataFrame, length: int = MIN_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id: every document with every item it shares a passage of at least `length` words with."""
    spark = docs.sparkSession
    texts = spread(docs.select("doc_id", F.col("text").alias("words")).filter(F.col("text").isNotNull()))
    blocks = _blocks(items.select("item_id", "text").filter(F.col("text").isNotNull()), block_chars)
    machine, rest = WuManber(next(blocks), length), next(blocks, None)
    if rest is not None:
        texts = cut(texts.select("doc_id", _hashed("words").alias("words")))
    parts = []
    while machine is not None:
        parts.append(texts.select("doc_id", F.explode(_search(spark.sparkContext.broadcast(machine))("words")).alias("item_id")))
        machine, rest = None if rest is None else WuManber(rest, length), next(blocks, None)
    return reduce(DataFrame.unionByName, parts)
