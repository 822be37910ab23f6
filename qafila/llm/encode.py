"""Problem 7: the whole corpus as token ids of a public byte-level BPE vocabulary.

Method: batched numpy merge rounds. The words of an Arrow batch are made distinct, their bytes lie in one flat array
of symbols with the word of each; in every round the rank of each neighbouring pair is found by binary search over
the sorted pair keys, the lowest-ranked pair of every word is merged wherever it occurs (left to right, without
overlap), and words that have no pair left drop out. Words are cut by the vocabulary's published pattern.

Defined results: the ids of an empty and of a null text are an empty list; special tokens are never produced, their
strings are ordinary text. Extra columns are carried along. Row-local: the only exchange spreads the input.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qafila.runtime import spread

#: Where the vocabularies lie; a parameter, never copied into the repository.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
DEFAULT = "byte_bpe_50k"
#: Texts are worked through in groups of about so many characters, so that a batch of very long texts stays small.
GROUP_CHARS = 2_000_000
#: Words kept with their ids per Python worker; beyond it the store starts anew. Bounds memory, never the result.
KEPT_WORDS = 200_000
_NONE = np.iinfo(np.int64).max


class ByteBPE:
    """A rank table turned into sorted pair keys for binary search."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        ranks: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, out = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    out.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(out, dtype=np.int64)[order]
        self.kept: dict[str, np.ndarray] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        done: list[np.ndarray | None] = [None] * len(pieces)
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols = self.byte_ids[flat]
        word = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        while len(symbols):
            same = word[1:] == word[:-1]
            rank = np.full(len(symbols), _NONE)
            rank[:-1][same] = self._rank(symbols[:-1][same], symbols[1:][same])
            starts = np.flatnonzero(np.r_[True, ~same])
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(symbols)])
            over = best == _NONE
            if over.any():  # words without a pair left are finished
                for k in np.flatnonzero(over):
                    done[word[starts[k]]] = symbols[starts[k] : starts[k] + lengths[k]].astype(np.int32)
                keep = np.repeat(~over, lengths)
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                best, lengths = best[~over], lengths[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            # of runs of overlapping hits (a a a) only every other one merges, counted from the left
            run = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1
            first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            symbols[at] = rank[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        return [np.zeros(0, dtype=np.int32) if d is None else d for d in done]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        new = list({w for ws in cut for w in ws if w not in self.kept})
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.kept = {}
            new = list({w for ws in cut for w in ws})
        self.kept.update(zip(new, self.merge([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
        empty = np.zeros(0, dtype=np.int32)
        return [np.concatenate([self.kept[w] for w in ws]) if ws else empty for ws in cut]

    def encode_bounded(self, texts: list[str | None]) -> list[np.ndarray]:
        out, group, size = [], [], 0
        for t in texts:
            group.append(t)
            size += len(t or "")
            if size >= GROUP_CHARS:
                out += self.encode(group)
                group, size = [], 0
        return out + self.encode(group)


@lru_cache(maxsize=4)
def load(name: str = DEFAULT, folder: str = TOKENIZER_DIR) -> ByteBPE:
    spec = importlib.util.spec_from_file_location("_tokenizer_files", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return ByteBPE(os.path.join(folder, f"{name}.tiktoken"), module.PATTERN)


def encode_corpus(docs: DataFrame, text: str = "text", out: str = "ids", name: str = DEFAULT, folder: str = TOKENIZER_DIR) -> DataFrame:
    """docs with a column of token ids."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(load(name, folder).encode_bounded(texts.tolist()))

    return docs.withColumn(out, run(F.col(text)))


def corpus_ids(docs: DataFrame, name: str = DEFAULT) -> DataFrame:
    return encode_corpus(spread(docs.select("doc_id", "text")), name=name).select("doc_id", "ids")
