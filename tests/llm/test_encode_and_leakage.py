import os
import random

import pytest
from pyspark.sql import functions as F

from qafila.llm import encode as E
from qafila.llm import leakage as L
from qafila.llm.unify import words

need_files = pytest.mark.skipif(not os.path.isdir(E.TOKENIZER_DIR), reason="no vocabularies")
TEXTS = ["", None, " ", "Hello world, hello!", "قال المعلم شيئا", "a" * 3000, "ههه" * 1000, "<|endoftext|> x", "é\n\n\t  x 123456", "ab" * 7 + "aaa bbb", "😀🏳️‍🌈 Песня"]


@need_files
def test_equals_the_reference_encoder():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(E.TOKENIZER_DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices("aabbc ehlo،قالم\n.,19", k=rng.randrange(200))) for _ in range(500)]
    want = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [list(map(int, x)) for x in E.load().encode_bounded(texts)] == want


@need_files
def test_round_trip_and_defined_ids(spark):
    import tiktoken

    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_chars int")
    got = {r.doc_id: list(r.ids) for r in E.corpus_ids(df).collect()}
    assert got[0] == got[1] == [] and len(got) == len(TEXTS)
    b = E.load()
    back = {rank: tok for tok, rank in _ranks().items()}
    for i, t in enumerate(TEXTS):
        assert b"".join(back[x] for x in got[i]).decode() == (t or "")
    assert tiktoken and b.keys.size and E.corpus_ids(df.filter(F.lit(False))).count() == 0


def _ranks():
    import base64

    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(os.path.join(E.TOKENIZER_DIR, "byte_bpe_50k.tiktoken"), "rb"))}


def brute(docs, items, n):
    grams = lambda t: {tuple(ws[i : i + n]) for ws in [words(t)] for i in range(len(ws) - n + 1)}
    return {(d, i) for d, t in docs for i, u in items if grams(t) & grams(u)}


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    say = lambda k: " ".join(rng.choice("ab cd ef gh ij كلمة قول".split()) for _ in range(k))
    items = [(i, say(rng.randrange(3, 40))) for i in range(25)] + [(98, None), (99, "")]
    docs = [(d, say(rng.randrange(0, 60))) for d in range(120)]
    docs += [(500 + i, say(8) + "  " + (u or "").upper().replace(" ", " ") + ". " + say(3)) for i, u in items] + [(900, None), (901, ""), (902, " ")]
    dd = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(7))
    ii = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(7))
    for n in (5, 12):
        want = brute(docs, items, n)
        got = [(r.doc_id, r.item_id) for r in L.leaked_items(dd, ii, n).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
        assert {(r.doc_id, r.item_id) for r in L.leaked_items(dd, ii, n, block_chars=500).collect()} == want
    assert L.leaked_items(dd, ii.limit(0)).count() == 0 and L.leaked_items(dd.limit(0), ii).count() == 0


def test_exact_length_and_one_less():
    m = L.WuManber([(1, " ".join(f"w{i}" for i in range(30)))])
    at = lambda n: m.items_in("x y " + " ".join(f"w{i}" for i in range(9, 9 + n)) + " z")
    assert at(12) == {1} and at(11) == set() and at(20) == {1}
