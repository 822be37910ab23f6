import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qafila.llm import neardup as N

DDL = "sample_id string, verses array<string>, source_row_indices array<bigint>, source_urls array<string>"


def corpus(seed, families=25, hot=0):
    """Families of edited copies, unrelated records, and a refrain on many of them."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(400))
    refrain = [f"r{i}" for i in range(9)]
    rows = []
    for f in range(families):
        base = [word() for _ in range(rng.choice([3, 6, 12, 30, 80]))]
        for m in range(rng.randrange(1, 5)):
            ws = list(base)
            for _ in range(rng.randrange(0, max(2, len(ws) // 7))):
                i = rng.randrange(len(ws))
                ws[i : i + rng.randrange(2)] = [word()] * rng.randrange(2)
            rows.append(ws + (refrain if f < hot else []))
    rows += [refrain + [word() for _ in range(rng.randrange(2, 9))] for _ in range(hot)]
    return [(f"id{i:04}", [" ".join(ws[:5]), " ".join(ws[5:])], [i], [f"u{i}", ""]) for i, ws in enumerate(rows)]


def brute(rows):
    sets = {r[0]: frozenset(N.features(r[1]).tolist()) for r in rows}
    names = sorted(sets)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("seed, hot, bucket", [(1, 0, 64), (2, 30, 4), (3, 40, 2)])
def test_pairs_against_brute_force(spark, monkeypatch, seed, hot, bucket):
    monkeypatch.setattr(N, "BUCKET", bucket)
    monkeypatch.setattr(N, "WIDE", 3 * bucket)
    rows = corpus(seed, hot=hot)
    rows += [("copy", *rows[0][1:]), ("dirty", [rows[0][1][0].upper() + "​", " " + rows[0][1][1]], [1], [])]
    df = spark.createDataFrame(rows, DDL)
    got = [(r.sample_id_a, r.sample_id_b) for r in N.near_duplicate_pairs(df).collect()]
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10


def test_edges_and_groups(spark):
    v = ["a b c d e f", "g h i j"]
    rows = [("s1", v, [1], ["u1"]), ("s1", v, [2], ["u2", None]), ("s2", ["a b c d e f g h i", "j"], [3], None), ("s3", None, None, None), ("s4", [], [5], []), ("s5", [None, ""], [6], []), ("s6", ["one"], [7], []), (None, v, [8], []), ("s7", ["x " * 40_000], [9], [])]
    df = spark.createDataFrame(rows, DDL).withColumns({"id": F.lit("x"), "n": F.lit(1), "class": F.lit(2), "kind": F.lit("m")})
    assert [(r.sample_id_a, r.sample_id_b) for r in N.near_duplicate_pairs(df).collect()] == [("s1", "s2")]
    groups = N.near_duplicate_groups(df)
    got = {r.sample_id: r for r in groups.collect()}
    assert set(got) == {f"s{i}" for i in range(1, 8)}
    assert got["s2"].group_id == got["s1"].group_id == "s1" and got["s3"].group_id == "s3" and got["s3"].links == 0
    sources = {(r.group_id, r.source_row_index, r.source_url) for r in N.group_sources(df, groups).collect()}
    assert {(i, u) for g, i, u in sources if g == "s1"} == {(1, None), (2, None), (3, None), (None, "u1"), (None, "u2")}
    assert not any(g == "s3" for g, _, _ in sources) and ("s7", 9, None) in sources
    assert N.near_duplicate_pairs(df.limit(0)).count() == 0 and N.near_duplicate_groups(df.limit(0)).count() == 0


def similar_sets(rng, rounds):
    for _ in range(rounds):
        n = int(rng.choice([rng.integers(1, 40), rng.integers(1, 150), rng.integers(1, 900)]))
        a = np.unique(rng.integers(0, 1 << 60, n))
        keep = rng.random(len(a)) < rng.uniform(0.7, 1.0)
        b = np.unique(np.r_[a[keep], rng.integers(0, 1 << 60, int(rng.integers(0, 1 + n // 4)))])
        common = len(np.intersect1d(a, b))
        if len(b) and common >= 0.6 * (len(a) + len(b) - common):
            yield a, b


@pytest.mark.parametrize("n2, k2", [(3, 1), (2, 1), (4, 2)])
def test_similar_sets_share_a_signature(monkeypatch, n2, k2):
    """The guarantee itself, for sets of all sizes and several enumerations."""
    monkeypatch.setattr(N, "N2", n2)
    monkeypatch.setattr(N, "K2", k2)
    seen = 0
    for a, b in similar_sets(np.random.default_rng(7), 900):
        sig, who = N.signatures([a, b])
        shared = np.intersect1d(sig[who == 0], sig[who == 1])
        assert (N.WHOLE // (shared & np.uint64(15)).astype(int)).sum() >= N.WHOLE
        assert len(np.unique(sig[who == 0])) == (who == 0).sum()
        seen += 1
    assert seen > 300


def test_signatures_do_not_depend_on_the_corpus():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 60, int(rng.integers(1, 300)))) for _ in range(50)]
    sig, who = N.signatures(sets)
    alone = N.signatures([sets[9]])[0]
    assert sorted(sig[who == 9].tolist()) == sorted(alone.tolist()) and len(sig) < 2.5 * sum(map(len, sets))


def test_the_enumeration_decides(monkeypatch):
    """In one part sets that differ by one feature meet through the subsets, and no more when they are taken away."""
    monkeypatch.setattr(N, "PER_PART", 1e9)
    monkeypatch.setattr(N, "_pair_signatures", lambda f, g: np.zeros(0, np.uint64))
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 60, 40)) for _ in range(50)]
    pairs = [(a, np.unique(np.r_[a[1:], rng.integers(0, 1 << 60, 1)])) for a in sets]
    met = lambda: [np.intersect1d(*(N.signatures([s])[0] for s in p)).size > 0 for p in pairs]
    some = sum(met())
    real = N.enumeration(N.N2, N.K2)
    monkeypatch.setattr(N, "enumeration", lambda n2, k2: ([tuple(range(n2))], real[1].any(axis=1, keepdims=True), real[2]))
    assert some > 10 and not any(met())


def test_packing_round_trip():
    x = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 1000)).astype(np.uint64)
    assert (N._unplanes(N._planes(x, 5), 5) == x).all() and len(N._unplanes(b"", 3)) == 0
