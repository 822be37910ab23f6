import itertools
import random

import pytest
from pyspark.sql import functions as F

from qafila.llm import names as M
from qafila.llm import splits as S

GIVEN = [("سالم", "Salim", "سلوم"), ("نوح", "Nuh", "أبو سام"), ("يوسف", "Yusuf", "أبو يعقوب"), ("إدريس", "Idris", "دريسو"), ("أحمد", "Ahmad", "حمودي"), ("عبدالرحيم", "Abdarrahim", "رحيمو"), ("داود", "Dawud", "أبو سليم"), ("ليلى", "Layla", "أم قيس")]
NUH = ["نوح بن يوسف الحاصذوحقي", "الحاصذوحقي، نوح", "نوح الحاصذوحقي", "نحو بن يوسف الحاصذوحقي", "الحاصذوحقي، أبو سام", "Nuh b. Yusuf Ḥaṣadhuḥaqi", "al-Ḥaṣadhuḥaqi, Nuh", "ن. الحاصذوحقي", "ن. ي. الحاصذوحقي", "نوح بن يوسف الحاصذحوقي", "الشيخ نوح بن يوسف الحاصذوحقي", "نوح ي. الحاصذوحقي", "ن​وح  ﺑﻦ يوسف الحاصذوحقي"]
OTHERS = [["سالم بن داود الحاصذوحقي", "الحاصذوحقي سالم", "د. سالم الحاصذوحقي"], ["نوح بن يوسف السكراقفي", "سلوم السكراقفي"][:1], ["رحيمو عبدالرحيم بن سالم السكراقفي", "عبد الرحيم السكراقفي", "عبداحرحيم بن سالم السكراقفي"], ["د. الغلفاضحي", "داود بن أحمد الغلفاضحي"]]


def tables(spark, groups):
    rows = [(i, n, None, None, "x") for i, (_, n) in enumerate((g, n) for g, ns in enumerate(groups) for n in ns)]
    names = spark.createDataFrame(rows or [(0, None, None, None, "x")], "name_id bigint, poet_name string, poet_era string, poet_location string, family string")
    return names if rows else names.limit(0), spark.createDataFrame(GIVEN, "given_name string, latin_form string, nickname string")


def test_variants_of_one_person(spark):
    groups = [NUH, *OTHERS]
    names, given = tables(spark, groups)
    of = [g for g, ns in enumerate(groups) for _ in ns]
    want = {(i, j) for i, j in itertools.combinations(range(len(of)), 2) if of[i] == of[j]}
    assert {(r.name_id_a, r.name_id_b) for r in M.same_person_pairs(names, given).collect()} == want
    persons = {r.name_id: r.person_id for r in M.link_names(names, given).collect()}
    assert all(persons[i] == of.index(of[i]) for i in range(len(of)))


def test_ambiguous_initials_stay_alone_unless_context_decides(spark):
    _, given = tables(spark, [])
    rows = [(1, "أحمد بن نوح السكراقفي", "e1", "القصر"), (2, "أ. السكراقفي", None, None), (3, "أ. السكراقفي", "e1", None), (4, "إ. السكراقفي", None, None), (5, "إدريس السكراقفي", "e2", None)]
    names = spark.createDataFrame(rows, "name_id bigint, poet_name string, poet_era string, poet_location string")
    got = {r.name_id: r.person_id for r in M.link_names(names, given).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_names_edges(spark):
    names, given = tables(spark, [["", " ", "مجهول", "N/A", "—", "نوح", "السكراقفي", "x" * 5000]])
    names = names.union(names.limit(1).select(F.lit(50).cast("bigint"), F.lit(None).cast("string"), "poet_era", "poet_location", "family"))
    assert M.same_person_pairs(names, given).count() == 0
    empty, _ = tables(spark, [])
    assert M.same_person_pairs(empty, given).count() == 0


def test_measures():
    assert M.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and M.jaro_winkler("", "a") == 0 and M.jaro_winkler("x", "x") == 1
    assert M.one_slip("abc", "acb") and M.one_slip("abc", "ab") and M.one_slip("abc", "xbc") and not M.one_slip("abc", "cab")
    assert M.skeleton("الحاصذوحقي") == M.skeleton("ḥaṣadhuḥaqi")


def test_comparator_and_blocks_decide(spark, monkeypatch):
    """Taking away the threshold joins two short names slipped in both parts; taking away a code parts two spellings."""
    lexicon = M.Lexicon(GIVEN)
    a, b = M.parse("لب مس", lexicon), M.parse("لج مط", lexicon)
    assert M.one_slip(a["given"], b["given"]) and M.one_slip(a["family"], b["family"]) and not M.same_person(a, b)
    whole = [M.parse(n, lexicon) for n in NUH if len(M.parse(n, lexicon)["given"]) > 1]
    assert all(M.jaro_winkler(*M.compared(x, y)) >= M.MIN_JW for x, y in itertools.combinations(whole, 2) if M.same_person(x, y))
    names, given = tables(spark, [NUH[:4] + NUH[9:10]])
    assert M.same_person_pairs(names, given).count() == 10
    monkeypatch.setattr(M, "_one_left_out", lambda code: [code])
    assert not set(M.block_keys(M.parse("سالم بنعامش", lexicon))) & set(M.block_keys(M.parse("سالم بنعامشق", lexicon)))
    monkeypatch.setattr(M, "MIN_JW", 0.0)
    assert M.same_person(a, b)


def naive(sizes, shares):
    total = sum(sizes)
    lack = {n: s * total for n, s in shares}
    order, out = [n for n, _ in shares], {}
    for s in sorted(sizes, reverse=True):
        x = max(order, key=lambda n: (lack[n], -order.index(n)))
        lack[x] -= s
        out[s, x] = out.get((s, x), 0) + 1
    return out


def test_greedy_counts_equal_the_sequential_rule():
    rng = random.Random(6)
    for shares in (S.SHARES, (("a", 0.5), ("b", 0.5)), (("a", 0.7), ("b", 0.2), ("c", 0.1)), (("a", 1.0),)):
        for _ in range(40):
            sizes = [rng.choice([1, 1, 1, 2, 3, 5, 40]) for _ in range(rng.randrange(1, 400))]
            counts = {s: sizes.count(s) for s in set(sizes)}
            got = {(s, n): k for s, runs in S.greedy_counts(counts, shares).items() for n, k in runs}
            assert got == naive(sizes, shares)


def test_related_records_stay_together(spark):
    names, given = tables(spark, [NUH, *OTHERS])
    records = spark.createDataFrame([("s1", NUH[0]), ("s2", NUH[5]), ("s3", "سالم بن داود الحاصذوحقي"), ("s4", "مجهول"), ("s5", None), ("s1", NUH[3]), (None, NUH[0])], "sample_id string, poet_name string").withColumn("name_id", F.lit(1))
    items = spark.createDataFrame([(f"{s}:{k}", s) for s in ("s1", "s2", "s3", "s4", "s5", "s9") for k in range(3)] + [("s1:0", "s1"), ("w", None)], "work_id string, sample_id string")
    got = S.split_items(items, records, names, given, (("train", 0.6), ("test", 0.4))).collect()
    assert len(got) == 20
    split = {}
    for r in got:
        assert split.setdefault(r.group_id, r.split) == r.split
    group = {r.sample_id: r.group_id for r in got}
    assert group["s1"] == group["s2"] and len({group[s] for s in ("s1", "s3", "s4", "s5", "s9", None)}) == 6
    assert {(r.sample_id, r.group_id) for r in S.poet_groups(items, records, names, given).collect()} == {("s1", 0), ("s2", 0), ("s3", len(NUH))}
    assert S.split_items(items.limit(0), records, names, given).count() == 0


def test_assignment_is_exact(spark):
    sizes = [1] * 500 + [2] * 60 + [9] * 5
    groups = spark.createDataFrame([(f"g{i}", s) for i, s in enumerate(sizes)], "component string, size bigint")
    got = S.assign_splits(groups).join(groups, "component").groupBy("size", "split").count().collect()
    assert {(r["size"], r.split): r["count"] for r in got} == naive(sizes, S.SHARES)
