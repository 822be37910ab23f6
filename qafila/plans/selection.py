"""Selection, expansion and chunking over poem_records and mcq_items."""

from __future__ import annotations

from pyspark.sql import functions as F

from qafila.functions import seeded
from qafila.functions import text as X
from qafila.operators import selection as S
from qafila.runtime import table

CAP, LIMIT, OVERSIZE, CHUNK = 24, 40, 1800, 600
QUOTAS = {"couplets_1_3": 20, "couplets_4_9": 10, "couplets_10_24": 8, "couplets_25_74": 5, "oversized": 4}


def poems(spark, d):
    """The last load of every record."""
    return S.measured(S.latest(table(spark, d, "poem_records"), "sample_id", "loaded_at", "record_no"))


def latest_records(spark, d):
    return poems(spark, d).select("sample_id", "record_no", "poet_name", "poem_title")


def couplet_cap(spark, d):
    return poems(spark, d).agg(F.count_if(F.col("couplet_count") <= CAP).alias("kept"), F.count_if(F.col("couplet_count") > CAP).alias("excluded"))


def cap_then_limit(spark, d):
    return S.cap_then_limit(poems(spark, d), CAP, LIMIT, "record_no").select("sample_id", "record_no", "couplet_count")


def oversize_guard(spark, d):
    return poems(spark, d).filter(F.length("poem_text") > OVERSIZE).select("sample_id", F.length("poem_text").cast("bigint").alias("n_chars"))


def completion_eligible(spark, d):
    return poems(spark, d).filter("couplet_count >= 2").select("sample_id", "couplet_count")


def selected_ids(spark, d):
    """Semi-join on a chosen id set (the probe poems and the poems asked about) and what of it is missing."""
    chosen = table(spark, d, "probe_poems").select("sample_id").union(table(spark, d, "mcq_items").select("sample_id")).distinct()
    have = poems(spark, d).select("sample_id")
    found = have.join(chosen, "sample_id", "left_semi").withColumn("state", F.lit("found"))
    return found.union(chosen.join(have, "sample_id", "left_anti").withColumn("state", F.lit("missing")))


def mcq_work_items(spark, d):
    return S.work_items(poems(spark, d)).select("work_id", "sample_id", "template_id", "ground_truth")


def mcq_prompts(spark, d):
    return S.with_prompt(S.work_items(poems(spark, d))).select("work_id", "prompt_no")


def corruption_counts(spark, d):
    return poems(spark, d).select("sample_id", X.corruption_count(F.col("sample_id"), F.col("couplet_count")).alias("corruption_count"))


def request_seeds(spark, d):
    s = F.col("sample_id")
    return poems(spark, d).select("sample_id", X.request_seed(s).alias("seed"), X.request_seed(s, 10_000 + 3 * 100).alias("chunk_seed"), X.request_seed(s, 100_000).alias("judge_seed"))


def completion_prefix(spark, d):
    k = seeded.prefix_length("sample_id", "couplet_count")
    given = poems(spark, d).filter("couplet_count >= 2").withColumn("k", k)
    return given.select("sample_id", F.col("k").alias("provided"), F.array_join(F.slice(X.couplets(F.col("verses")), 1, F.col("k")), "\n").alias("beginning"))


def estimate_work(spark, d):
    return S.estimate(poems(spark, d), OVERSIZE, CHUNK).select("sample_id", "generation", "mcq", "reconstruction")


def spt_schedule(spark, d):
    return S.ranked(S.estimate(poems(spark, d), OVERSIZE, CHUNK).select("sample_id", "generation"), "generation", "sample_id").select("sample_id", "generation", F.col("rank").cast("bigint").alias("rank"))


def couplet_explode(spark, d):
    rows = poems(spark, d).select("sample_id", F.posexplode(X.couplets(F.col("verses"))).alias("pos", "couplet"))
    return rows.select("sample_id", (F.col("pos") + 1).alias("couplet_no"), F.sha2("couplet", 256).alias("digest"))


def three_couplet_chunks(spark, d):
    """Chunks of three couplets with the couplets before and after; neighbours by index, no window."""
    p = poems(spark, d).withColumn("lines", X.couplets(F.col("verses"))).filter(F.size("lines") > 0)
    rows = p.select("sample_id", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - 1, F.lit(3))).alias("start"))
    return rows.select(
        "sample_id", "start", F.size(F.slice("lines", F.col("start") + 1, 3)).alias("n"),
        F.get("lines", F.col("start") - 1).alias("before"), F.get("lines", F.col("start") + 3).alias("after"),
    )


def offset_chunks(spark, d):
    """Three-couplet chunks of what comes after the first couplets, as many as the record number says."""
    p = poems(spark, d).select("sample_id", F.explode(S.couplet_chunks(X.couplets(F.col("verses")), (F.col("record_no") % 4).cast("int"))).alias("c"))
    return p.select("sample_id", "c.start", F.size("c.couplets").alias("n"), F.sha2(F.concat_ws("|", "c.before", "c.after"), 256).alias("neighbours"), "c.first")


def packed_chunks(spark, d):
    rows = poems(spark, d).select("sample_id", F.posexplode(S.packed_chunks(X.couplets(F.col("verses")), CHUNK)).alias("pos", "chunk"))
    return rows.select("sample_id", (F.col("pos") + 1).alias("chunk_no"), F.length("chunk").cast("bigint").alias("n_chars"), F.sha2("chunk", 256).alias("digest"))


def contiguous_indices(spark, d):
    """Whether the couplet numbers gathered from exploded rows are 1..n without a gap."""
    rows = poems(spark, d).select("sample_id", "couplet_count", F.posexplode(X.couplets(F.col("verses"))).alias("pos", "couplet"))
    got = rows.groupBy("sample_id", "couplet_count").agg(F.array_sort(F.collect_list(F.col("pos") + 1)).alias("numbers"))
    return got.select("sample_id", (F.col("numbers") == F.sequence(F.lit(1), F.col("couplet_count"))).alias("contiguous"))


def _strata(spark, d):
    p = poems(spark, d)
    return p.withColumn("stratum", X.size_stratum(F.col("couplet_count"), F.length("poem_text") > OVERSIZE)).select("sample_id", "record_no", "stratum", F.length("poem_text").alias("n_chars"))


def pilot_strata(spark, d):
    return _strata(spark, d).groupBy("stratum").agg(F.count("*").alias("n"))


def pilot_selection(spark, d):
    """Quotas per stratum by id; of the oversized the longest comes first, of equal ones the first in source order."""
    rows = _strata(spark, d)
    usual = {k: v for k, v in QUOTAS.items() if k != "oversized"}
    plain = S.first_per_stratum(rows, "stratum", usual, "sample_id")
    big = rows.filter("stratum = 'oversized'")
    top = big.agg(F.max_by("sample_id", F.struct("n_chars", -F.col("record_no"))).alias("top"))
    marked = big.join(F.broadcast(top), big.sample_id == top.top, "left").withColumn("later", F.col("top").isNull())
    oversized = S.first_per_stratum(marked.drop("top"), "stratum", {"oversized": QUOTAS["oversized"]}, "later", "sample_id")
    return plain.select("sample_id", "stratum", "stratum_rank").unionByName(oversized.select("sample_id", "stratum", "stratum_rank"))


def pilot_shortfall(spark, d):
    return S.shortfalls(_strata(spark, d), "stratum", {**QUOTAS, "couplets_75_plus": 15}).select("stratum", F.col("quota").cast("bigint").alias("quota"), "have")


def fixture_choices(spark, d):
    """Four poems of each size bucket by id, and the four longest."""
    p = poems(spark, d).withColumn("bucket", X.size_stratum(F.col("couplet_count"), F.lit(False)))
    names = {x: 4 for x in ("couplets_1_3", "couplets_4_9", "couplets_10_24", "couplets_25_74", "couplets_75_plus")}
    chosen = S.first_per_stratum(p.select("sample_id", "bucket"), "bucket", names, "sample_id").select("sample_id", "bucket")
    longest = p.orderBy(F.desc(F.length("poem_text")), "sample_id").limit(4).select("sample_id", F.lit("longest").alias("bucket"))
    return chosen.union(longest)


def fixture_mix(spark, d):
    """80 requests: 8 and 8 instructions with their checks, 32 and 32 reasoning chunks with theirs; poems reused in turn."""
    chosen = fixture_choices(spark, d).filter("bucket <> 'longest'")
    order = F.array_sort(F.collect_list(F.struct("bucket", "sample_id")))
    bank = chosen.agg(order.alias("bank"))  # at most 20 rows by the quotas
    kind = F.expr("case when i < 8 then 'instruction' when i < 16 then 'instruction_validation' when i < 48 then 'reasoning' else 'reasoning_validation' end")
    at = F.expr("case when i < 8 then i when i < 16 then i - 8 when i < 48 then i - 16 else i - 48 end")
    both = bank.select("bank", F.explode(F.sequence(F.lit(0), F.lit(79))).alias("i")).withColumns({"kind": kind, "turn": at})
    return both.select(F.col("i").cast("bigint").alias("i"), "kind", F.get("bank", F.expr("cast(turn % size(bank) as int)"))["sample_id"].alias("sample_id"))


def levels(spark, d):
    """Concurrency levels up to the ceiling of each setting's repairs, the ceiling appended, without repeats."""
    base = F.array(*map(F.lit, (1, 2, 4, 8, 16, 24, 32)))
    ceiling = F.col("max_repairs") * 5 + 1
    s = table(spark, d, "generation_settings")
    return s.select("settings_id", F.explode(F.array_distinct(F.concat(F.filter(base, lambda x: x <= ceiling), F.array(ceiling)))).alias("level"))


def field_hiding(spark, d):
    """Public projection of every verse."""
    rows = poems(spark, d).select("sample_id", F.transform("verses", lambda v, i: F.struct(i.alias("i"), v.alias("text"), (i % 2 == 0).alias("first"))).alias("parts"))
    return rows.select("sample_id", F.to_json(F.transform("parts", lambda p: p.dropFields("text"))).alias("public"))


QUERIES = {f.__name__: f for f in (
    latest_records, couplet_cap, cap_then_limit, oversize_guard, completion_eligible, selected_ids, mcq_work_items, mcq_prompts, corruption_counts, request_seeds,
    completion_prefix, estimate_work, spt_schedule, couplet_explode, three_couplet_chunks, offset_chunks, packed_chunks, contiguous_indices, pilot_strata, pilot_selection, pilot_shortfall,
    fixture_choices, fixture_mix, levels, field_hiding, 
)}

P = """p0 AS (SELECT sample_id, max(struct_pack(a := loaded_at, b := record_no)) AS k FROM poem_records GROUP BY 1),
  p AS (SELECT r.*, CAST(len(verses) // 2 AS INT) AS couplet_count,
      array_to_string(list_transform(range(0, CAST(len(verses) AS BIGINT) - 1, 2), lambda i: verses[i + 1] || ' = ' || verses[i + 2]), chr(10)) AS poem_text,
      list_transform(range(0, CAST(len(verses) AS BIGINT) - 1, 2), lambda i: verses[i + 1] || ' = ' || verses[i + 2]) AS lines
    FROM poem_records r JOIN p0 ON r.sample_id = p0.sample_id AND r.loaded_at = p0.k.a AND r.record_no = p0.k.b)"""
_STRATUM = f"CASE WHEN length(poem_text) > {OVERSIZE} THEN 'oversized' ELSE %s END"
_BUCKET = "CASE WHEN couplet_count <= 3 THEN 'couplets_1_3' WHEN couplet_count <= 9 THEN 'couplets_4_9' WHEN couplet_count <= 24 THEN 'couplets_10_24' WHEN couplet_count <= 74 THEN 'couplets_25_74' ELSE 'couplets_75_plus' END"
_STRATUM = _STRATUM % _BUCKET
_STRIP = lambda c: f"nullif(regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), '')"
ITEMS = " UNION ALL ".join(f"SELECT sample_id, '{t}' AS template_id, {_STRIP(c)} AS ground_truth FROM p" for t, c in S.TEMPLATES)
#: Greedy packing, one couplet at a time.
PACK = f"""WITH RECURSIVE {P},
  walk AS (
    SELECT sample_id, lines, 1 AS i, 1 AS chunk_no, lines[1] AS chunk FROM p WHERE len(lines) > 0
    UNION ALL
    SELECT sample_id, lines, i + 1, CASE WHEN length(chunk) + 1 + length(lines[i + 1]) <= {CHUNK} THEN chunk_no ELSE chunk_no + 1 END,
      CASE WHEN length(chunk) + 1 + length(lines[i + 1]) <= {CHUNK} THEN chunk || chr(10) || lines[i + 1] ELSE lines[i + 1] END
    FROM walk WHERE i < len(lines)),
  packed AS (SELECT sample_id, chunk_no, arg_max(chunk, i) AS chunk FROM walk GROUP BY 1, 2)"""
ESTIMATE = f"""{PACK}, parts AS (SELECT sample_id, count(*) AS chunks FROM packed GROUP BY 1),
  est AS (SELECT p.sample_id, CAST(2 + 2 * ceil(couplet_count / 3.0) + CASE WHEN length(poem_text) > {OVERSIZE} THEN coalesce(chunks, 0) ELSE 0 END AS BIGINT) AS generation
    FROM p LEFT JOIN parts ON p.sample_id = parts.sample_id)"""
_CHOICES = f"""choices AS (
    SELECT sample_id, bucket FROM (SELECT sample_id, {_BUCKET} AS bucket, row_number() OVER (PARTITION BY {_BUCKET} ORDER BY sample_id) AS r FROM p) WHERE r <= 4)"""

SQL = {
    "latest_records": f"WITH {P} SELECT sample_id, record_no, poet_name, poem_title FROM p",
    "couplet_cap": f"WITH {P} SELECT count(*) FILTER (couplet_count <= {CAP}) AS kept, count(*) FILTER (couplet_count > {CAP}) AS excluded FROM p",
    "cap_then_limit": f"WITH {P} SELECT sample_id, record_no, couplet_count FROM p WHERE couplet_count <= {CAP} ORDER BY record_no LIMIT {LIMIT}",
    "oversize_guard": f"WITH {P} SELECT sample_id, length(poem_text) AS n_chars FROM p WHERE length(poem_text) > {OVERSIZE}",
    "completion_eligible": f"WITH {P} SELECT sample_id, couplet_count FROM p WHERE couplet_count >= 2",
    "selected_ids": f"WITH {P}, c AS (SELECT sample_id FROM probe_poems UNION SELECT sample_id FROM mcq_items) SELECT c.sample_id, CASE WHEN p.sample_id IS NULL THEN 'missing' ELSE 'found' END AS state FROM c LEFT JOIN p ON c.sample_id = p.sample_id",
    "mcq_work_items": f"WITH {P}, items AS ({ITEMS}) SELECT 'mcq:' || sample_id || ':' || template_id AS work_id, sample_id, template_id, ground_truth FROM items WHERE ground_truth IS NOT NULL",
    "corruption_counts": f"WITH {P} SELECT sample_id, CAST(('0x' || substr(sha256('reconstruction-count:' || sample_id), 1, 16))::UBIGINT % least(3, couplet_count) + 1 AS INT) AS corruption_count FROM p",
    "request_seeds": f"WITH {P}, s AS (SELECT sample_id, CAST(('0x' || substr(sample_id, 1, 8))::UBIGINT AS BIGINT) AS seed FROM p) SELECT sample_id, seed, seed + 10300 AS chunk_seed, seed + 100000 AS judge_seed FROM s",
    "estimate_work": f"{ESTIMATE} SELECT sample_id, generation, CAST(2 AS BIGINT) AS mcq, CAST(2 AS BIGINT) AS reconstruction FROM est",
    "spt_schedule": f"{ESTIMATE} SELECT sample_id, generation, row_number() OVER (ORDER BY generation, sample_id) AS rank FROM est",
    "couplet_explode": f"WITH {P} SELECT sample_id, CAST(n AS INT) AS couplet_no, sha256(lines[n]) AS digest FROM (SELECT sample_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM p)",
    "three_couplet_chunks": f"WITH {P} SELECT sample_id, CAST(s AS INT) AS start, CAST(least(3, len(lines) - s) AS INT) AS n, CASE WHEN s > 0 THEN lines[s] END AS before, CASE WHEN s + 4 <= len(lines) THEN lines[s + 4] END AS after FROM (SELECT sample_id, lines, unnest(range(0, len(lines), 3)) AS s FROM p)",
    "offset_chunks": f"WITH {P}, c AS (SELECT sample_id, lines, record_no % 4 AS o, unnest(range(record_no % 4, len(lines), 3)) AS s FROM p) SELECT sample_id, CAST(s AS INT) AS start, CAST(least(3, len(lines) - s) AS INT) AS n, sha256(concat_ws('|', CASE WHEN s > 0 THEN lines[s] END, CASE WHEN s + 4 <= len(lines) THEN lines[s + 4] END)) AS neighbours, s = o AS first FROM c",
    "packed_chunks": f"{PACK} SELECT sample_id, CAST(chunk_no AS INT) AS chunk_no, length(chunk) AS n_chars, sha256(chunk) AS digest FROM packed",
    "contiguous_indices": f"WITH {P} SELECT sample_id, true AS contiguous FROM p WHERE couplet_count > 0",
    "pilot_strata": f"WITH {P} SELECT {_STRATUM} AS stratum, count(*) AS n FROM p GROUP BY 1",
    "pilot_selection": f"""WITH {P}, s AS (SELECT sample_id, record_no, {_STRATUM} AS stratum, length(poem_text) AS n_chars FROM p),
        top AS (SELECT sample_id AS id FROM s WHERE stratum = 'oversized' ORDER BY n_chars DESC, record_no LIMIT 1),
        r AS (SELECT sample_id, stratum, CAST(row_number() OVER (PARTITION BY stratum ORDER BY CASE WHEN stratum = 'oversized' AND sample_id = (SELECT id FROM top) THEN 0 ELSE 1 END, sample_id) AS INT) AS stratum_rank FROM s)
        SELECT sample_id, stratum, stratum_rank FROM r WHERE stratum_rank <= CASE stratum {" ".join(f"WHEN '{k}' THEN {v}" for k, v in QUOTAS.items())} ELSE 0 END""",
    "pilot_shortfall": f"""WITH {P}, q AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v})" for k, v in {**QUOTAS, "couplets_75_plus": 15}.items())}) AS t(stratum, quota)),
        h AS (SELECT {_STRATUM} AS stratum, count(*) AS n FROM p GROUP BY 1)
        SELECT q.stratum, CAST(quota AS BIGINT) AS quota, coalesce(n, 0) AS have FROM q LEFT JOIN h ON q.stratum = h.stratum WHERE coalesce(n, 0) < quota""",
    "fixture_choices": f"WITH {P}, {_CHOICES} SELECT sample_id, bucket FROM choices UNION ALL SELECT * FROM (SELECT sample_id, 'longest' AS bucket FROM p ORDER BY length(poem_text) DESC, sample_id LIMIT 4)",
    "fixture_mix": f"""WITH {P}, {_CHOICES}, bank AS (SELECT sample_id, row_number() OVER (ORDER BY bucket, sample_id) - 1 AS k, count(*) OVER () AS n FROM choices),
        seats AS (SELECT i, CASE WHEN i < 8 THEN 'instruction' WHEN i < 16 THEN 'instruction_validation' WHEN i < 48 THEN 'reasoning' ELSE 'reasoning_validation' END AS kind,
          CASE WHEN i < 8 THEN i WHEN i < 16 THEN i - 8 WHEN i < 48 THEN i - 16 ELSE i - 48 END AS turn FROM range(80) AS t(i))
        SELECT i, kind, sample_id FROM seats JOIN bank ON k = turn % n""",
    "levels": "SELECT settings_id, CAST(level AS INT) AS level FROM (SELECT DISTINCT settings_id, unnest(list_concat(list_filter([1, 2, 4, 8, 16, 24, 32], lambda x: x <= max_repairs * 5 + 1), [max_repairs * 5 + 1])) AS level FROM generation_settings)",
    "field_hiding": f"""WITH {P} SELECT sample_id, '[' || array_to_string(list_transform(range(0, len(verses)), lambda i: '{{"i":' || i || ',"first":' || CASE WHEN i % 2 = 0 THEN 'true' ELSE 'false' END || '}}'), ',') || ']' AS public FROM p""",
}
