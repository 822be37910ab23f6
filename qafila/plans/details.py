"""Smaller operators: text functions, audits, joins with decisions and settings, chunk summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators import events as E
from qafila.operators import replay as R
from qafila.operators.selection import latest, packed_chunks
from qafila.plans import telemetry as M
from qafila.plans.selection import CHUNK, OVERSIZE, PACK, P, poems
from qafila.runtime import table


def couplet_normal_form(spark, d):
    """Every couplet written three ways in turn, brought to one."""
    pair = lambda n: F.struct(n.alias("couplet_no"), F.get("verses", 2 * n - 2).alias("v0"), F.get("verses", 2 * n - 1).alias("v1"))
    p = poems(spark, d).filter("couplet_count > 0").select("record_no", F.explode(F.transform(F.sequence(F.lit(1), F.col("couplet_count")), pair)).alias("x")).select("record_no", "x.*")
    k, v0, v1 = (F.col("record_no") + F.col("couplet_no")) % 3, F.col("v0"), F.col("v1")
    raw = F.when(k == 0, F.concat(F.lit("  "), v0, F.lit("="), v1)).when(k == 1, F.concat(v0, F.lit("   =  "), v1, F.lit(" "))).otherwise(F.concat(v0, F.lit(" = "), v1, F.lit(" = x")))
    return p.select("record_no", "couplet_no", F.sha2(X.normal_couplet(raw), 256).alias("digest"))


def grounding_words(spark, d):
    """The words of every document as stored, whatever its language is said to be."""
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(X.grounding_words(F.col("text"))), " ").alias("words"))


def stripped_marks(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    return docs.select("doc_id", F.sha2(X.fold_alif(F.col("text")), 256).alias("digest"))


def choice_labels(spark, d):
    q = table(spark, d, "mcq_items").select("work_id", "prompt_id", F.concat(F.when(F.col("prompt_id").endswith("1"), F.lit("أ) ")).when(F.col("prompt_id").endswith("2"), F.lit(" (ب. ")).otherwise(F.lit("")), "ground_truth").alias("answer"))
    return q.groupBy("prompt_id").agg(F.count_if(X.has_choice_label(F.col("answer"))).alias("labelled"), F.count("*").alias("n"))


def code_fences(spark, d):
    e = M.once(spark, d).withColumn("raw", F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("```json\n")).otherwise(F.lit("```\n")), F.lit('{"k":'), F.col("event_id").cast("string"), F.lit("}\n```")))
    return e.select("event_id", X.strip_code_fence(F.col("raw")).alias("clean"))


def instruction_fingerprints(spark, d):
    i = table(spark, d, "documents").filter("text is not null")
    return i.select("doc_id", F.sha2(F.concat_ws("\x1f", F.lit("g1"), "source", "text"), 256).alias("fingerprint"))


def poem_containment(spark, d):
    """Poem documents that hold the whole text of the poem they name, raw or with escaped line breaks."""
    docs = table(spark, d, "documents").filter("sample_id is not null and text is not null").select("doc_id", "sample_id", "text")
    both = docs.join(poems(spark, d).select("sample_id", "poem_text"), "sample_id")
    whole = F.contains("text", "poem_text") | F.contains("text", F.replace("poem_text", F.lit("\n"), F.lit("\\n")))
    return both.groupBy(whole.alias("whole")).agg(F.count("*").alias("n"))


def chunk_summary(spark, d):
    """Oversized poems: a note per packed chunk, joined in order."""
    big = poems(spark, d).filter(F.length("poem_text") > OVERSIZE)
    rows = big.select("sample_id", F.posexplode(packed_chunks(X.couplets(F.col("verses")), CHUNK)).alias("pos", "chunk"))
    notes = rows.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.concat((F.col("pos") + 1).cast("string"), F.lit(": "), F.length("chunk").cast("string")).alias("note")))).alias("x"))
    return notes.select("sample_id", F.array_join(F.transform("x", lambda s: s["note"]), "; ").alias("summary"))


def review_decisions(spark, d):
    """Left join with decisions that exist; defaults where they do not."""
    asked = table(spark, d, "probe_poems").select("sample_id").distinct()
    made = R.successes(M.log(spark, d)).select("sample_id", (F.col("seq") % 2 == 0).alias("approved"))
    return asked.join(made, "sample_id", "left").select("sample_id", "approved", F.coalesce(F.when(F.col("approved"), F.lit("ok")), F.lit("")).alias("notes"))


def settings_match(spark, d):
    """Settings used by events against those configured: each exactly once on both sides."""
    used = M.once(spark, d).groupBy("settings_id").agg(F.count("*").alias("uses"))
    have = table(spark, d, "generation_settings").groupBy("settings_id").agg(F.count("*").alias("rows"))
    both = used.join(have, "settings_id", "full_outer")
    return both.select("settings_id", F.coalesce("uses", F.lit(0)).alias("uses"), (F.coalesce("rows", F.lit(0)) == 1).alias("configured_once"))


def reuse_defaults(spark, d):
    """Missing endpoints and counters of reused records filled."""
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return M.once(spark, d).select("event_id", F.coalesce("endpoint_id", F.lit("checkpoint_legacy")).alias("endpoint_id"), zero("prompt_tokens"), zero("completion_tokens"))


def endpoint_pick(spark, d):
    """Of a snapshot the endpoint with the least load, ties by distance in turn."""
    snap = M.once(spark, d).filter("endpoint_id is not null").groupBy("endpoint_id").agg((F.count_if(F.col("status") != "ok") % 8).alias("in_flight"), F.lit(8).alias("capacity"))
    turn = F.pmod(F.substring("endpoint_id", -1, 1).cast("int") - 2, F.lit(3))
    return snap.agg(F.min_by("endpoint_id", F.struct(F.col("in_flight") / F.col("capacity"), turn)).alias("endpoint_id"))


def matching_events(spark, d):
    """Of events under one fingerprint the last per key."""
    e = M.once(spark, d).filter("settings_id = 3").withColumn("key", F.concat_ws("|", "endpoint_id", "request_kind"))
    return latest(e.select("key", "event_id", "status"), "key", "event_id")


def retry_waits(spark, d):
    """Retry-After as seconds or date."""
    e = M.once(spark, d).filter("status = 'retryable'")
    k = F.col("event_id") % 3
    header = F.when(k == 0, (F.col("event_id") % 90).cast("string")).when(k == 1, F.lit("Thu, 01 Jan 2026 00:00:30 GMT")).otherwise(F.lit("soon"))
    return e.select("event_id", X.retry_after_seconds(header, F.lit("2026-01-01 00:00:10").cast("timestamp")).alias("wait"))


def iso_stamps(spark, d):
    return M.once(spark, d).select("event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"), F.substring("sample_id", 1, 24).alias("preview"))


def answer_forms(spark, d):
    q = table(spark, d, "mcq_items")
    return q.select("work_id", X.normal_answer(F.concat(F.lit("  "), F.upper("ground_truth"), F.lit("  X "))).alias("answer")).distinct()


def duplicate_items(spark, d):
    q = table(spark, d, "mcq_items")
    return q.groupBy("work_id").agg(F.count("*").alias("n"), F.count_distinct("ground_truth").alias("values")).filter("n > 1")


def tokens_by_setting(spark, d):
    """Lookup of a parameter table: unknown ids would be left out, the audit in settings_match finds them."""
    s = table(spark, d, "generation_settings").select("settings_id", "model")
    return M.once(spark, d).join(s, "settings_id").groupBy("model").agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.count("*").alias("n"))


def daily_lateness(spark, d):
    e = M.once(spark, d)
    late = F.col("arrived_at").cast("timestamp").cast("double") - F.col("ts").cast("timestamp").cast("double")
    e = e.withColumn("day", F.to_date("ts").cast("string"))
    rows = e.groupBy("day").agg(F.count_if(late > 3600).alias("late"), F.round(F.max(late), 3).alias("latest"))
    return E.with_percentiles(rows, e, ["day"], "elapsed_seconds", {"p95": 0.95})


QUERIES = {f.__name__: f for f in (
    couplet_normal_form, grounding_words, stripped_marks, choice_labels, code_fences, instruction_fingerprints, poem_containment, chunk_summary, review_decisions,
    settings_match, reuse_defaults, endpoint_pick, matching_events, retry_waits, iso_stamps, answer_forms, duplicate_items, tokens_by_setting, daily_lateness,
)}

_ONCE, _LOG = M.ONCE, M.LOG
_TRIM = lambda x: f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"

SQL = {
    "couplet_normal_form": f"WITH {P}, x AS (SELECT record_no, n, nfc_normalize(verses[2 * n - 1]) AS a, nfc_normalize(verses[2 * n]) AS b FROM (SELECT record_no, verses, unnest(range(1, couplet_count + 1)) AS n FROM p)) SELECT record_no, CAST(n AS INT) AS couplet_no, sha256(CASE WHEN (record_no + n) % 3 = 2 OR contains(a || b, '=') THEN {_TRIM("a || ' = ' || b || ' = x'")} ELSE {_TRIM('a')} || ' = ' || {_TRIM('b')} END) AS digest FROM x",
    "grounding_words": r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(translate(regexp_replace(text, '[\x{0610}-\x{061a}\x{064b}-\x{065f}\x{0670}\x{06d6}-\x{06ed}\x{0640}]', '', 'g'), 'أإآٱ', 'اااا')),
        '[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}\x{0600}-\x{06ff}]+'), lambda w: length(w) >= 3))), ' ') AS words FROM documents""",
    "stripped_marks": "SELECT doc_id, sha256(translate(regexp_replace(text, '[\\x{610}-\\x{61a}\\x{64b}-\\x{65f}\\x{670}\\x{6d6}-\\x{6ed}\\x{640}]', '', 'g'), 'أإآٱ', 'اااا')) AS digest FROM documents WHERE text IS NOT NULL",
    "choice_labels": "WITH q AS (SELECT prompt_id, CASE WHEN prompt_id LIKE '%1' THEN 'أ) ' WHEN prompt_id LIKE '%2' THEN ' (ب. ' ELSE '' END || ground_truth AS a FROM mcq_items) SELECT prompt_id, count(*) FILTER (regexp_matches(a, '^\\s*[\\(\\[]?[أبجد][\\)\\]\\-.:：]')) AS labelled, count(*) AS n FROM q GROUP BY 1",
    "code_fences": f"""WITH {_ONCE} SELECT event_id, '{{"k":' || event_id || '}}' AS clean FROM e""",
    "instruction_fingerprints": "SELECT doc_id, sha256(concat_ws(chr(31), 'g1', source, text)) AS fingerprint FROM documents WHERE text IS NOT NULL",
    "poem_containment": f"WITH {P} SELECT contains(text, poem_text) OR contains(text, replace(poem_text, chr(10), '\\n')) AS whole, count(*) AS n FROM documents d JOIN p ON d.sample_id = p.sample_id WHERE text IS NOT NULL GROUP BY 1",
    "chunk_summary": f"{PACK} SELECT k.sample_id, string_agg(chunk_no || ': ' || length(chunk), '; ' ORDER BY chunk_no) AS summary FROM packed k JOIN p ON k.sample_id = p.sample_id WHERE length(p.poem_text) > {OVERSIZE} GROUP BY 1",
    "review_decisions": f"WITH {_LOG} SELECT a.sample_id, won.x.s % 2 = 0 AS approved, CASE WHEN won.x.s % 2 = 0 THEN 'ok' ELSE '' END AS notes FROM (SELECT DISTINCT sample_id FROM probe_poems) a LEFT JOIN won ON a.sample_id = won.sample_id",
    "settings_match": f"WITH {_ONCE}, u AS (SELECT settings_id, count(*) AS uses FROM e GROUP BY 1), h AS (SELECT settings_id, count(*) AS n FROM generation_settings GROUP BY 1) SELECT coalesce(u.settings_id, h.settings_id) AS settings_id, coalesce(uses, 0) AS uses, coalesce(n, 0) = 1 AS configured_once FROM u FULL JOIN h ON u.settings_id = h.settings_id",
    "reuse_defaults": f"WITH {_ONCE} SELECT event_id, coalesce(endpoint_id, 'checkpoint_legacy') AS endpoint_id, coalesce(prompt_tokens, 0) AS prompt_tokens, coalesce(completion_tokens, 0) AS completion_tokens FROM e",
    "endpoint_pick": f"WITH {_ONCE}, s AS (SELECT endpoint_id, count(*) FILTER (status <> 'ok') % 8 AS f FROM e WHERE endpoint_id IS NOT NULL GROUP BY 1) SELECT endpoint_id FROM s ORDER BY f / 8, (CAST(right(endpoint_id, 1) AS INT) - 2 + 3) % 3 LIMIT 1",
    "matching_events": f"WITH {_ONCE} SELECT concat_ws('|', endpoint_id, request_kind) AS key, max(event_id) AS event_id, arg_max(status, event_id) AS status FROM e WHERE settings_id = 3 GROUP BY 1",
    "retry_waits": f"WITH {_ONCE} SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 90 AS DOUBLE) WHEN 1 THEN 20.0 END AS wait FROM e WHERE status = 'retryable'",
    "iso_stamps": f"WITH {_ONCE} SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp, substr(sample_id, 1, 24) AS preview FROM e",
    "answer_forms": "SELECT DISTINCT work_id, regexp_replace(regexp_replace(lower(nfc_normalize(upper(ground_truth) || '  X')), '[\\s\\p{Z}]+', ' ', 'g'), '^ ', '') AS answer FROM mcq_items",
    "duplicate_items": "SELECT work_id, count(*) AS n, count(DISTINCT ground_truth) AS values FROM mcq_items GROUP BY 1 HAVING count(*) > 1",
    "tokens_by_setting": f"WITH {_ONCE} SELECT model, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, count(*) AS n FROM e JOIN generation_settings s ON e.settings_id = s.settings_id GROUP BY 1",
    "daily_lateness": f"WITH {_ONCE} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (epoch(arrived_at) - epoch(ts) > 3600) AS late, round(max(epoch(arrived_at) - epoch(ts)), 3) AS latest, coalesce(quantile_disc(elapsed_seconds, 0.95), 0) AS p95 FROM e GROUP BY 1",
}
