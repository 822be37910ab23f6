"""Telemetry, checkpoint replay and gates over request_events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators import events as E
from qafila.operators import replay as R
from qafila.plans.selection import P
from qafila.plans.selection import poems as _poems
from qafila.runtime import table

TIMEOUT, SPAN_S = 120.0, 172_800


def once(spark, d):
    return E.delivered_once(table(spark, d, "request_events"))


def delivered_once(spark, d):
    return once(spark, d).select("event_id", "sample_id", "status", F.col("arrived_at").cast("string").alias("arrived"))


def workload_summary(spark, d):
    w = E.workload(once(spark, d), ["endpoint_id", "settings_id"], TIMEOUT)
    return w.select("endpoint_id", "settings_id", "requests", "successes", "retryable_errors", "nonretryable_errors", "truncations", "prompt_tokens", "completion_tokens", "p50", "p95", "safe", F.round("requests_per_second", 12).alias("rps"))


def latency_percentiles(spark, d):
    """Baselines: successes only, six digits."""
    ok = once(spark, d).filter("status = 'ok'")
    keys = ["endpoint_id", "request_kind"]
    rows = E.with_percentiles(ok.groupBy(*keys).agg(F.count("elapsed_seconds").alias("n")), ok, keys, "elapsed_seconds", {"p95": 0.95})
    return rows.withColumn("p95", F.round("p95", 6))


def _levels(spark, d):
    lenient = E.workload(once(spark, d), ["endpoint_id", "settings_id"], TIMEOUT)
    return lenient.withColumn("safe", F.col("nonretryable_errors") <= 1).filter("endpoint_id is not null")


def capacity_selection(spark, d):
    return E.select_capacity(_levels(spark, d), "endpoint_id", "settings_id")


def selected_level(spark, d):
    levels = _levels(spark, d)
    chosen = E.select_capacity(levels, "endpoint_id", "settings_id").select("endpoint_id", F.col("selected").alias("settings_id"))
    return levels.join(chosen, ["endpoint_id", "settings_id"]).select("endpoint_id", "settings_id", "requests", "p95")


def combined_certification(spark, d):
    per = E.workload(once(spark, d).filter("endpoint_id is not null"), ["endpoint_id"], TIMEOUT)
    total = per.agg(
        F.sum("requests_per_second").alias("predicted"), F.max("requests_per_second").alias("best"), F.sum("successes").alias("successes"),
        F.sum("requests").alias("requests"), F.max("seconds").alias("seconds"),
    )
    rows = total.select(
        F.round(F.col("successes") / F.col("seconds") / F.col("predicted"), 9).alias("efficiency"),
        F.round(F.col("successes") / F.col("seconds") / F.col("best"), 9).alias("speedup"),
        F.round(1 - F.col("successes") / F.col("requests"), 9).alias("error_rate"),
    )
    return rows.withColumn("certified", (F.col("efficiency") >= 0.9) & (F.col("speedup") >= 2.5) & (F.col("error_rate") <= 0.005))


def pool_snapshot(spark, d):
    """Totals of capacity; a disabled endpoint (one with fatal errors) has no effective capacity."""
    per = once(spark, d).filter("endpoint_id is not null").groupBy("endpoint_id").agg(F.count_if(F.col("status") == "fatal").alias("fatal"), F.lit(32).alias("hard"))
    return per.agg(F.sum("hard").alias("total_hard"), F.coalesce(F.sum(F.when(F.col("fatal") < 12, F.col("hard"))), F.lit(0)).alias("total_effective"))


def progress_rates(spark, d):
    """Running totals by day, how much remains, and how many days that takes at the pace so far (null before any); the
    window runs over one row a day."""
    day = once(spark, d).groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count("*").alias("n"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    rows = day.select("day", F.sum("ok").over(w).alias("done"), F.sum("n").over(w).alias("seen"), F.sum("n").over(whole).alias("all"), F.min("day").over(whole).alias("first"))
    days = F.datediff(F.col("day").cast("date"), F.col("first").cast("date")) + 1
    pace = F.col("done") / days
    return rows.select(
        "day", "done", "seen", F.round(F.when(F.col("seen") > 0, (F.col("all") - F.col("seen")) / F.col("seen")), 9).alias("left_ratio"),
        F.round(F.col("seen") - F.col("done"), 0).cast("bigint").alias("lost"), F.round(pace / 24, 9).alias("per_hour"), F.round(F.when(pace > 0, (F.col("all") - F.col("done")) / pace), 6).alias("eta_days"),
    )


def trailing_p95(spark, d):
    rows = once(spark, d).filter("status = 'ok' and endpoint_id is not null")
    return E.trailing_percentile(rows, ["endpoint_id", "request_kind"], SPAN_S, 0.95, 5).select("event_id", F.col("n_recent").cast("bigint").alias("n_recent"), "percentile")


def sample_provenance(spark, d):
    return E.provenance(once(spark, d)).select("sample_id", F.array_join("endpoints", ",").alias("endpoints"), "attempts", "failovers", "truncations")


def provenance_merge(spark, d):
    e = once(spark, d)
    current = E.provenance(e.filter("request_kind = 'reasoning'"))
    prior = E.provenance(e.filter("request_kind = 'instruction'")).unionByName(E.provenance(e.filter("request_kind = 'validation'")))
    return E.merge_provenance(current, prior).select("sample_id", F.array_join("endpoints", ",").alias("endpoints"), "attempts", "failovers", "truncations")


def workload_kinds(spark, d):
    """Of each endpoint and request kind the latency and the models that answered."""
    e, keys = once(spark, d), ["endpoint_id", "request_kind"]
    models = F.array_join(F.array_sort(F.collect_set("model")), ",")
    settings = table(spark, d, "generation_settings").select("settings_id", "model")
    rows = e.join(settings, "settings_id", "left").groupBy(*keys).agg(F.count("*").alias("requests"), models.alias("models"))
    return E.with_percentiles(rows, e, keys, "elapsed_seconds", {"p95": 0.95})


def review_kinds(spark, d):
    """Five of each request kind by sample, those asked more than once first, topped up to thirty."""
    from qafila.operators.pilot import review

    done = once(spark, d).filter("endpoint_id is not null").groupBy("sample_id", "request_kind").agg(F.count("*").alias("attempts"), F.bool_or(F.col("status") == "ok").alias("done")).filter("done")
    status = F.when(F.col("attempts") > 1, "passed_after_repair").otherwise("passed")
    return review(done.select(F.concat_ws(":", "request_kind", "sample_id").alias("record_id"), "request_kind", status.alias("validation_status")), "request_kind", 5)


def token_agreement(spark, d):
    """Whether all endpoints counted the same prompt tokens for a sample; unknown if one of them did not see it."""
    per = once(spark, d).filter("status = 'ok' and endpoint_id is not null and prompt_tokens is not null").groupBy("sample_id").agg(F.count_distinct("endpoint_id").alias("n"), F.count_distinct("prompt_tokens").alias("values"))
    return per.select("sample_id", F.when(F.col("n") == 3, F.col("values") == 1).alias("agree"))


def metrics_text(spark, d):
    counts = once(spark, d).filter("endpoint_id is not null").groupBy("endpoint_id", "status").agg(F.count("*").alias("n"), F.sum("prompt_tokens").alias("t"))
    line = lambda name, v: F.concat(F.lit(f"engine:{name}{{endpoint=\""), "endpoint_id", F.lit("\",status=\""), "status", F.lit("\"} "), F.coalesce(v, F.lit(0)).cast("string"))
    text = counts.select(F.explode(F.array(F.lit("# TYPE engine:requests_total counter"), line("requests_total", F.col("n")), line("prompt_tokens_total", F.col("t")))).alias("value"))
    return E.parse_metrics(text)


def error_classes(spark, d):
    e = once(spark, d).filter("status <> 'ok'")
    kind = F.when(F.col("event_id") % 3 == 0, "timeout").when(F.col("event_id") % 3 == 1, "http").otherwise("transport")
    code = F.when(F.col("event_id") % 3 == 1, F.element_at(F.array(*map(F.lit, (400, 401, 403, 408, 429, 500, 503))), (F.col("event_id") % 7 + 1).cast("int")))
    return e.groupBy(X.request_error_class(kind, code).alias("error_class")).agg(F.count("*").alias("n"), F.round(F.sum(X.back_off(F.col("event_id") % 6)), 3).alias("waited"))


def failure_categories(spark, d):
    e = once(spark, d).filter("status <> 'ok'")
    message = F.element_at(F.array(*map(F.lit, (
        "validation response was invalid after 3", "block 2 revised_draft must exactly match its source", "judge rejected reasoning: weak", "chunk 3 remained invalid after repairs", "connection reset",
    ))), (F.col("event_id") % 5 + 1).cast("int"))
    return e.groupBy(X.failure_category(message).alias("category")).agg(F.count("*").alias("n"))


def request_summary(spark, d):
    w = E.workload(once(spark, d).filter("endpoint_id is not null"), ["endpoint_id"], TIMEOUT)
    return w.select("endpoint_id", F.format_string("%d/%d successful, %d errors, p95 %.2fs", "successes", "requests", F.col("retryable_errors") + F.col("nonretryable_errors"), "p95").alias("summary"))


def redacted_events(spark, d):
    secret = ["endpoint_2", "validation"]
    return once(spark, d).select("event_id", X.redact(F.to_json(F.struct("endpoint_id", "request_kind", "status"), {"ignoreNullFields": "false"}), secret).alias("line"))


# ---------------------------------------------------------------- checkpoint log: requests seen as stage events
def log(spark, d):
    """request_events as a checkpoint log of mixed versions, in order of arrival."""
    e = once(spark, d).withColumn("seq", F.col("event_id"))
    ok, kind = F.col("status") == "ok", F.col("request_kind")
    event = F.when(~ok, F.when(F.col("event_id") % 2 == 0, "sample_failure")).when(kind == "instruction", F.when(F.col("event_id") % 2 == 0, "instruction_success").otherwise("stage_success")).when(kind == "reasoning", "reasoning_chunk_success").when(kind.isin("mcq", "reconstruction"), "sample_success").otherwise("ignored")
    rows = e.select(
        "seq", "sample_id", event.alias("event"), F.when(~ok, F.lit("failed")).alias("status"), F.when(kind == "instruction", "instruction").alias("stage_name"),
        F.when(F.col("settings_id") % 4 != 0, F.concat(F.lit("fp"), (F.col("settings_id") % 3).cast("string"))).alias("fingerprint"),
        ((F.col("event_id") % 4) * 3).cast("int").alias("start_offset"), F.concat_ws(":", F.col("status"), kind).alias("error"),
    )
    return R.unify_events(rows)


def checkpoint_successes(spark, d):
    return R.successes(log(spark, d))


def checkpoint_failures(spark, d):
    return R.failures(log(spark, d))


def checkpoint_instructions(spark, d):
    return R.instructions(log(spark, d))


def resume_chunks(spark, d):
    return R.chunks(log(spark, d))


def pending_items(spark, d):
    return _poems(spark, d).select("sample_id").join(R.successes(log(spark, d)).select("sample_id"), "sample_id", "left_anti")


def reusable_successes(spark, d):
    """Successes of a task and version among the poems there are, whose fingerprint fits or that have none."""
    seq = F.col("seq")
    extra = log(spark, d).withColumns({
        "task_type": F.when(seq % 5 > 0, F.when(seq % 5 < 4, "poem-generation").otherwise("mcq")), "task_version": F.when(seq % 3 > 0, F.lit(2)), "template_version": F.when(seq % 2 == 0, F.lit(2)).otherwise(F.lit(1)),
    })
    won = R.successes(extra, "task_type", "task_version", "template_version")
    return R.reusable(won, _poems(spark, d), "poem-generation", 2, "fp1").select("sample_id", F.coalesce("fingerprint", F.lit("legacy")).alias("fingerprint"))


def failures_sorted(spark, d):
    return R.failures(log(spark, d)).orderBy("sample_id")


def endpoint_fold(spark, d):
    return R.fold_endpoints(once(spark, d), 3.0)


def manifest_counts(spark, d):
    """All distributions in one pass: rows are (dimension, value) pairs, combined before the shuffle."""
    p = _poems(spark, d).join(R.successes(log(spark, d)).select("sample_id", "fingerprint"), "sample_id")
    dims = F.array(
        F.struct(F.lit("split").alias("dim"), X.sft_split(F.col("sample_id")).alias("value")), F.struct(F.lit("meter").alias("dim"), F.col("meter_name").alias("value")),
        F.struct(F.lit("corruptions").alias("dim"), X.corruption_count(F.col("sample_id"), F.col("couplet_count")).cast("string").alias("value")), F.struct(F.lit("fingerprint").alias("dim"), F.col("fingerprint").alias("value")),
    )
    return p.select(F.explode(dims).alias("x")).filter("x.value is not null").groupBy("x.dim", "x.value").agg(F.count("*").alias("n"))


def manifest_totals(spark, d):
    won, lost = R.successes(log(spark, d)).withColumn("won", F.lit(1)), R.failures(log(spark, d)).withColumn("lost", F.lit(1))
    p = _poems(spark, d).join(won.select("sample_id", "won"), "sample_id", "left").join(lost.select("sample_id", "lost"), "sample_id", "left")
    return p.agg(
        F.count("*").alias("selected"), F.count("won").alias("generated"), F.count("lost").alias("failed"), F.count_if("metadata_conflict").alias("conflicts"),
        ((F.count("*") == F.count("won")) & (F.count("lost") == 0)).alias("complete"),
    )


def pilot_gates(spark, d):
    p = E.provenance(once(spark, d)).join(_poems(spark, d).select("sample_id"), "sample_id", "left_semi")
    rows = p.agg(F.count("*").alias("done"), F.count_if(F.col("attempts") > 2).alias("repaired"), F.coalesce(F.sum("truncations"), F.lit(0)).alias("truncated"))
    asked = once(spark, d).filter("endpoint_id is not null").select("sample_id", "request_kind").distinct().join(_poems(spark, d).select("sample_id"), "sample_id", "left_semi").agg(F.count_distinct("sample_id").alias("asked"))
    rows = rows.join(asked, F.lit(True)).withColumn("success_rate", F.round(F.col("done") / F.col("asked"), 9))  # one row each
    return rows.select("done", "success_rate", (F.col("success_rate") >= 0.98).alias("success_ok"), "repaired", "truncated", (F.col("repaired") <= F.floor(F.col("done") / 4)).alias("repaired_ok"), (F.col("truncated") == 0).alias("truncated_ok"))


def throughput(spark, d):
    """Successes and tokens an hour, from the first to the last request."""
    seconds = F.greatest(F.lit(1e-6), F.max("ts").cast("timestamp").cast("double") - F.min("ts").cast("timestamp").cast("double"))
    rows = once(spark, d).agg(F.count_if(F.col("status") == "ok").alias("ok"), F.sum("completion_tokens").alias("tokens"), seconds.alias("s"))
    return rows.select(F.round(F.col("ok") / F.col("s") * 3600, 6).alias("per_hour"), F.round(F.col("tokens") / F.col("s") * 3600, 3).alias("tokens_per_hour"))


def review_sample(spark, d):
    """Ten of each attempts class, repaired first, topped up to thirty."""
    from qafila.operators.selection import first_per_stratum

    p = E.provenance(once(spark, d)).select("sample_id", F.when(F.col("attempts") > 3, "many").when(F.col("attempts") > 1, "some").otherwise("one").alias("grp"), (F.col("failovers") == 0).alias("clean"))
    first = first_per_stratum(p, "grp", {"many": 10, "some": 10, "one": 10}, "clean", "sample_id").select("sample_id", "grp")
    rest = p.join(first, "sample_id", "left_anti").orderBy("sample_id").limit(30).select("sample_id", F.lit("top-up").alias("grp"))
    order = F.when(F.col("grp") == "top-up", 1).otherwise(0)
    return first.union(rest).orderBy(order, "sample_id").limit(30).select("sample_id", "grp")


def verdict_parse(spark, d):
    """Strict verdicts: exactly passed and errors, a boolean, a list of non-blank strings, and the two agree."""
    from qafila.operators.contracts import verdict

    return verdict(once(spark, d).select("event_id", _raw_verdict().alias("raw")), "raw").select("event_id", "ok", "passed", "n_errors")


def _raw_verdict():
    k = F.col("event_id") % 7
    texts = ('{"passed":true,"errors":[]}', '{"passed":false,"errors":["weak rhyme"]}', '{"passed":true,"errors":["x"]}', "no json at all", '{"passed":false,"errors":[" "]}', '{"passed":1,"errors":[]}', '{"passed":true,"errors":[],"extra":1}')
    return F.element_at(F.array(*map(F.lit, texts)), (k + 1).cast("int"))


QUERIES = {f.__name__: f for f in (
    delivered_once, workload_summary, latency_percentiles, capacity_selection, selected_level, combined_certification, pool_snapshot, progress_rates, trailing_p95,
    sample_provenance, provenance_merge, workload_kinds, review_kinds, token_agreement, metrics_text, error_classes, failure_categories, request_summary, redacted_events, checkpoint_successes,
    checkpoint_failures, checkpoint_instructions, resume_chunks, pending_items, reusable_successes, failures_sorted, endpoint_fold, manifest_counts, manifest_totals,
    pilot_gates, throughput, review_sample, verdict_parse,
)}

ONCE = "e AS (SELECT * FROM request_events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrived_at DESC) = 1)"
_SECS = "greatest(1e-6, epoch(max(ts)) - epoch(min(ts)))"
_COUNTS = "count(*) AS requests, count(*) FILTER (status = 'ok') AS successes, count(*) FILTER (status = 'retryable') AS retryable_errors, count(*) FILTER (status = 'fatal') AS nonretryable_errors, count(*) FILTER (status = 'ok' AND finish_reason = 'length') AS truncations, coalesce(sum(prompt_tokens) FILTER (status = 'ok'), 0) AS prompt_tokens, coalesce(sum(completion_tokens) FILTER (status = 'ok'), 0) AS completion_tokens, coalesce(quantile_disc(elapsed_seconds, 0.5), 0) AS p50, coalesce(quantile_disc(elapsed_seconds, 0.95), 0) AS p95"
WORK = f"{ONCE}, w AS (SELECT endpoint_id, settings_id, {_COUNTS}, count(*) FILTER (status = 'ok') / {_SECS} AS rps, {_SECS} AS seconds FROM e GROUP BY 1, 2)"
PER = f"{ONCE}, w AS (SELECT endpoint_id, {_COUNTS}, count(*) FILTER (status = 'ok') / {_SECS} AS rps, {_SECS} AS seconds FROM e WHERE endpoint_id IS NOT NULL GROUP BY 1)"
LEVELS = f"{WORK}, l AS (SELECT *, nonretryable_errors <= 1 AS safe FROM w WHERE endpoint_id IS NOT NULL), b AS (SELECT *, max(rps) FILTER (safe) OVER (PARTITION BY endpoint_id) AS best, lag(rps) OVER (PARTITION BY endpoint_id ORDER BY settings_id) AS previous, lead(settings_id) OVER (PARTITION BY endpoint_id ORDER BY settings_id) IS NULL AS last FROM l), c AS (SELECT endpoint_id, min(settings_id) FILTER (safe AND rps >= best * 0.95) AS selected, coalesce(bool_or(last AND safe AND previous IS NOT NULL AND CASE WHEN previous > 0 THEN (rps - previous) / previous ELSE 1 END >= 0.05), false) AS nonconverged FROM b GROUP BY 1)"
PROV = lambda where, name: f"{name}r AS (SELECT sample_id, request_kind, list_sort(list_distinct(list(endpoint_id))) AS eps, count(*) AS attempts, count(*) FILTER (finish_reason = 'length') AS tr FROM e WHERE endpoint_id IS NOT NULL AND {where} GROUP BY 1, 2 HAVING bool_or(status = 'ok')), {name} AS (SELECT sample_id, list_sort(list_distinct(flatten(list(eps)))) AS eps, sum(attempts)::BIGINT AS attempts, sum(greatest(0, len(eps) - 1))::BIGINT AS failovers, sum(tr)::BIGINT AS truncations FROM {name}r GROUP BY 1)"
LOG = f"""{ONCE}, l AS (SELECT event_id AS seq, sample_id, CASE WHEN status <> 'ok' THEN 'sample_failure' WHEN request_kind = 'instruction' THEN 'instruction_success' WHEN request_kind = 'reasoning' THEN 'reasoning_chunk_success' WHEN request_kind IN ('mcq', 'reconstruction') THEN 'sample_success' ELSE 'ignored' END AS event,
    CASE WHEN settings_id % 4 <> 0 THEN 'fp' || (settings_id % 3) END AS fingerprint, CAST(event_id % 4 * 3 AS INT) AS start_offset, concat_ws(':', status, request_kind) AS error FROM e),
  won AS (SELECT sample_id, arg_max(struct_pack(fp := fingerprint, s := seq), seq) AS x FROM l WHERE event = 'sample_success' GROUP BY 1),
  lost AS (SELECT sample_id, arg_max(error, seq) AS error FROM l WHERE event = 'sample_failure' AND sample_id NOT IN (SELECT sample_id FROM won) GROUP BY 1)"""
_MSG = "(['validator_format', 'source_copy', 'semantic_rejection', 'deterministic_contract', 'generation_error'])[event_id % 5 + 1]"
_CODE = "CASE WHEN event_id % 3 = 1 THEN ([400, 401, 403, 408, 429, 500, 503])[event_id % 7 + 1] END"

SQL = {
    "workload_kinds": f"WITH {ONCE} SELECT endpoint_id, request_kind, count(*) AS requests, coalesce(string_agg(DISTINCT model, ',' ORDER BY model), '') AS models, coalesce(quantile_disc(elapsed_seconds, 0.95), 0) AS p95 FROM e LEFT JOIN generation_settings s ON e.settings_id = s.settings_id GROUP BY 1, 2",
    "review_kinds": f"""WITH {ONCE}, g AS (SELECT request_kind || ':' || sample_id AS record_id, request_kind AS grp, count(*) = 1 AS later FROM e WHERE endpoint_id IS NOT NULL AND sample_id IS NOT NULL AND request_kind IS NOT NULL GROUP BY sample_id, request_kind HAVING bool_or(status = 'ok')),
        f AS (SELECT record_id, grp FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY later, record_id) AS r FROM g) WHERE r <= 5),
        t AS (SELECT record_id, 'top-up' AS grp FROM g WHERE record_id NOT IN (SELECT record_id FROM f) ORDER BY record_id LIMIT 30)
        SELECT record_id, grp FROM (SELECT *, 0 AS o FROM f UNION ALL SELECT *, 1 FROM t) ORDER BY o, record_id LIMIT 30""",
    "delivered_once": f"WITH {ONCE} SELECT event_id, sample_id, status, CAST(arrived_at AS VARCHAR) AS arrived FROM e",
    "workload_summary": f"WITH {WORK} SELECT endpoint_id, settings_id, requests, successes, retryable_errors, nonretryable_errors, truncations, CAST(prompt_tokens AS BIGINT) AS prompt_tokens, CAST(completion_tokens AS BIGINT) AS completion_tokens, p50, p95, nonretryable_errors = 0 AND retryable_errors / requests <= 0.005 AND p95 < {TIMEOUT / 2} AS safe, round(rps, 12) AS rps FROM w",
    "latency_percentiles": f"WITH {ONCE} SELECT endpoint_id, request_kind, round(coalesce(quantile_disc(elapsed_seconds, 0.95), 0), 6) AS p95, count(elapsed_seconds) AS n FROM e WHERE status = 'ok' GROUP BY 1, 2",
    "capacity_selection": f"WITH {LEVELS} SELECT endpoint_id, selected, nonconverged FROM c",
    "selected_level": f"WITH {LEVELS} SELECT l.endpoint_id, settings_id, requests, p95 FROM l JOIN c ON l.endpoint_id = c.endpoint_id AND settings_id = selected",
    "combined_certification": f"WITH {PER}, t AS (SELECT sum(rps) AS predicted, max(rps) AS best, sum(successes) AS s, sum(requests) AS r, max(seconds) AS secs FROM w), x AS (SELECT round(s / secs / predicted, 9) AS efficiency, round(s / secs / best, 9) AS speedup, round(1 - s / r, 9) AS error_rate FROM t) SELECT *, efficiency >= 0.9 AND speedup >= 2.5 AND error_rate <= 0.005 AS certified FROM x",
    "pool_snapshot": f"WITH {PER} SELECT CAST(sum(32) AS BIGINT) AS total_hard, CAST(coalesce(sum(32) FILTER (nonretryable_errors < 12), 0) AS BIGINT) AS total_effective FROM w",
    "progress_rates": f"WITH {ONCE}, dd AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (status = 'ok') AS ok, count(*) AS n FROM e GROUP BY 1), r AS (SELECT day, sum(ok) OVER w AS done, sum(n) OVER w AS seen, sum(n) OVER () AS total, min(day) OVER () AS first FROM dd WINDOW w AS (ORDER BY day)), q AS (SELECT *, done / (date_diff('day', CAST(first AS DATE), CAST(day AS DATE)) + 1) AS pace FROM r) SELECT day, CAST(done AS BIGINT) AS done, CAST(seen AS BIGINT) AS seen, round((total - seen) / seen, 9) AS left_ratio, CAST(seen - done AS BIGINT) AS lost, round(pace / 24, 9) AS per_hour, CASE WHEN pace > 0 THEN round((total - done) / pace, 6) END AS eta_days FROM q",
    "trailing_p95": f"""WITH {ONCE}, ok AS (SELECT event_id, endpoint_id, request_kind, epoch(ts) AS t, elapsed_seconds AS x FROM e WHERE status = 'ok' AND endpoint_id IS NOT NULL AND elapsed_seconds IS NOT NULL),
        r AS (SELECT a.event_id, count(*) AS n_recent, list_sort(list(b.x)) AS xs FROM ok a JOIN ok b ON a.endpoint_id = b.endpoint_id AND a.request_kind = b.request_kind AND b.t BETWEEN a.t - {SPAN_S} AND a.t GROUP BY 1)
        SELECT event_id, n_recent, xs[least(n_recent, CAST(ceil(0.95 * n_recent) AS BIGINT))] AS percentile FROM r WHERE n_recent >= 5""",
    "sample_provenance": f"WITH {ONCE}, {PROV('true', 'p')} SELECT sample_id, array_to_string(eps, ',') AS endpoints, attempts, failovers, truncations FROM p",
    "provenance_merge": f"WITH {ONCE}, {PROV("request_kind = 'reasoning'", 'c')}, {PROV("request_kind = 'instruction'", 'i')}, {PROV("request_kind = 'validation'", 'v')}, o AS (SELECT sample_id, flatten(list(eps)) AS eps, max(attempts) AS attempts, max(failovers) AS failovers, max(truncations) AS truncations FROM (SELECT * FROM i UNION ALL SELECT * FROM v) GROUP BY 1) SELECT c.sample_id, array_to_string(list_sort(list_distinct(list_concat(c.eps, coalesce(o.eps, [])))), ',') AS endpoints, c.attempts + coalesce(o.attempts, 0) AS attempts, c.failovers + coalesce(o.failovers, 0) AS failovers, c.truncations + coalesce(o.truncations, 0) AS truncations FROM c LEFT JOIN o ON c.sample_id = o.sample_id",
    "token_agreement": f"WITH {ONCE} SELECT sample_id, CASE WHEN count(DISTINCT endpoint_id) = 3 THEN count(DISTINCT prompt_tokens) = 1 END AS agree FROM e WHERE status = 'ok' AND endpoint_id IS NOT NULL AND prompt_tokens IS NOT NULL GROUP BY 1",
    "metrics_text": f"WITH {ONCE} SELECT 'engine:requests_total' AS name, CAST(count(*) AS DOUBLE) AS total FROM e WHERE endpoint_id IS NOT NULL UNION ALL SELECT 'engine:prompt_tokens_total', CAST(sum(coalesce(prompt_tokens, 0)) AS DOUBLE) FROM e WHERE endpoint_id IS NOT NULL",
    "error_classes": f"WITH {ONCE}, c AS (SELECT event_id, event_id % 3 AS k, {_CODE} AS code FROM e WHERE status <> 'ok') SELECT CASE WHEN code IN (401, 403) THEN 'authentication' WHEN code IN (408, 429) OR code >= 500 THEN 'retryable' WHEN code IS NULL THEN 'retryable' ELSE 'fatal' END AS error_class, count(*) AS n, round(sum(least(pow(2, event_id % 6), 16)), 3) AS waited FROM c GROUP BY 1",
    "failure_categories": f"WITH {ONCE} SELECT {_MSG} AS category, count(*) AS n FROM e WHERE status <> 'ok' GROUP BY 1",
    "request_summary": f"WITH {PER} SELECT endpoint_id, printf('%d/%d successful, %d errors, p95 %.2fs', successes, requests, retryable_errors + nonretryable_errors, p95) AS summary FROM w",
    "redacted_events": f"""WITH {ONCE}, j AS (SELECT event_id, '{{"endpoint_id":' || coalesce('"' || endpoint_id || '"', 'null') || ',"request_kind":"' || request_kind || '","status":"' || status || '"}}' AS line FROM e) SELECT event_id, replace(replace(line, 'endpoint_2', '[REDACTED]'), 'validation', '[REDACTED]') AS line FROM j""",
    "checkpoint_successes": f"WITH {LOG} SELECT sample_id, x.fp AS fingerprint, x.s AS seq FROM won",
    "checkpoint_failures": f"WITH {LOG} SELECT sample_id, error FROM lost",
    "checkpoint_instructions": f"WITH {LOG}, i AS (SELECT sample_id, arg_max(struct_pack(fp := fingerprint, s := seq), seq) AS x FROM l WHERE event = 'instruction_success' GROUP BY 1) SELECT sample_id, x.fp AS fingerprint, x.s AS seq FROM i",
    "resume_chunks": f"WITH {LOG}, c AS (SELECT sample_id, start_offset, arg_max(struct_pack(fp := fingerprint, s := seq), seq) AS x FROM l WHERE event = 'reasoning_chunk_success' GROUP BY 1, 2) SELECT sample_id, start_offset, x.fp AS fingerprint, x.s AS seq FROM c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.event = 'instruction_success' AND l.sample_id = c.sample_id AND l.seq > c.x.s AND l.fingerprint IS DISTINCT FROM c.x.fp)",
    "pending_items": f"WITH {LOG}, {P} SELECT sample_id FROM p WHERE sample_id NOT IN (SELECT sample_id FROM won)",
    "reusable_successes": f"WITH {LOG} SELECT sample_id, coalesce(x.fp, 'legacy') AS fingerprint FROM won WHERE coalesce(x.fp, 'fp1') = 'fp1' AND x.s % 5 <> 4 AND CASE WHEN x.s % 3 > 0 THEN 2 WHEN x.s % 2 = 0 THEN 2 ELSE 1 END = 2 AND sample_id IN (SELECT sample_id FROM poem_records)",
    "failures_sorted": f"WITH {LOG} SELECT sample_id, error FROM lost ORDER BY sample_id",
    "manifest_counts": f"""WITH {LOG}, {P}, g AS (SELECT p.*, won.x.fp AS fp FROM p JOIN won ON p.sample_id = won.sample_id),
        m AS (SELECT 'split' AS dim, CASE WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 < 98 THEN 'train' WHEN ('0x' || substr(sample_id, 1, 8))::UBIGINT % 100 = 98 THEN 'validation' ELSE 'test' END AS value FROM g
          UNION ALL SELECT 'meter', meter_name FROM g UNION ALL SELECT 'corruptions', CAST(('0x' || substr(sha256('reconstruction-count:' || sample_id), 1, 16))::UBIGINT % least(3, couplet_count) + 1 AS VARCHAR) FROM g UNION ALL SELECT 'fingerprint', fp FROM g)
        SELECT dim, value, count(*) AS n FROM m WHERE value IS NOT NULL GROUP BY 1, 2""",
    "manifest_totals": f"WITH {LOG}, {P} SELECT count(*) AS selected, count(won.sample_id) AS generated, count(lost.sample_id) AS failed, count(*) FILTER (metadata_conflict) AS conflicts, count(*) = count(won.sample_id) AND count(lost.sample_id) = 0 AS complete FROM p LEFT JOIN won ON p.sample_id = won.sample_id LEFT JOIN lost ON p.sample_id = lost.sample_id",
    "pilot_gates": f"WITH {ONCE}, {PROV('true', 'q')}, {P}, g AS (SELECT * FROM q WHERE sample_id IN (SELECT sample_id FROM p)) SELECT count(*) AS done, round(count(*) / (SELECT count(DISTINCT sample_id) FROM e WHERE endpoint_id IS NOT NULL AND sample_id IN (SELECT sample_id FROM p)), 9) AS success_rate, round(count(*) / (SELECT count(DISTINCT sample_id) FROM e WHERE endpoint_id IS NOT NULL AND sample_id IN (SELECT sample_id FROM p)), 9) >= 0.98 AS success_ok, count(*) FILTER (attempts > 2) AS repaired, CAST(coalesce(sum(truncations), 0) AS BIGINT) AS truncated, count(*) FILTER (attempts > 2) <= count(*) // 4 AS repaired_ok, coalesce(sum(truncations), 0) = 0 AS truncated_ok FROM g",
    "throughput": f"WITH {ONCE} SELECT round(count(*) FILTER (status = 'ok') / {_SECS} * 3600, 6) AS per_hour, round(CAST(sum(completion_tokens) AS DOUBLE) / {_SECS} * 3600, 3) AS tokens_per_hour FROM e",
    "review_sample": f"""WITH {ONCE}, {PROV('true', 'q')}, g AS (SELECT sample_id, CASE WHEN attempts > 3 THEN 'many' WHEN attempts > 1 THEN 'some' ELSE 'one' END AS grp, failovers = 0 AS clean FROM q),
        f AS (SELECT sample_id, grp FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY clean, sample_id) AS r FROM g) WHERE r <= 10),
        t AS (SELECT sample_id, 'top-up' AS grp FROM g WHERE sample_id NOT IN (SELECT sample_id FROM f) ORDER BY sample_id LIMIT 30)
        SELECT sample_id, grp FROM (SELECT *, 0 AS o FROM f UNION ALL SELECT *, 1 FROM t) ORDER BY o, sample_id LIMIT 30""",
    "verdict_parse": f"WITH {ONCE} SELECT event_id, event_id % 7 IN (0, 1) AS ok, CASE event_id % 7 WHEN 0 THEN true WHEN 1 THEN false END AS passed, CASE event_id % 7 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS n_errors FROM e",
}
