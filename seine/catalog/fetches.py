"""Fetch-log analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import errors
from ..functions.retry import RetryPolicy, TimeoutPolicy, retry_schedule
from ..functions.text import json_cell
from ..functions.urls import hostname
from ..operators import fetchlog
from ..operators.attempts import number_attempts
from ..operators.breaker import BreakerPolicy
from ..operators.breaker import breaker_states as states_of
from ..operators.breaker import replay_breaker
from ..operators.filters import skip_open_circuits
from ..operators.politeness import PacePolicy, audit_pace, paced_fetch_list
from ..plans.report import bar_widths, html_report
from ..plans.summary import run_summary as summary_of
from . import inputs

RETRIES = RetryPolicy(max_retries=2)
BREAKER = BreakerPolicy(threshold=3, recovery_s=86_400)
PACE = PacePolicy(requests_per_second=0.001, min_delay=7_200)
# The skewed log's bound: a key of more rows than this is cut into parts of about half as many,
# of more where those would be too many (``ordered.MAX_PARTS``).
SKEW_ROWS = 2_000
SKEW_BREAKER = BreakerPolicy(threshold=3, recovery_s=20)


def _log(spark, sf_dir):
    return inputs.fetch_log(spark, sf_dir)


def _failures(spark, sf_dir):
    return _log(spark, sf_dir).where(~fetchlog.good())


def status_class(spark, sf_dir):
    status = F.coalesce(F.col("status"), F.lit(599)) + F.col("seq").cast("int") % 7
    return _log(spark, sf_dir).select("seq", status.alias("status")).withColumn(
        "error_class", errors.classify_status(F.col("status"))
    )


def error_reasons(spark, sf_dir):
    """Class and reason of each failed fetch: statuses, timeouts, client errors."""
    log = _failures(spark, sf_dir)
    no_status = F.col("status").isNull()
    timed_out = no_status & (F.col("seq") % 2 == 0)
    message = F.when(no_status, F.concat(F.lit("cannot reach "), F.col("host")))
    error = errors.fetch_error(F.col("status"), timed_out, message, F.col("url"))
    found = log.select("seq", error.alias("e"))
    return found.select("seq", "e.error_class", errors.reason(F.col("e.error_class"), F.col("e.message")).alias("reason"))


def retry_schedules(spark, sf_dir):
    policy = RetryPolicy(max_retries=4, max_delay=20)
    return retry_schedule(_failures(spark, sf_dir), "seq", policy, TimeoutPolicy(total=60, growth=2))


def retry_limits(spark, sf_dir):
    policy = RetryPolicy(max_retries={errors.NETWORK: 4, errors.TRANSIENT: 1}, retry_on=(errors.NETWORK, errors.TRANSIENT))
    error = F.col("error_class")
    return _failures(spark, sf_dir).select(
        "seq", "error_class", policy.retryable(error).alias("retryable"), policy.limit(error).alias("retry_limit")
    )


def run_totals(spark, sf_dir):
    totals = fetchlog.run_totals(_log(spark, sf_dir))
    return totals.select("total_pages", "successful", "failed", "elapsed_seconds")


def status_histogram(spark, sf_dir):
    return fetchlog.status_histogram(_log(spark, sf_dir))


def top_domains(spark, sf_dir):
    return fetchlog.top_domains(_log(spark, sf_dir))


def run_summary(spark, sf_dir):
    """The one-row summary, its nested parts as JSON text."""
    summary = summary_of(_log(spark, sf_dir))
    return summary.select(
        "total_pages", "successful", "failed", "elapsed_seconds", "started_at", "finished_at",
        json_cell(F.col("status_codes")).alias("status_codes"), json_cell(F.col("top_domains")).alias("top_domains"),
    )


def errors_by_type(spark, sf_dir):
    return fetchlog.errors_by_type(_log(spark, sf_dir))


def final_failures(spark, sf_dir):
    log = _failures(spark, sf_dir)
    message = F.when(F.col("status").isNull(), F.lit("no answer")).otherwise(errors.status_message(F.col("status")))
    url = F.when(F.col("status") != 429, F.col("url"))
    return fetchlog.final_failures(log.select(url.alias("url"), "seq", "error_class", message.alias("message")))


def speed_stats(spark, sf_dir):
    """Per host: requests, mean gap and blocked (404) requests."""
    stats = fetchlog.speed_stats(_log(spark, sf_dir), blocked=F.col("status") == 404, by="host")
    return stats.select("host", "requests", F.round("avg_delay", 3).alias("avg_delay"), "blocked")


def progress_metrics(spark, sf_dir):
    counts = fetchlog.run_totals(_log(spark, sf_dir)).select(
        F.col("total_pages").alias("processed"), F.col("elapsed_seconds").alias("elapsed_s")
    )
    metrics = fetchlog.progress_metrics(counts, total=1_000_000_000)
    return metrics.select(
        "processed", F.round("percent", 6).alias("percent"), F.round("rate", 6).alias("rate"),
        F.round(F.col("eta_s") / 1e6, 2).alias("eta_ms"),
    )


def _attempts(spark, sf_dir):
    return number_attempts(_log(spark, sf_dir), RETRIES)


def _numbered(attempts):
    return attempts.select("seq", F.col("op_start").cast("bigint").alias("op_start"), "attempt", "is_final", "gave_up", "wait_s")


def attempt_numbering(spark, sf_dir):
    return _numbered(_attempts(spark, sf_dir))


def skew_attempts(spark, sf_dir):
    """Attempts where one host has nine tenths of the log within one hour, and some rows have no time."""
    return _numbered(number_attempts(inputs.skewed_log(spark, sf_dir), RETRIES, heavy_rows=SKEW_ROWS))


def retry_stats(spark, sf_dir):
    return fetchlog.retry_stats(_attempts(spark, sf_dir)).withColumn("avg_retry_wait", F.round("avg_retry_wait", 6))


def politeness_audit(spark, sf_dir):
    return _audit(_log(spark, sf_dir), PACE)


def politeness_global(spark, sf_dir):
    """All requests share one key."""
    return _audit(_log(spark, sf_dir), PacePolicy(requests_per_second=0.005, per_host=False))


def skew_politeness(spark, sf_dir):
    return _audit(inputs.skewed_log(spark, sf_dir), PACE, heavy_rows=SKEW_ROWS)


def skew_politeness_global(spark, sf_dir):
    return _audit(inputs.skewed_log(spark, sf_dir), PacePolicy(requests_per_second=0.005, per_host=False), heavy_rows=SKEW_ROWS)


def _audit(log, policy, **bound):
    delay = F.when(F.col("host").endswith("3.example.com"), F.lit(10_000.0))
    audit = audit_pace(log, policy, crawl_delay=delay, **bound)
    return audit.select(
        "seq", "pace_key", F.round("gap_s", 3).alias("gap_s"), F.round("required_s", 3).alias("required_s"),
        F.round("wait_s", 3).alias("wait_s"), "violation",
    )


def polite_fetch_list(spark, sf_dir):
    pages = inputs.pages(spark, sf_dir).select("page_id", hostname("url").alias("host"))
    paced = paced_fetch_list(
        pages, PacePolicy(requests_per_second=4, min_delay=0.5), ["page_id"]
    )
    return paced.select("page_id", "host", "rank", "send_offset_s")


def _replayed(spark, sf_dir):
    log = _log(spark, sf_dir).select("seq", "host", "ts", fetchlog.good().alias("ok"))
    return replay_breaker(log, BREAKER)


def breaker_replay(spark, sf_dir):
    return _replayed(spark, sf_dir).select("seq", "host", "ok", "allowed", "state_after")


def skew_breaker(spark, sf_dir):
    """The breaker where one host has nine tenths of the log within one hour, and some rows have no time."""
    log = inputs.skewed_log(spark, sf_dir).select("seq", "host", "ts", fetchlog.good().alias("ok"))
    replayed = replay_breaker(log, SKEW_BREAKER, heavy_rows=SKEW_ROWS)
    return replayed.select("seq", "host", "ok", "allowed", "state_after")


def breaker_states(spark, sf_dir):
    return states_of(_replayed(spark, sf_dir))


def circuit_skips(spark, sf_dir):
    return skip_open_circuits(_replayed(spark, sf_dir)).select("seq", "host", "reason")


def report_bars(spark, sf_dir):
    log = _log(spark, sf_dir)
    codes = fetchlog.status_histogram(log).select(F.lit("status").alias("section"), F.col("status").cast("string").alias("name"), "n")
    hosts = fetchlog.top_domains(log).select(F.lit("domain").alias("section"), F.col("host").alias("name"), "n")
    return bar_widths(codes.unionByName(hosts))


def report_page(spark, sf_dir):
    """Facts of the rendered report page: rows of bars, and its tiles in order."""
    page = html_report(summary_of(_log(spark, sf_dir)))
    bars = F.size(F.regexp_extract_all("value", F.lit("class='bar'"), 0)).cast("bigint")
    tiles = F.array_join(F.slice(F.regexp_extract_all("value", F.lit("<b>([^<]*)</b>"), 1), 1, 3), " ")
    return page.select(bars.alias("n_bars"), tiles.alias("tiles"))


QUERIES = {
    "status_class": status_class,
    "error_reasons": error_reasons,
    "retry_schedule": retry_schedules,
    "retry_limits": retry_limits,
    "run_totals": run_totals,
    "status_histogram": status_histogram,
    "top_domains": top_domains,
    "run_summary": run_summary,
    "errors_by_type": errors_by_type,
    "final_failures": final_failures,
    "speed_stats": speed_stats,
    "progress_metrics": progress_metrics,
    "attempt_numbering": attempt_numbering,
    "retry_stats": retry_stats,
    "politeness_audit": politeness_audit,
    "politeness_global": politeness_global,
    "polite_fetch_list": polite_fetch_list,
    "breaker_replay": breaker_replay,
    "skew_attempts": skew_attempts,
    "skew_politeness": skew_politeness,
    "skew_politeness_global": skew_politeness_global,
    "skew_breaker": skew_breaker,
    "breaker_states": breaker_states,
    "circuit_skips": circuit_skips,
    "report_bars": report_bars,
    "report_page": report_page,
}

_LOG = f"log AS ({inputs.FETCH_LOG_SQL})"
_TRANSIENT = "status IN (408, 429, 500, 502, 503, 504) OR status BETWEEN 500 AND 599"
_ELAPSED = "(epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0"
_ISO = "CASE WHEN epoch_us({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
_TOP = "SELECT host, count(*) AS n FROM log WHERE error_class IS NULL GROUP BY host ORDER BY n DESC, host LIMIT 10"
_CODES = "SELECT status, count(*) AS n FROM log WHERE status IS NOT NULL GROUP BY status"
_RETRYABLE = "coalesce(error_class IN ('TransientError', 'NetworkError'), false)"

_SKEWED = f"log AS ({inputs.SKEWED_LOG_SQL})"

_ATTEMPTS = f"""
  marked AS (
    SELECT *, {_RETRYABLE} AS again, row_number() OVER w AS rn,
      count(*) FILTER (NOT {_RETRYABLE}) OVER (PARTITION BY host ORDER BY ts NULLS FIRST, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island,
      lead(seq) OVER w IS NULL AS at_end FROM log WINDOW w AS (PARTITION BY host ORDER BY ts NULLS FIRST, seq)),
  placed AS (SELECT *, (row_number() OVER (PARTITION BY host, island ORDER BY rn) - 1) % 3 AS a FROM marked),
  attempts AS (
    SELECT *, NOT again OR a >= 2 OR at_end AS is_final, again AND a >= 2 AS gave_up,
      CASE WHEN again AND NOT (a >= 2 OR at_end) THEN least(power(2.0, a) * CASE WHEN status = 429 THEN 3 ELSE 1 END, 60.0) END AS wait_s
    FROM placed)
"""
ATTEMPTS_CTE = f"{_LOG}, {_ATTEMPTS}"
_NUMBERED = "SELECT seq, rn - a AS op_start, CAST(a AS INT) AS attempt, is_final, gave_up, wait_s FROM attempts"


def _audit_sql(key: str, floor: float, log: str = _LOG) -> str:
    return f"""
      WITH {log}, gaps AS (
        SELECT seq, {key} AS pace_key, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY {key} ORDER BY ts NULLS FIRST, seq)) / 1000000.0 AS gap,
          CASE WHEN host LIKE '%3.example.com' THEN greatest({floor}, 10000.0) ELSE {floor} END AS need FROM log)
      SELECT seq, pace_key, round(CAST(gap AS DOUBLE), 3) AS gap_s, round(CAST(need AS DOUBLE), 3) AS required_s,
        round(CAST(coalesce(greatest(need - gap, 0), 0) AS DOUBLE), 3) AS wait_s, coalesce(gap < need, false) AS violation FROM gaps"""


def _breaker_cte(log: str, recovery_us: int) -> str:
    return f"""
  {log}, ordered AS MATERIALIZED (
    SELECT seq, host, epoch_us(ts) AS us, error_class IS NULL AS ok, row_number() OVER (PARTITION BY host ORDER BY ts, seq) AS rn FROM log WHERE ts IS NOT NULL),
  steps(seq, host, us, ok, rn, allowed, opened, fails) AS (
    SELECT seq, host, us, ok, rn, true, CAST(NULL AS BIGINT), CASE WHEN ok THEN 0 ELSE 1 END FROM ordered WHERE rn = 1
    UNION ALL
    SELECT o.seq, o.host, o.us, o.ok, o.rn, s.opened IS NULL OR o.us - s.opened >= {recovery_us},
      CASE WHEN s.opened IS NOT NULL AND o.us - s.opened < {recovery_us} THEN s.opened
           WHEN o.ok THEN NULL WHEN s.opened IS NOT NULL OR s.fails + 1 >= 3 THEN o.us END,
      CASE WHEN s.opened IS NOT NULL AND o.us - s.opened < {recovery_us} THEN s.fails
           WHEN o.ok THEN 0 WHEN s.opened IS NOT NULL THEN s.fails ELSE s.fails + 1 END
    FROM steps s JOIN ordered o ON o.host = s.host AND o.rn = s.rn + 1),
  replay AS (SELECT *, CASE WHEN opened IS NULL THEN 'closed' ELSE 'open' END AS state_after FROM steps)
"""


BREAKER_CTE = _breaker_cte(_LOG, 86_400_000_000)

ORACLES = {
    "status_class": f"""
      WITH {_LOG}, moved AS (SELECT seq, CAST(coalesce(status, 599) + seq % 7 AS INT) AS status FROM log)
      SELECT seq, status, CASE WHEN {_TRANSIENT} THEN 'TransientError' ELSE 'PermanentError' END AS error_class FROM moved""",
    "error_reasons": f"""
      WITH {_LOG}, named AS (
        SELECT seq, CASE WHEN {_TRANSIENT} THEN 'TransientError' WHEN status IS NOT NULL THEN 'PermanentError'
            WHEN seq % 2 = 0 THEN 'TransientError' ELSE 'NetworkError' END AS error_class,
          CASE WHEN {_TRANSIENT} THEN concat('transient HTTP ', status) WHEN status IS NOT NULL THEN concat('permanent HTTP ', status)
            WHEN seq % 2 = 0 THEN concat('timeout for ', url) ELSE concat('cannot reach ', host) END AS message
        FROM log WHERE error_class IS NOT NULL)
      SELECT seq, error_class, concat(error_class, ': ', message) AS reason FROM named""",
    "retry_schedule": f"""
      WITH {_LOG}, tries AS (
        SELECT seq, error_class, status, CASE WHEN {_RETRYABLE} THEN 4 ELSE 0 END AS top FROM log WHERE error_class IS NOT NULL),
      plan AS (SELECT t.*, CAST(g.a AS INT) AS attempt,
          least(power(2.0, g.a) * CASE WHEN status = 429 THEN 3 ELSE 1 END, 20.0) AS d
        FROM tries t, unnest(generate_series(0, t.top)) AS g(a))
      SELECT seq, error_class, attempt, CASE WHEN attempt < top THEN d END AS wait_s,
        coalesce(sum(d) OVER (PARTITION BY seq ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS waited_s,
        10 * power(2.0, attempt) AS connect_s, 30 * power(2.0, attempt) AS read_s, 60 * power(2.0, attempt) AS total_s,
        attempt = top AS is_last FROM plan""",
    "retry_limits": f"""
      WITH {_LOG} SELECT seq, error_class, {_RETRYABLE} AS retryable,
        CAST(CASE error_class WHEN 'NetworkError' THEN 4 WHEN 'TransientError' THEN 1 ELSE 0 END AS INT) AS retry_limit
      FROM log WHERE error_class IS NOT NULL""",
    "run_totals": f"""
      WITH {_LOG} SELECT count(*) AS total_pages, count(*) FILTER (error_class IS NULL) AS successful,
        count(error_class) AS failed, round(CAST({_ELAPSED} AS DOUBLE), 2) AS elapsed_seconds FROM log""",
    "status_histogram": f"WITH {_LOG} {_CODES}",
    "top_domains": f"WITH {_LOG} {_TOP}",
    "run_summary": f"""
      WITH {_LOG} SELECT count(*) AS total_pages, count(*) FILTER (error_class IS NULL) AS successful,
        count(error_class) AS failed, round(CAST({_ELAPSED} AS DOUBLE), 2) AS elapsed_seconds,
        {_ISO.format('min(ts)')} AS started_at, {_ISO.format('max(ts)')} AS finished_at,
        (SELECT concat('{{', string_agg(concat('"', status, '":', n), ',' ORDER BY status), '}}') FROM ({_CODES})) AS status_codes,
        (SELECT concat('[', string_agg(concat('{{"host":"', host, '","n":', n, '}}'), ',' ORDER BY n DESC, host), ']') FROM ({_TOP}))
          AS top_domains
      FROM log""",
    "errors_by_type": f"WITH {_LOG} SELECT error_class, count(*) AS n FROM log WHERE error_class IS NOT NULL GROUP BY 1",
    "final_failures": f"""
      WITH {_LOG}, named AS (
        SELECT coalesce(CASE WHEN status <> 429 THEN url END, '<unknown>') AS url, seq, concat(error_class, ': ',
          CASE WHEN status IS NULL THEN 'no answer' WHEN {_TRANSIENT} THEN concat('transient HTTP ', status)
            ELSE concat('permanent HTTP ', status) END) AS reason FROM log WHERE error_class IS NOT NULL)
      SELECT url, arg_max(reason, seq) AS reason FROM named GROUP BY url""",
    "speed_stats": f"""
      WITH {_LOG} SELECT host, count(*) AS requests,
        round(CAST(CASE WHEN count(*) >= 2 THEN {_ELAPSED} / (count(*) - 1) ELSE 0 END AS DOUBLE), 3) AS avg_delay,
        count(*) FILTER (status = 404) AS blocked FROM log GROUP BY host""",
    "progress_metrics": f"""
      WITH {_LOG}, c AS (SELECT count(*) AS n, round(CAST({_ELAPSED} AS DOUBLE), 2) AS s FROM log)
      SELECT n AS processed, round(n / 1000000000.0 * 100, 6) AS percent, round(n / s, 6) AS rate,
        round((1000000000 - n) / (n / s) / 1e6, 2) AS eta_ms FROM c""",
    "attempt_numbering": f"WITH {ATTEMPTS_CTE} {_NUMBERED}",
    "skew_attempts": f"WITH {_SKEWED}, {_ATTEMPTS} {_NUMBERED}",
    "retry_stats": f"""
      WITH {ATTEMPTS_CTE} SELECT count(wait_s) AS retries_attempted,
        count(*) FILTER (error_class IS NULL AND a > 0) AS retry_successes, sum(wait_s) AS total_retry_wait,
        round(avg(wait_s), 6) AS avg_retry_wait FROM attempts""",
    "politeness_audit": _audit_sql("host", 7200.0),
    "politeness_global": _audit_sql("'__global__'", 200.0),
    "polite_fetch_list": f"""
      WITH ranked AS (SELECT page_id, {inputs.HOST_SQL} AS host FROM pages)
      SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS rank,
        (row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) * CAST(0.5 AS DOUBLE) AS send_offset_s FROM ranked""",
    "breaker_replay": f"WITH RECURSIVE {BREAKER_CTE} SELECT seq, host, ok, allowed, state_after FROM replay",
    "skew_politeness": _audit_sql("host", 7200.0, _SKEWED),
    "skew_politeness_global": _audit_sql("'__global__'", 200.0, _SKEWED),
    "skew_breaker": f"""
      WITH RECURSIVE {_breaker_cte(_SKEWED, 20_000_000)} SELECT seq, host, ok, allowed, state_after FROM replay
      UNION ALL SELECT seq, host, error_class IS NULL, true, 'closed' FROM log WHERE ts IS NULL""",
    "breaker_states": f"""
      WITH RECURSIVE {BREAKER_CTE} SELECT host, arg_max(state_after, rn) AS state, count(*) FILTER (NOT allowed) AS denied
      FROM replay GROUP BY host""",
    "circuit_skips": f"WITH RECURSIVE {BREAKER_CTE} SELECT seq, host, 'circuit open' AS reason FROM replay WHERE NOT allowed",
    "report_bars": f"""
      WITH {_LOG}, bars AS (SELECT 'status' AS section, CAST(status AS VARCHAR) AS name, n FROM ({_CODES})
        UNION ALL SELECT 'domain', host, n FROM ({_TOP}))
      SELECT section, name, n, CAST(floor(n * 100 / max(n) OVER (PARTITION BY section)) AS BIGINT) AS width FROM bars""",
    "report_page": f"""
      WITH {_LOG} SELECT (SELECT count(*) FROM ({_CODES})) + (SELECT count(*) FROM ({_TOP})) AS n_bars,
        concat_ws(' ', count(*), count(*) FILTER (error_class IS NULL), count(error_class)) AS tiles FROM log""",
}
