"""Aggregates over fetch logs and crawl results.

A fetch log has one row per final outcome: seq, ts, host, url, status,
error_class (null when the fetch was good).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def good() -> Column:
    return F.col("error_class").isNull()


def _seconds(first: Column, last: Column) -> Column:
    return (F.unix_micros(last) - F.unix_micros(first)) / F.lit(1_000_000.0)


def run_totals(log: DataFrame, span: tuple[Column, Column] | None = None) -> DataFrame:
    """One row: page counts, start, finish, elapsed seconds and pages per second.

    ``span`` is a run's true start and finish; without it the log's first and last time count.
    """
    ts = F.col("ts").cast("timestamp")
    counted = log.agg(
        F.count("*").alias("total_pages"),
        F.count_if(good()).alias("successful"),
        F.count_if(~good()).alias("failed"),
        F.min(ts).alias("started_at"),
        F.max(ts).alias("finished_at"),
    )
    if span is not None:
        counted = counted.withColumns({"started_at": span[0], "finished_at": span[1]})
    elapsed = _seconds(F.col("started_at"), F.col("finished_at"))
    rate = F.when(elapsed > 0, F.try_divide(F.col("total_pages"), elapsed)).otherwise(F.lit(0.0))
    return counted.withColumns({
        "elapsed_seconds": F.coalesce(F.round(elapsed, 2), F.lit(0.0)),
        "pages_per_second": F.round(rate, 2),
    })


def status_counts(log: DataFrame) -> DataFrame:
    """Pages per status, good and failed alike; rows without a status are left out."""
    return log.where(F.col("status").isNotNull()).groupBy("status").agg(F.count("*").alias("n"))


def status_histogram(log: DataFrame) -> DataFrame:
    return status_counts(log).orderBy("status")


def top_domains(log: DataFrame, limit: int = 10) -> DataFrame:
    """Hosts by good pages, host name breaking ties."""
    counted = log.where(good() & F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "host").limit(limit)


def errors_by_type(attempts: DataFrame) -> DataFrame:
    """Failed attempts per error class."""
    failed = attempts.where(~good())
    return failed.groupBy("error_class").agg(F.count("*").alias("n"))


def retry_stats(attempts: DataFrame) -> DataFrame:
    """Retries made, their waits, and operations saved by a retry.

    ``attempts`` carries ``attempt`` and ``wait_s``, the wait after the attempt.
    """
    total = F.coalesce(F.sum("wait_s"), F.lit(0.0))
    return attempts.agg(
        F.count("wait_s").alias("retries_attempted"),
        F.count_if(good() & (F.col("attempt") > 0)).alias("retry_successes"),
        total.alias("total_retry_wait"),
        F.coalesce(F.avg("wait_s"), F.lit(0.0)).alias("avg_retry_wait"),
    )


def final_failures(failures: DataFrame) -> DataFrame:
    """The last failure per URL, '<unknown>' when it has none.

    ``failures`` has url, seq, error_class and message.
    """
    reason = F.concat("error_class", F.lit(": "), "message")
    return failures.groupBy(F.coalesce("url", F.lit("<unknown>")).alias("url")).agg(
        F.max_by(reason, "seq").alias("reason")
    )


def outcome_listing(results: DataFrame, outcome: str) -> DataFrame:
    """URLs of a crawl result that ended in ``outcome``, with reasons."""
    return results.where(F.col("outcome") == outcome).select("url", "reason")


def speed_stats(requests: DataFrame, blocked: Column | None = None, by: str | None = None) -> DataFrame:
    """Requests, requests per second over the span, mean gap, and blocked ones.

    Fewer than two requests, or a span of zero, give zeros.
    """
    ts = F.col("ts").cast("timestamp")
    aggregates = [
        F.count("*").alias("requests"),
        F.count_if(F.lit(False) if blocked is None else blocked).alias("blocked"),
        _seconds(F.min(ts), F.max(ts)).alias("span"),
    ]
    out = requests.groupBy(by).agg(*aggregates) if by else requests.agg(*aggregates)
    enough = (F.col("requests") >= 2) & (F.col("span") > 0)
    return out.select(
        *([by] if by else []),
        "requests",
        F.when(enough, F.try_divide("requests", "span")).otherwise(F.lit(0.0)).alias("req_per_sec"),
        F.when(F.col("requests") >= 2, F.try_divide("span", F.col("requests") - 1)).otherwise(F.lit(0.0)).alias("avg_delay"),
        "blocked",
    )


def wave_progress(results: DataFrame, waves: DataFrame | None = None) -> DataFrame:
    """Cumulative outcome counts after each depth.

    The window runs over one row per depth. ``waves`` may add (depth, queued,
    elapsed_s), from which pages per second follow.
    """
    per_depth = results.groupBy("depth").agg(*[
        F.count_if(F.col("outcome") == name).alias(name) for name in ("processed", "failed", "blocked")
    ])
    upto = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    out = per_depth.select("depth", *[
        F.sum(name).over(upto).alias(name) for name in ("processed", "failed", "blocked")
    ])
    if waves is None:
        return out
    return out.join(waves, "depth").withColumn(
        "pages_per_second", F.coalesce(F.try_divide("processed", "elapsed_s"), F.lit(0.0))
    )


def progress_metrics(counts: DataFrame, total: int | None) -> DataFrame:
    """Percent, rate and time left from ``processed`` and ``elapsed_s``."""
    rate = F.when(F.col("elapsed_s") > 0, F.try_divide("processed", "elapsed_s")).otherwise(F.lit(0.0))
    out = counts.withColumn("rate", rate)
    if not total:
        return out.withColumns({"percent": F.lit(None).cast("double"), "eta_s": F.lit(None).cast("double")})
    left = F.greatest(F.lit(total) - F.col("processed"), F.lit(0))
    return out.withColumns({
        "percent": F.col("processed") / F.lit(float(total)) * 100,
        "eta_s": F.when(F.col("rate") > 0, F.try_divide(left, F.col("rate"))),
    })
