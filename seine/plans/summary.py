"""One-row run summaries and error reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_time
from ..operators import fetchlog


def run_summary(log: DataFrame, top: int = 10, span: tuple[Column, Column] | None = None) -> DataFrame:
    """Totals, timing, status histogram and top hosts as one nested row.

    ``span`` is the run's true start and finish, where known.

    Statuses and the top list are bounded by nature; each is aggregated to one
    value and read as a scalar subquery beside the totals.
    """
    pairs = F.array_sort(F.collect_list(F.struct("status", "n")))
    codes = fetchlog.status_counts(log).agg(
        F.map_from_entries(F.transform(pairs, lambda c: F.struct(c["status"].cast("string"), c["n"])))
    )
    by_count = lambda a, b: F.when(a["n"] != b["n"], F.signum(b["n"] - a["n"]).cast("int")).when(
        a["host"] < b["host"], F.lit(-1)
    ).otherwise(F.lit(1))
    domains = fetchlog.top_domains(log, top).agg(F.array_sort(F.collect_list(F.struct("host", "n")), by_count))
    return fetchlog.run_totals(log, span).select(
        "total_pages",
        "successful",
        "failed",
        "pages_per_second",
        "elapsed_seconds",
        iso_time(F.col("started_at")).alias("started_at"),
        iso_time(F.col("finished_at")).alias("finished_at"),
        codes.scalar().alias("status_codes"),
        domains.scalar().alias("top_domains"),
    )


def error_report(attempts: DataFrame, failures: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    """The parts of an error report, each a table of its own.

    Counters are small; the URL listings grow with the data and stay distributed.
    """
    return {
        "errors_by_type": fetchlog.errors_by_type(attempts),
        "retries": fetchlog.retry_stats(attempts),
        "final_failures": fetchlog.final_failures(failures),
        "failed_urls": fetchlog.outcome_listing(results, "failed"),
        "blocked_urls": fetchlog.outcome_listing(results, "blocked").select("url"),
    }
