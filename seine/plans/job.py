"""A whole capture job: seeds, crawl, parsed records and run statistics."""

from __future__ import annotations

import functools
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import hostname
from ..operators.extract import parse_pages
from ..operators.fetchlog import errors_by_type, outcome_listing
from ..operators.filters import UrlFilter
from ..operators.records import page_records
from ..session import cut_lineage
from ..sinks.base import PageSink, save
from ..sources.robots import agent_rules, parse_robots
from ..sources.sitemaps import expand_sitemaps, seed_urls
from .crawl import CrawlPolicy, CrawlRun, crawl
from .summary import run_summary


# Batch ids of a run, one for each wave.
WAVES = 1000


@dataclass
class JobResult:
    """``run``: the crawl; ``records``: saved rows; ``log``: one outcome per fetched
    URL, the input of the fetch-log aggregates; ``started`` and ``finished``: seconds since 1970."""

    run: CrawlRun
    records: DataFrame
    log: DataFrame
    started: float
    finished: float

    def summary(self, top: int = 10) -> DataFrame:
        """The run's summary over its true start and finish."""
        at = lambda seconds: F.timestamp_micros(F.lit(int(seconds * 1e6)))
        return run_summary(self.log, top, (at(self.started), at(self.finished)))

    def errors(self) -> dict[str, DataFrame]:
        """Failed pages by class, and the failed and blocked URLs with their reasons."""
        return {
            "errors_by_type": errors_by_type(self.log),
            "failed_urls": outcome_listing(self.run.results, "failed"),
            "blocked_urls": outcome_listing(self.run.results, "blocked"),
        }


@dataclass(frozen=True)
class CaptureJob:
    """The parameters of a job; defaults suit a polite, bounded run."""

    start_urls: Sequence[str] = ()
    sitemap_url: str | None = None
    max_pages: int = 100
    max_depth: int = 2
    respect_robots: bool = True
    user_agent: str = "MyBot/1.0"
    same_domain_only: bool = False
    exclude_patterns: Sequence[str] = ()
    include_patterns: Sequence[str] = ()
    allow_private_hosts: bool = False
    max_page_bytes: int = 5_000_000
    max_index_depth: int = 3

    def seeds(self, captures: DataFrame, sitemap_docs: DataFrame | None) -> DataFrame:
        """Start URLs, then those of the sitemap, with one order path."""
        spark = captures.sparkSession
        start = spark.createDataFrame([(url, pos) for pos, url in enumerate(self.start_urls)], "url string, pos int")
        sitemap = None
        if self.sitemap_url and sitemap_docs is not None:
            root = spark.createDataFrame([(self.sitemap_url,)], "url string")
            sitemap = expand_sitemaps(root, sitemap_docs, self.max_index_depth)
        seeds = seed_urls(start, sitemap)
        return seeds.select("url", F.concat(F.array("origin"), "path").alias("path"))

    def run(
        self,
        captures: DataFrame,
        *,
        seeds: DataFrame | None = None,
        robots_docs: DataFrame | None = None,
        sitemap_docs: DataFrame | None = None,
        host_ips: DataFrame | None = None,
        open_circuits: DataFrame | None = None,
        sink: PageSink | None = None,
        run_id: int | None = None,
    ) -> JobResult:
        """Crawl ``captures`` (url, html and optionally status_code, content_type).

        Only pages a wave reaches are parsed, so the work follows the budget and
        not the size of the capture table. ``seeds`` (url, pos or path) replaces
        the start URLs when there are too many to list. Records go to ``sink`` one
        wave at a time; a sink's failure is logged and the job goes on. A page that cannot
        be read has failed with a ParseError and is not saved; one without html is such.

        ``run_id`` (0 or more) numbers what the run saves: run again under its id, a job
        replaces its own waves, and a greater id adds to them. Without one the clock gives it.
        """
        spark = captures.sparkSession
        for name, default in (("status_code", F.lit(200)), ("content_type", F.lit(""))):
            if name not in captures.columns:
                captures = captures.withColumn(name, default)
        # Written once: a wave meets these slim rows, and reads html only to parse.
        facts = cut_lineage(captures.select("url", "status_code", F.octet_length("html").alias("n_bytes")), "captured")
        robots = None
        if self.respect_robots and robots_docs is not None:
            robots = agent_rules(parse_robots(robots_docs), self.user_agent)
        policy = CrawlPolicy(
            self.max_depth, self.max_pages,
            UrlFilter(self.same_domain_only, tuple(self.exclude_patterns), tuple(self.include_patterns)),
            self.max_page_bytes, self.allow_private_hosts,
        )
        parsed_waves: list[DataFrame] = []
        started = time.time()
        # Batch ids of this run: a later run appends to what earlier runs saved.
        first_batch = (int(started * 1000) if run_id is None else run_id) * WAVES
        if sink is not None:
            sink.init(spark)

        def open_pages(parents: DataFrame) -> DataFrame:
            pages = parents.withColumnRenamed("src_url", "url").join(captures, "url")
            parsed = cut_lineage(
                parse_pages(pages, keep=("url", "path", "status_code", "content_type"), error="error")
                .withColumn("crawled_at", F.current_timestamp()),
                "parsed",
            )
            good = parsed.where("error IS NULL")
            parsed_waves.append(good)
            if sink is not None:
                save(sink, page_records(good, F.col("crawled_at")), first_batch + len(parsed_waves), on_error="warn")
            return parsed.select(F.col("url").alias("src_url"), "path", "links", "error")

        start = self.seeds(captures, sitemap_docs) if seeds is None else seeds
        run = crawl(
            start, open_pages, facts, policy, robots=robots,
            # Literal addresses are guarded even when no host was resolved.
            host_ips=spark.createDataFrame([], "host string, ip string") if host_ips is None else host_ips,
            open_circuits=open_circuits,
        )
        if sink is not None:
            sink.close()
        if parsed_waves:
            parsed = functools.reduce(DataFrame.unionByName, parsed_waves)
            records = page_records(parsed, F.col("crawled_at"))
        else:
            records = page_records(parse_pages(captures.limit(0), keep=("url", "status_code", "content_type")))
        return JobResult(run, records, _fetch_log(run, started), started, time.time())


def _fetch_log(run: CrawlRun, started: float) -> DataFrame:
    """Outcomes that count in run statistics: fetched pages, good or failed.

    Blocked URLs and open-circuit skips were never requested. A page's time is
    its wave's.
    """
    fetched = run.results.where(
        (F.col("outcome") != "blocked") & ~F.coalesce(F.col("reason") == "circuit open", F.lit(False))
    )
    at = run.waves.select("depth", F.timestamp_micros(((F.lit(started) + F.col("elapsed_s")) * 1e6).cast("long")).alias("ts"))
    failed = F.col("outcome") == "failed"
    return fetched.join(at, "depth").select(
        F.xxhash64("url").alias("seq"),
        "ts",
        hostname("url").alias("host"),
        "url",
        F.col("status_code").alias("status"),
        F.when(failed, F.split("reason", ": ")[0]).alias("error_class"),
    )
