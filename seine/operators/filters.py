"""URL, host, size and robots predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from ..functions.net import blocked_ip
from ..functions.urls import hostname


def _check(spark: SparkSession, pattern: str) -> None:
    try:
        spark.sql("SELECT '' RLIKE :pattern", args={"pattern": pattern}).collect()  # folded, no job
    except PySparkException as error:
        raise ValueError(f"invalid URL filter pattern: {pattern!r}") from error


@dataclass(frozen=True)
class UrlFilter:
    """Same-domain, exclude and include rules for discovered links.

    Patterns search anywhere in the URL. They are Java regular expressions: the
    common subset with Python's holds, named groups and ``\\Z`` differ.
    """

    same_domain_only: bool = False
    exclude: Sequence[str] = ()
    include: Sequence[str] = ()

    def validate(self, spark: SparkSession) -> None:
        for pattern in (*self.exclude, *self.include):
            _check(spark, pattern)

    def pattern_condition(self, url: Column) -> Column:
        """No exclude pattern matches, and some include pattern if any is given."""
        keep = F.lit(True)
        for pattern in self.exclude:
            keep = keep & ~url.rlike(pattern)
        if self.include:
            wanted = F.lit(False)
            for pattern in self.include:
                wanted = wanted | url.rlike(pattern)
            keep = keep & wanted
        return keep

    def apply(self, links: DataFrame, seeds: DataFrame, url: str = "dst_url") -> DataFrame:
        """Links that pass. ``seeds`` has ``url``; its hosts are the allowed ones.

        The patterns run first, since they need no exchange.
        """
        self.validate(links.sparkSession)
        kept = links.where(self.pattern_condition(F.col(url)))
        return same_domain(kept, seeds, url) if self.same_domain_only else kept


def same_domain(links: DataFrame, seeds: DataFrame, url: str = "dst_url") -> DataFrame:
    """Links whose host equals that of some seed; a subdomain is another host.

    The host set is an aggregate; Spark broadcasts it when its measured size is
    under the join threshold and splits skewed link hosts when it is not.
    """
    hosts = seeds.select(hostname("url").alias("_seed_host")).distinct()
    return links.join(hosts, hostname(url).eqNullSafe(F.col("_seed_host")), "left_semi")


def blocked_hosts(host_ips: DataFrame) -> DataFrame:
    """Hosts of which any resolved address is non-public."""
    return host_ips.where(blocked_ip("ip")).select("host").distinct()


def guard_hosts(urls: DataFrame, host_ips: DataFrame, enabled: bool = True, url: str = "url") -> DataFrame:
    """Add ``host_blocked``: a literal non-public address, or any resolved one.

    A host without addresses or a URL without a host passes.
    """
    if not enabled:
        return urls.withColumn("host_blocked", F.lit(False))
    bad = blocked_hosts(host_ips).select(F.col("host").alias("_bad_host"))
    host = hostname(url)
    marked = urls.join(bad, host == F.col("_bad_host"), "left")
    verdict = F.col("_bad_host").isNotNull() | F.coalesce(blocked_ip(host), F.lit(False))
    return marked.withColumn("host_blocked", verdict).drop("_bad_host")


def is_oversize(html: Column, max_bytes: int, declared: Column | None = None) -> Column:
    """Strictly more bytes than the cap, by declared length or actual content."""
    over = F.coalesce(F.octet_length(html) > max_bytes, F.lit(False))
    return over if declared is None else over | F.coalesce(declared > max_bytes, F.lit(False))


def drop_seen(candidates: DataFrame, seen: DataFrame, url: str = "url") -> DataFrame:
    """Candidates whose exact URL was not seen before."""
    return candidates.join(seen.select(url), url, "left_anti")


def skip_open_circuits(replayed: DataFrame) -> DataFrame:
    """Requests a breaker denied, as failed rows."""
    return replayed.where(~F.col("allowed")).withColumn("reason", F.lit("circuit open"))
