"""Request pacing: audit of a log, and a paced fetch list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import HEAVY_ROWS, Ordered, number_rows


@dataclass(frozen=True)
class PacePolicy:
    requests_per_second: float = 1.0
    min_delay: float = 0.0
    per_host: bool = True

    def __post_init__(self) -> None:
        if self.requests_per_second <= 0:
            raise ValueError("requests_per_second must be greater than zero")

    def required(self, crawl_delay: Column | None = None) -> Column:
        """Seconds that must lie between two requests of a key."""
        floor = F.lit(float(max(1.0 / self.requests_per_second, self.min_delay)))
        return floor if crawl_delay is None else F.greatest(floor, F.coalesce(crawl_delay, F.lit(0.0)))

    def key(self, host: str) -> Column:
        shared = F.lit("__global__")
        return F.coalesce(F.nullif(F.col(host), F.lit("")), shared) if self.per_host else shared


def audit_pace(
    requests: DataFrame,
    policy: PacePolicy,
    *,
    crawl_delay: Column | None = None,
    host: str = "host",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add pace_key, gap_s, required_s, wait_s and violation to timed requests.

    The gap is to the request before on the same key, null for the first. Global
    pacing has a single key, whose rows are cut like any hot host's.
    """
    keyed = requests.withColumns({"pace_key": policy.key(host), "_us": F.unix_micros(F.col("ts").cast("timestamp"))})
    lagged = Ordered(keyed, ["pace_key"], ["ts", "seq"], heavy_rows).add(max_before={"_prev": "_us"}).rows()
    gap, required = (F.col("_us") - F.col("_prev")) / F.lit(1_000_000.0), policy.required(crawl_delay)
    return lagged.withColumns({
        "gap_s": gap,
        "required_s": required,
        "wait_s": F.coalesce(F.greatest(required - gap, F.lit(0.0)), F.lit(0.0)),
        "violation": F.coalesce(gap < required, F.lit(False)),
    }).drop("_us", "_prev")


def paced_fetch_list(
    urls: DataFrame,
    policy: PacePolicy,
    order: list[str],
    *,
    crawl_delay: Column | None = None,
    host: str = "host",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add the rank of each URL within its host and its earliest send offset."""
    keyed = urls.withColumn("pace_key", policy.key(host))
    ranked = number_rows(keyed, ["pace_key"], order, out="rank", heavy_rows=heavy_rows)
    return ranked.withColumn("send_offset_s", (F.col("rank") - 1) * policy.required(crawl_delay))
