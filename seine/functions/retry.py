"""Retry policy compiled to column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .errors import BASE, NETWORK, TRANSIENT


@dataclass(frozen=True)
class RetryPolicy:
    """How often and how late a failed fetch is tried again.

    ``max_retries`` is one limit, or an ordered mapping from error class to limit
    in which the base class matches everything; classes it does not name get
    ``default_retries``.
    """

    max_retries: int | Mapping[str, int] = 3
    backoff_factor: float = 2.0
    base_delay: float = 1.0
    max_delay: float = 60.0
    retry_on: tuple[str, ...] = field(default=(TRANSIENT, NETWORK))
    jitter: float = 0.0
    rate_limit_multiplier: float = 3.0
    default_retries: int = 0

    def __post_init__(self) -> None:
        limits = list(self.max_retries.values()) if isinstance(self.max_retries, Mapping) else [self.max_retries]
        if min([*limits, self.default_retries]) < 0:
            raise ValueError("retry limits must not be negative")

    @property
    def highest_limit(self) -> int:
        if isinstance(self.max_retries, Mapping):
            return max([*self.max_retries.values(), self.default_retries])
        return self.max_retries

    def retryable(self, error_class: Column) -> Column:
        names = self.retry_on
        if BASE in names:
            return error_class.isNotNull()
        return F.coalesce(error_class.isin(*names), F.lit(False))

    def limit(self, error_class: Column) -> Column:
        """Retries allowed for the error: the first matching class counts."""
        if not isinstance(self.max_retries, Mapping):
            return F.lit(self.max_retries)
        out = None
        for name, limit in self.max_retries.items():
            hit = F.lit(True) if name == BASE else error_class == name
            out = F.when(hit, F.lit(limit)) if out is None else out.when(hit, F.lit(limit))
        return F.lit(self.default_retries) if out is None else out.otherwise(F.lit(self.default_retries))

    def delay(self, status: Column, attempt: Column) -> Column:
        """Seconds to wait after failed attempt number ``attempt`` (from 0)."""
        scaled = F.lit(float(self.base_delay)) * F.pow(F.lit(float(self.backoff_factor)), attempt)
        slowed = F.when(status == 429, F.lit(float(self.rate_limit_multiplier))).otherwise(F.lit(1.0))
        capped = F.least(scaled * slowed, F.lit(float(self.max_delay)))
        return capped + F.rand() * self.jitter if self.jitter else capped


@dataclass(frozen=True)
class TimeoutPolicy:
    connect: float = 10.0
    read: float = 30.0
    total: float | None = None
    growth: float = 1.0

    def __post_init__(self) -> None:
        if self.growth < 1.0:
            raise ValueError("timeout growth must be at least 1.0")

    def columns(self, attempt: Column) -> list[Column]:
        factor = F.pow(F.lit(float(self.growth)), attempt)
        total = F.lit(float(self.total)) * factor if self.total else F.lit(None).cast("double")
        return [
            (F.lit(float(self.connect)) * factor).alias("connect_s"),
            (F.lit(float(self.read)) * factor).alias("read_s"),
            total.alias("total_s"),
        ]


def retry_schedule(
    failures: DataFrame, key: str, policy: RetryPolicy, timeouts: TimeoutPolicy = TimeoutPolicy()
) -> DataFrame:
    """Per failed operation, the attempts it may take with waits and budgets.

    ``failures`` has ``key``, ``error_class`` and ``status``. Attempt 0 is always
    made; later ones only for retryable classes within their limit. ``wait_s`` is
    the pause after a failed attempt, null after the last. The running sum is a
    closed expression over the short attempt array, so no shuffle is needed.
    """
    limit = F.when(policy.retryable(F.col("error_class")), policy.limit(F.col("error_class"))).otherwise(F.lit(0))
    plan = failures.select(
        key, "error_class", "status", limit.alias("last_attempt"),
        F.explode(F.sequence(F.lit(0), limit)).alias("attempt"),
    )
    waits = lambda upto: F.aggregate(
        F.sequence(F.lit(0), upto), F.lit(0.0), lambda total, n: total + policy.delay(F.col("status"), n)
    )
    return plan.select(
        key,
        "error_class",
        "attempt",
        F.when(F.col("attempt") < F.col("last_attempt"), policy.delay(F.col("status"), F.col("attempt"))).alias("wait_s"),
        F.when(F.col("attempt") > 0, waits(F.col("attempt") - 1)).otherwise(F.lit(0.0)).alias("waited_s"),
        *timeouts.columns(F.col("attempt")),
        (F.col("attempt") == F.col("last_attempt")).alias("is_last"),
    )


def flag_attempts(attempts: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Mark the final attempt of each ``op_id`` and whether it gave up.

    One operation has at most ``limit + 1`` rows, so the window stays small.
    """
    ops = Window.partitionBy("op_id").orderBy("attempt")
    final = F.lead("attempt").over(ops).isNull()
    spent = policy.retryable(F.col("error_class")) & (F.col("attempt") >= policy.limit(F.col("error_class")))
    return attempts.withColumns({"is_final": final, "gave_up": final & F.coalesce(spent, F.lit(False))})
