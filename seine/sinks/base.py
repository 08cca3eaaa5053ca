"""The sink protocol, fan-out and retries."""

from __future__ import annotations

import abc
import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.retry import RetryPolicy
from ..session import cut_lineage

logger = logging.getLogger(__name__)


class SinkError(Exception):
    """A write that may be tried again."""


class PageSink(abc.ABC):
    """Extension point: subclass it to write batches anywhere.

    ``write`` must be idempotent per ``batch_id``: a new id adds rows, and writing a
    known id again replaces what the first try left, which is what makes retries
    and restarts exact. Ids are the caller's to choose.
    """

    def init(self, spark: SparkSession) -> None:  # noqa: B027 - optional hook
        pass

    @abc.abstractmethod
    def write(self, batch: DataFrame, batch_id: int) -> None: ...

    def close(self) -> None:  # noqa: B027 - optional hook
        pass


class FanOut(PageSink):
    """Write every batch to all sinks; one that fails does not stop the others."""

    def __init__(self, sinks: Sequence[PageSink]) -> None:
        self.sinks = list(sinks)

    def init(self, spark: SparkSession) -> None:
        for sink in self.sinks:
            sink.init(spark)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        # Held as a table, so that a lost executor does not cost the batch.
        held = cut_lineage(batch, "fan_out") if len(self.sinks) > 1 else batch
        failures = []
        for sink in self.sinks:
            try:
                sink.write(held, batch_id)
            except Exception as error:  # noqa: BLE001 - reported below
                failures.append(error)
        if failures:
            raise SinkError(f"{len(failures)}/{len(self.sinks)} storages failed: {failures[0]}") from failures[0]

    def close(self) -> None:
        for sink in self.sinks:
            try:
                sink.close()
            except Exception as error:  # noqa: BLE001 - closing goes on
                logger.warning("sink close failed: %s", error)


class Retrying(PageSink):
    """Retry one leaf sink. Wrap the leaves and fan out over them: retrying a
    fan-out would write again to the sinks that had succeeded."""

    def __init__(
        self, inner: PageSink, policy: RetryPolicy = RetryPolicy(), sleep: Callable[[float], None] = time.sleep
    ) -> None:
        if isinstance(inner, FanOut):
            raise ValueError("retry each sink, not the fan-out")
        self.inner, self.policy, self.sleep = inner, policy, sleep

    def init(self, spark: SparkSession) -> None:
        self.inner.init(spark)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        policy, attempt = self.policy, 0
        while True:
            try:
                return self.inner.write(batch, batch_id)
            except Exception:  # noqa: BLE001 - a sink may raise errors of its own
                if attempt >= policy.highest_limit:
                    raise
            self.sleep(min(policy.base_delay * policy.backoff_factor**attempt, policy.max_delay))
            attempt += 1

    def close(self) -> None:
        self.inner.close()


def save(sink: PageSink, batch: DataFrame, batch_id: int = 0, on_error: str = "raise") -> bool:
    """Write a batch. With ``on_error='warn'`` a sink failure is logged and False
    is returned: saving trouble must not sink the job whose rows these are."""
    if on_error not in ("raise", "warn"):
        raise ValueError("on_error is 'raise' or 'warn'")
    try:
        sink.write(batch, batch_id)
    except Exception as error:  # noqa: BLE001 - a sink may raise errors of its own
        if on_error == "raise":
            raise
        logger.warning("batch %s not saved: %s", batch_id, error)
        return False
    return True
