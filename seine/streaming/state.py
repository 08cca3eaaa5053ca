"""Keyed state: circuit breaker and last request per host.

State per key is one small row. Within a micro-batch a key's rows are taken in
(ts, seq) order; across micro-batches, in arrival order. Size the micro-batches
(``maxFilesPerTrigger``) so that the busiest host's share of one fits a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.breaker import CLOSED, OPEN, BreakerPolicy, walk
from ..operators.politeness import PacePolicy

BREAKER_ROWS = "seq long, host string, ts_us long, ok boolean, allowed boolean, state_after string"
_BREAKER_STATE = "opened_at long, failures int"
PACE_ROWS = "seq long, pace_key string, ts_us long, gap_s double, wait_s double, violation boolean"
_PACE_STATE = "last_us long"


def _in_order(pieces: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(pieces)).sort_values(["ts_us", "seq"], ignore_index=True)


def stream_breaker(log: DataFrame, policy: BreakerPolicy = BreakerPolicy()) -> DataFrame:
    """Allow or deny each outcome of a streaming log (seq, host, ts, ok)."""

    def step(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _in_order(pieces)
        opened, failures = state.get if state.exists else (-1, 0)
        allowed, is_open, opened, failures = walk(
            rows["ts_us"].to_numpy(), rows["ok"].to_numpy(bool), None if opened < 0 else opened, failures, policy
        )
        state.update((-1 if opened is None else int(opened), int(failures)))
        rows["allowed"] = allowed
        rows["state_after"] = np.where(is_open, OPEN, CLOSED)
        yield rows[["seq", "host", "ts_us", "ok", "allowed", "state_after"]]

    slim = log.select("seq", "host", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "ok")
    return slim.groupBy("host").applyInPandasWithState(
        step, BREAKER_ROWS, _BREAKER_STATE, "append", GroupStateTimeout.NoTimeout
    )


def stream_pace(requests: DataFrame, policy: PacePolicy, required_s: float | None = None) -> DataFrame:
    """Gap, needed wait and violation of each streaming request (seq, host, ts)."""
    needed = required_s if required_s is not None else max(1.0 / policy.requests_per_second, policy.min_delay)

    def step(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _in_order(pieces)
        before = rows["ts_us"].shift(1).astype("float64")
        if state.exists:
            before.iloc[0] = state.get[0]
        state.update((int(rows["ts_us"].iloc[-1]),))
        gap = (rows["ts_us"] - before) / 1e6
        rows["gap_s"] = gap
        rows["wait_s"] = (needed - gap).clip(lower=0.0).fillna(0.0)
        rows["violation"] = gap < needed
        yield rows[["seq", "pace_key", "ts_us", "gap_s", "wait_s", "violation"]]

    slim = requests.select(
        "seq", policy.key("host").alias("pace_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us")
    )
    return slim.groupBy("pace_key").applyInPandasWithState(
        step, PACE_ROWS, _PACE_STATE, "append", GroupStateTimeout.NoTimeout
    )
