"""Per-host circuit breaker replayed over an ordered outcome log.

The breaker is a fold over a host's events. Rows are sorted by host and time and walked
batch by batch, carrying only the instant of opening and the failure count. The log of a
hot host is cut by rows into parts, since the fold splits: each part is a function from
the state it starts in to the state it ends in. The state is either closed with a failure
count below the threshold, or open since some instant, of which only the first event at or
after the recovery counts. So

1. per part of a hot host: the part's function, in numpy, over its times and outcomes;
2. per hot host: run its part functions in order to get each part's start;
3. per host or part: walk its rows from the start and mark every one.

A part has a bounded number of rows however they bunch in time, and results are exactly
those of the sequential fold.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .ordered import HEAVY_ROWS, null_safe, range_parts, split_heavy

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"


@dataclass(frozen=True)
class BreakerPolicy:
    threshold: int = 5
    recovery_s: float = 30.0

    def __post_init__(self) -> None:
        if self.threshold < 1:
            raise ValueError("failure threshold must be at least 1")

    @property
    def recovery_us(self) -> int:
        return int(round(self.recovery_s * 1_000_000))


def _failure_runs(ok: np.ndarray) -> np.ndarray:
    """Position of each event in its run of failures, from 1; 0 for successes."""
    index = np.arange(len(ok))
    last_ok = np.maximum.accumulate(np.where(ok, index, -1))
    return index - last_ok


def walk(ts: np.ndarray, ok: np.ndarray, opened_at: int | None, failures: int, policy: BreakerPolicy):
    """Mark a stretch of one host's events from a known start.

    Returns (allowed, open_after, opened_at, failures): two boolean arrays and
    the state after the last event. ``opened_at`` is None while closed.
    """
    n = len(ts)
    allowed, open_after = np.ones(n, bool), np.zeros(n, bool)
    runs = _failure_runs(ok)
    trips = np.flatnonzero(runs == policy.threshold)
    lead = n if not (oks := np.flatnonzero(ok)).size else int(oks[0])
    at = 0
    while at < n:
        if opened_at is not None:
            probe = max(at, int(np.searchsorted(ts, opened_at + policy.recovery_us, "left")))
            allowed[at:probe] = False
            open_after[at:probe] = True
            if probe >= n:
                break
            if ok[probe]:
                opened_at, failures = None, 0
            else:
                opened_at = int(ts[probe])
                open_after[probe] = True
            at = probe + 1
            continue
        if at == 0 and lead and failures + lead >= policy.threshold:
            trip = max(policy.threshold - failures - 1, 0)
        else:
            later = int(np.searchsorted(trips, at, "left"))
            trip = int(trips[later]) if later < len(trips) else n
        if trip >= n:
            failures = failures + n if at == 0 and lead == n else int(runs[-1])
            break
        opened_at, failures = int(ts[trip]), policy.threshold
        open_after[trip] = True
        at = trip + 1
    return allowed, open_after, opened_at, failures


def chunk_function(ts: np.ndarray, ok: np.ndarray, start_us: int, policy: BreakerPolicy) -> dict:
    """What a part does to every state it can start in.

    ``closed_open[f]``/``closed_failures[f]``: the end after starting closed with f
    failures. ``step_until``/``step_open``/``step_failures``: the end after starting
    open with recovery at or before ``step_until`` and after the step before; a
    recovery later than the last step leaves the chunk open as it was. An end is
    an opening instant (-1 when closed) and a failure count.
    """
    n, limit = len(ts), policy.threshold
    runs = _failure_runs(ok)
    trips = np.flatnonzero(runs == limit)
    index = np.arange(n)
    # Node i < n: just opened by event i. Node n: closed to the end of the chunk.
    probe = np.maximum(np.searchsorted(ts, ts + policy.recovery_us, "left"), index + 1)

    def after_probe(position: np.ndarray) -> np.ndarray:
        """Next opening when events at ``position`` are probes; n if closed to the end."""
        later = np.searchsorted(trips, position, "right")
        reopened = np.append(trips, n)[later]
        return np.where(ok[position], reopened, position)

    step = np.append(index, n)
    inside = probe < n
    step[:n][inside] = after_probe(probe[inside])
    while True:
        further = step[step]
        if np.array_equal(further, step):
            break
        step = further

    def ends(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = step[nodes]
        is_open = last < n
        opened = np.where(is_open, ts[np.minimum(last, n - 1)], -1)
        return opened, np.where(is_open, limit, runs[-1])

    closed_open, closed_failures = [], []
    for failures in range(limit):
        _, _, opened, count = walk(ts, ok, None, failures, policy)
        closed_open.append(-1 if opened is None else opened)
        closed_failures.append(count)

    # An earlier opening recovers before start + recovery; the first event at or
    # after that bound is the last one that can be its probe.
    reach = min(n, int(np.searchsorted(ts, start_us + policy.recovery_us, "left")) + 1)
    positions = index[:reach]
    opened, failures = ends(after_probe(positions))
    change = np.append((opened[1:] != opened[:-1]) | (failures[1:] != failures[:-1]), True)
    return {
        "closed_open": closed_open,
        "closed_failures": closed_failures,
        "step_until": ts[:reach][change],
        "step_open": opened[change],
        "step_failures": failures[change],
    }


_FUNCTION = T.StructType([
    T.StructField("_host", T.StringType()),
    T.StructField("_part", T.IntegerType()),
    T.StructField("closed_open", T.ArrayType(T.LongType())),
    T.StructField("closed_failures", T.ArrayType(T.IntegerType())),
    T.StructField("step_until", T.ArrayType(T.LongType())),
    T.StructField("step_open", T.ArrayType(T.LongType())),
    T.StructField("step_failures", T.ArrayType(T.IntegerType())),
])
_START = T.StructType([
    T.StructField("_host", T.StringType()),
    T.StructField("_part", T.IntegerType()),
    T.StructField("_opened_at", T.LongType()),
    T.StructField("_failures", T.IntegerType()),
])


def _flags(column: pa.Array) -> np.ndarray:
    """A boolean column; null is false."""
    return column.fill_null(False).to_numpy(zero_copy_only=False)


def _summarise(policy: BreakerPolicy):
    """The function of one part of a host, from its sorted times and outcomes."""
    arrow = to_arrow_schema(_FUNCTION)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("_us").to_numpy(), _flags(b.column("_ok"))) for b in batches]
        ts, ok = (np.concatenate(x) for x in zip(*held))
        made = chunk_function(ts, ok, int(ts[0]), policy)
        yield pa.RecordBatch.from_pylist([{"_host": key[1].as_py(), "_part": key[0].as_py(), **made}], schema=arrow)

    return run


def starting_states(policy: BreakerPolicy):
    """Run part functions, sorted by host and part, to the state each part starts in."""
    arrow = to_arrow_schema(_START)

    def run(batches):
        host, opened, failures = None, -1, 0
        for batch in batches:
            rows = []
            for f in batch.to_pylist():
                if f["_host"] != host:
                    host, opened, failures = f["_host"], -1, 0
                rows.append({"_host": host, "_part": f["_part"], "_opened_at": opened, "_failures": failures})
                if opened < 0:
                    opened, failures = f["closed_open"][failures], f["closed_failures"][failures]
                    continue
                at = bisect_left(f["step_until"], opened + policy.recovery_us)
                if at < len(f["step_until"]):
                    opened, failures = f["step_open"][at], f["step_failures"][at]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return run


def mark(policy: BreakerPolicy, names: list[str], arrow: pa.Schema):
    """Walk batches sorted by host and time, carrying the state from batch to batch.

    A host starts in the state of its first row's ``_opened_at`` and ``_failures``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, opened, failures = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            hosts = batch.column("_host")
            codes = hosts.dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), batch.num_rows]
            ts, ok = batch.column("_us").to_numpy(), _flags(batch.column("_ok"))
            allowed, is_open = np.empty(len(ts), bool), np.empty(len(ts), bool)
            for low, high in zip(edges[:-1], edges[1:]):
                if hosts[low].as_py() != host:
                    host, since = hosts[low].as_py(), batch.column("_opened_at")[low].as_py()
                    opened, failures = None if since < 0 else since, batch.column("_failures")[low].as_py()
                allowed[low:high], is_open[low:high], opened, failures = walk(ts[low:high], ok[low:high], opened, failures, policy)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(allowed), pa.array(np.where(is_open, OPEN, CLOSED).tolist(), pa.string())], schema=arrow
            )

    return run


def replay_breaker(
    log: DataFrame,
    policy: BreakerPolicy = BreakerPolicy(),
    *,
    host: str = "host",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``allowed`` and ``state_after`` to every row of an outcome log.

    Rows are taken per ``host`` in (``ts``, ``seq``) order; null hosts are the empty one. A
    denied row does not touch the state, and a null ``ok`` counts as a failure. Rows without
    a time come before all others: they are allowed and leave the breaker closed as it
    starts. A host of more than ``heavy_rows`` rows is cut into parts of about half as many.
    """
    timed = log.withColumns({
        "_host": F.coalesce(F.col(host), F.lit("")), "_us": F.unix_micros(F.col(ts).cast("timestamp")), "_seq": F.col(seq), "_ok": F.col(ok),
    })
    untimed = log.where(F.col(ts).isNull()).withColumns({"allowed": F.lit(True), "state_after": F.lit(CLOSED)})
    light, hot, parts = split_heavy(timed.where("_us IS NOT NULL"), ["_host"], heavy_rows)

    out_schema = T.StructType([T.StructField(f.name, f.dataType) for f in log.schema] + [
        T.StructField("allowed", T.BooleanType()),
        T.StructField("state_after", T.StringType()),
    ])
    marking = mark(policy, log.columns, to_arrow_schema(out_schema))
    closed = {"_opened_at": F.lit(-1).cast("long"), "_failures": F.lit(0)}
    done = light.repartition("_host").sortWithinPartitions("_host", "_us", "_seq").withColumns(closed).mapInArrow(marking, out_schema)
    if hot is not None:
        held = range_parts(hot, ["_host", "_us", "_seq"], parts, "_host", "_us", "_seq")
        # Sorted rows reach their group in this order, and the bucketed table spares both groupings an exchange.
        slim = held.select("_part", "_host", "_us", "_seq", "_ok").sortWithinPartitions("_part", "_host", "_us", "_seq")
        functions = slim.groupBy("_part", "_host").applyInArrow(_summarise(policy), _FUNCTION)
        starts = functions.repartition("_host").sortWithinPartitions("_host", "_part").mapInArrow(starting_states(policy), _START)
        started = null_safe(held, cut_lineage(starts, "breaker_starts"), ["_part", "_host"], "inner")
        started = started.sortWithinPartitions("_part", "_host", "_us", "_seq")
        done = done.unionByName(started.groupBy("_part", "_host").applyInArrow(marking, out_schema))
    return done.unionByName(untimed.select(*out_schema.names))


def breaker_states(replayed: DataFrame, host: str = "host", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The last state of each host and how many of its requests were denied."""
    return replayed.groupBy(host).agg(
        F.max_by("state_after", F.struct(ts, seq)).alias("state"),
        F.count_if(~F.col("allowed")).alias("denied"),
    )
