"""Bucketed windows, attempts, pacing and the breaker against plain folds."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seine.functions.retry import RetryPolicy
from seine.operators import ordered
from seine.operators.attempts import number_attempts
from seine.operators.breaker import BreakerPolicy, breaker_states, replay_breaker, walk
from seine.operators.ordered import Ordered, number_rows, range_parts
from seine.operators.politeness import PacePolicy, audit_pace, paced_fetch_list

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def log_of(spark, events):
    """events: (host, seconds, error_class, status)"""
    rows = [(i, h, START + timedelta(seconds=s), e, st) for i, (h, s, e, st) in enumerate(events)]
    return spark.createDataFrame(rows, "seq long, host string, ts timestamp, error_class string, status int")


@pytest.mark.parametrize("heavy", [90, 200, 10**6])
def test_ordered_columns_equal_plain_windows(spark, heavy):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("aaaab"), rnd.randint(0, 2000), rnd.choice([None, 1, 2])) for i in range(600)]
    frame = spark.createDataFrame(rows, "seq long, k string, t int, v long")
    w = Window.partitionBy("k").orderBy("t", "seq")
    plain = frame.withColumns({
        "prev": F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "total": F.sum(F.coalesce("v", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "rn": F.row_number().over(w),
        "top": F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "ends": F.lead("seq").over(w).isNull(),
    }).select("seq", "k", "t", "v", "prev", "top", "total", "ends", "rn")
    base = frame.withColumn("v0", F.coalesce("v", F.lit(0)))
    got = Ordered(base, ["k"], ["t", "seq"], heavy).add(
        last_before={"prev": "v"}, max_before={"top": "v"}, running_sum={"total": "v0"}, last_row="ends",
    ).rows().drop("v0")
    got = number_rows(got, ["k"], ["t", "seq"], heavy_rows=heavy).select(*plain.columns)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in plain.collect()}


def test_parts_are_bounded_until_they_are_large(spark, monkeypatch):
    """What every part sends to the driver must not grow with the log while parts are small."""
    rows = spark.range(3000).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    assert ordered.split_heavy(rows, ["k"], 100)[2] == 60
    assert ordered.split_heavy(rows, ["k"], 2)[2] == 1000
    monkeypatch.setattr(ordered, "MAX_PARTS", 3)
    assert ordered.split_heavy(rows, ["k"], 2)[2] == 3
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 500)
    assert ordered.split_heavy(rows, ["k"], 2)[2] == 12
    got = number_rows(rows, ["k"], ["t"], heavy_rows=2).where("rn = t + 1").count()
    assert got == 3000


def fold(events, policy):
    """The breaker, one event at a time."""
    state, failures, opened, out = "closed", 0, 0, []
    for ts, ok in events:
        if state == "open":
            if ts - opened < policy.recovery_us:
                out.append((False, "open"))
                continue
            state = "half_open"
        if ok:
            state, failures = "closed", 0
        elif state == "half_open":
            state, opened = "open", ts
        else:
            failures += 1
            if failures >= policy.threshold:
                state, opened = "open", ts
        out.append((True, state))
    return out


@pytest.mark.parametrize("threshold,recovery,spacing,bad", [
    (3, 30, 9, 0.6), (1, 5, 2, 0.3), (2, 40, 1, 0.9), (5, 30, 20, 0.75), (3, 7, 7, 1.0), (2, 0, 3, 0.5),
])
def test_breaker_replay_equals_the_fold(spark, threshold, recovery, spacing, bad):
    rnd = random.Random(threshold * 100 + recovery)
    policy, events, at = BreakerPolicy(threshold, recovery), [], 0
    for _ in range(1500):
        at += rnd.choice([0, spacing, spacing, 2 * spacing, 400 if rnd.random() < 0.02 else spacing])
        host = "hot" if rnd.random() < 0.8 else rnd.choice(["x", "y"])
        events.append((host, at, "TransientError" if rnd.random() < bad else None, None))
    log = log_of(spark, events).withColumn("ok", F.col("error_class").isNull())
    got = {r.seq: (r.allowed, r.state_after) for r in replay_breaker(log, policy).collect()}
    # The hot host in many chunks as well.
    split = {r.seq: (r.allowed, r.state_after) for r in replay_breaker(log, policy, heavy_rows=200).collect()}
    want = {}
    for host in ("hot", "x", "y"):
        mine = [(i, s * 1_000_000, e is None) for i, (h, s, e, _) in enumerate(events) if h == host]
        want.update(zip([i for i, _, _ in mine], fold([(t, ok) for _, t, ok in mine], policy)))
    assert got == want
    assert split == want


@pytest.mark.parametrize("seed", range(40))
def test_chunk_functions_compose_to_the_fold(seed):
    """Any cut into chunks, and any state at a cut, gives what the fold gives."""
    import pyarrow as pa

    from seine.operators.breaker import chunk_function, starting_states

    rnd = random.Random(seed)
    policy = BreakerPolicy(rnd.choice([1, 2, 3, 5]), rnd.choice([3, 10, 25]))
    width = rnd.choice([7, 40, 90])
    ts = np.cumsum([rnd.choice([0, 1, 2, 5, 60]) for _ in range(300)]) * 1_000_000
    ok = np.array([rnd.random() < rnd.choice([0.2, 0.5]) for _ in range(300)])
    chunks = np.arange(300) // width
    rows = []
    for chunk in np.unique(chunks):
        pick = chunks == chunk
        rows.append({"_host": "h", "_part": chunk, **chunk_function(ts[pick], ok[pick], int(ts[pick][0]), policy)})
    starts = next(starting_states(policy)([pa.RecordBatch.from_pylist(rows)])).to_pylist()
    got = []
    for start in starts:
        pick, since = chunks == start["_part"], start["_opened_at"]
        allowed, is_open, _, _ = walk(ts[pick], ok[pick], None if since < 0 else since, start["_failures"], policy)
        got += [(bool(a), "open" if o else "closed") for a, o in zip(allowed, is_open)]
    assert got == fold(list(zip(ts.tolist(), ok.tolist())), policy)


def test_breaker_cases(spark):
    bad, good = "TransientError", None
    events = [("s", 0, bad, 503), ("s", 1, bad, 503), ("s", 2, bad, 503), ("s", 3, good, 200), ("s", 33, good, 200),
              ("f", 0, bad, 503), ("f", 1, bad, 503), ("f", 2, bad, 503), ("f", 40, bad, 503), ("f", 41, good, 200), ("o", 3, good, 200)]
    log = log_of(spark, events).withColumn("ok", F.col("error_class").isNull())
    replayed = replay_breaker(log, BreakerPolicy(3, 30.0))
    rows = [(r.allowed, r.state_after) for r in replayed.orderBy("seq").collect()]
    assert rows == [
        (True, "closed"), (True, "closed"), (True, "open"), (False, "open"), (True, "closed"),
        (True, "closed"), (True, "closed"), (True, "open"), (True, "open"), (False, "open"), (True, "closed"),
    ]
    states = {r.host: (r.state, r.denied) for r in breaker_states(replayed).collect()}
    assert states == {"s": ("closed", 1), "f": ("open", 1), "o": ("closed", 0)}
    with pytest.raises(ValueError):
        BreakerPolicy(0)


@pytest.mark.parametrize("heavy", [1, 10**6])
def test_attempts_from_outcomes(spark, heavy):
    bad = "TransientError"
    events = [("a", 0, bad, 503), ("a", 1, bad, 503), ("a", 2, bad, 503), ("a", 3, bad, 503), ("a", 4, None, 200),
              ("a", 5, "PermanentError", 404), ("a", 9000, bad, 429)]
    rows = number_attempts(log_of(spark, events), RetryPolicy(max_retries=2), heavy_rows=heavy).orderBy("seq").collect()
    assert [r.attempt for r in rows] == [0, 1, 2, 0, 1, 0, 0]
    assert [r.gave_up for r in rows] == [False, False, True, False, False, False, False]
    assert [r.is_final for r in rows] == [False, False, True, False, True, True, True]
    assert [r.wait_s for r in rows] == [1, 2, None, 1, None, None, None]


@pytest.mark.parametrize("heavy", [1, 10**6])
def test_attempts_of_rows_without_a_time(spark, heavy):
    """Null times come first, on the plain and on the bucketed path; a key of null times only ends in its last one."""
    bad = "TransientError"
    events = [("a", 0, bad, 503), ("a", 0, bad, 503), ("a", 1, bad, 503), ("a", 9000, bad, 503), ("b", 0, bad, 503), ("b", 0, bad, 503)]
    log = log_of(spark, events).withColumn("ts", F.when(~F.col("seq").isin(0, 1, 4, 5), F.col("ts")))
    rows = number_attempts(log, RetryPolicy(max_retries=9), heavy_rows=heavy).orderBy("seq").collect()
    assert [r.attempt for r in rows] == [0, 1, 2, 3, 0, 1]
    assert [r.is_final for r in rows] == [False, False, False, True, False, True]
    assert [r.wait_s is None for r in rows] == [False, False, False, True, False, True]
    audited = audit_pace(log, PacePolicy(10), heavy_rows=heavy).orderBy("seq").collect()
    assert [r.gap_s for r in audited] == [None, None, None, 8999, None, None]


@pytest.mark.parametrize("heavy", [1, 10**6])
def test_pacing(spark, heavy):
    requests = log_of(spark, [("a", 0, None, 200), ("a", 0.05, None, 200), ("b", 0.06, None, 200), ("a", 5000, None, 200)])
    rows = audit_pace(requests, PacePolicy(10), heavy_rows=heavy).orderBy("seq").collect()
    assert [r.gap_s for r in rows] == [None, 0.05, None, 4999.95]
    assert [r.violation for r in rows] == [False, True, False, False]
    assert rows[1].wait_s == pytest.approx(0.05)
    shared = audit_pace(requests, PacePolicy(10, min_delay=0.2, per_host=False), heavy_rows=heavy).orderBy("seq").collect()
    assert [r.violation for r in shared] == [False, True, True, False] and shared[2].required_s == 0.2
    listed = paced_fetch_list(requests, PacePolicy(2), ["seq"], crawl_delay=F.lit(2.0), heavy_rows=heavy)
    assert [(r["rank"], r.send_offset_s) for r in listed.orderBy("seq").collect()] == [(1, 0), (2, 2), (1, 0), (3, 4)]
    with pytest.raises(ValueError):
        PacePolicy(0)


def test_ranges_are_cut_by_rows(spark):
    """A key whose rows all bunch in one instant is cut as well; nulls and null keys have their place."""
    rows = spark.range(20_000).selectExpr("if(id % 10 = 0, null, 'hot') AS k", "if(id % 7 = 0, null, 5) AS t", "id AS seq")
    held = range_parts(rows, ["k", "t", "seq"], 20)
    sizes = [r["count"] for r in held.groupBy("_part").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2_000
    got = number_rows(rows, ["k"], ["t", "seq"], heavy_rows=1_500)
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = rows.withColumn("rn", F.row_number().over(w))
    assert got.exceptAll(want).count() == 0 and got.count() == 20_000
    plan = held.withColumn("n", F.row_number().over(Window.partitionBy("_part", "k").orderBy("t", "seq")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_breaker_over_a_burst(spark):
    """90 % of the events are one host's within one hour, some have no time: cut by rows, as the fold has it."""
    rnd, policy, events = random.Random(5), BreakerPolicy(3, 20), []
    for i in range(3000):
        hot = rnd.random() < 0.9
        events.append((("hot" if hot else rnd.choice([None, "x"])), rnd.randint(0, 3600) if hot else rnd.randint(0, 10**6), rnd.random() < 0.5, rnd.random() < 0.03))
    rows = [(i, h, None if gone else START + timedelta(seconds=s), ok) for i, (h, s, ok, gone) in enumerate(events)]
    log = spark.createDataFrame(rows, "seq long, host string, ts timestamp, ok boolean")
    got = {r.seq: (r.allowed, r.state_after) for r in replay_breaker(log, policy, heavy_rows=400).collect()}
    want = {i: (True, "closed") for i, e in enumerate(events) if e[3]}
    for host in ("hot", "x", None):
        mine = sorted((s, i, ok) for i, (h, s, ok, gone) in enumerate(events) if h == host and not gone)
        want.update(zip([i for _, i, _ in mine], fold([(s * 1_000_000, ok) for s, _, ok in mine], policy)))
    assert got == want
    assert replay_breaker(log.limit(0), policy).count() == 0
