"""Sinks, streams, statistics and reports."""

import glob
import json
import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from seine import schemas
from seine.functions.retry import RetryPolicy
from seine.operators import fetchlog
from seine.operators.breaker import BreakerPolicy, replay_breaker
from seine.operators.politeness import PacePolicy, audit_pace
from seine.plans.report import bar_widths, html_report
from seine.plans.summary import error_report, run_summary
from seine.operators.records import latest_per_key
from seine.sinks import (
    CsvSink, FanOut, JsonLinesSink, PageSink, PrettyJsonSink, Retrying, SinkError, SnapshotSink, read_csv_records,
    read_jsonl_records, save,
)
from seine.streaming.flows import dedup_stream, live_counts, read_deduped, save_stream
from seine.streaming.state import stream_breaker, stream_pace

AT = datetime(2026, 8, 26, tzinfo=timezone.utc)
META = {"title": "T", "description": "", "keywords": "", "headings": [], "images": [], "lists": [], "tables": []}


def records(spark, *rows):
    full = [(url, title, text, ["http://x"], META, AT, 200, "text/html") for url, title, text in rows]
    return spark.createDataFrame(full, schemas.PAGE_RECORDS)


def lines(path):
    return [line for name in sorted(glob.glob(f"{path}/batch=*/part-*")) for line in open(name, encoding="utf-8")]


def test_json_lines(spark, tmp_path):
    sink = JsonLinesSink(str(tmp_path / "j"))
    sink.write(records(spark, ("a", "Тест", None)), 0)
    sink.write(records(spark, ("b", "x", "y")), 1)
    sink.write(records(spark, ("b", "x", "y")), 1)
    raw = lines(tmp_path / "j")
    assert len(raw) == 2 and "Тест" in raw[0]
    first = json.loads(raw[0])
    assert first["crawled_at"] == "2026-08-26T00:00:00+00:00" and first["text"] is None
    back = {r.url: r for r in read_jsonl_records(spark, str(tmp_path / "j")).collect()}
    assert back["a"].metadata.title == "T" and back["b"].links == ["http://x"]


def test_csv_round_trip(spark, tmp_path):
    awkward = 'a, "b"\r\n c\\d '
    CsvSink(str(tmp_path / "c")).write(records(spark, ("u", awkward, ""), ("v", None, "t")), 0)
    assert lines(tmp_path / "c")[0].strip().startswith("url,title,text,links,metadata,crawled_at,status_code,content_type")
    back = {r.url: r for r in read_csv_records(spark, str(tmp_path / "c")).collect()}
    assert back["u"].title.replace("\r", "") == awkward.replace("\r", "") and back["u"].text is None and back["v"].title is None
    assert back["u"].links == ["http://x"] and back["u"].metadata.headings == []


def test_pretty_json(spark, tmp_path):
    sink = PrettyJsonSink(str(tmp_path / "p"), order=("n",))
    sink.write(spark.createDataFrame([("b", 2), ("a", 1)], "name string, n int"), 0)
    text = "".join(lines(tmp_path / "p"))
    assert json.loads(text) == [{"name": "a", "n": 1}, {"name": "b", "n": 2}] and "\n" in text.strip()


class Broken(PageSink):
    def __init__(self, failures=10**6):
        self.left, self.calls, self.closed = failures, 0, False

    def write(self, batch, batch_id):
        self.calls += 1
        if self.left:
            self.left -= 1
            raise SinkError("disk full")

    def close(self):
        self.closed = True
        raise SinkError("close")


def test_fan_out_survives_one_failing_sink(spark, tmp_path):
    broken = Broken()
    fan = FanOut([broken, JsonLinesSink(str(tmp_path / "j"))])
    with pytest.raises(SinkError, match="1/2 storages failed: disk full"):
        fan.write(records(spark, ("a", "t", "x")), 0)
    assert len(lines(tmp_path / "j")) == 1
    fan.close()
    assert broken.closed


def test_retries_wrap_leaves(spark, tmp_path):
    waits, flaky = [], Broken(failures=2)
    fan = FanOut([JsonLinesSink(str(tmp_path / "j")), Retrying(flaky, sleep=waits.append)])
    fan.write(records(spark, ("a", "t", "x")), 0)
    assert flaky.calls == 3 and waits == [1, 2] and len(lines(tmp_path / "j")) == 1
    dead = Broken()
    with pytest.raises(SinkError):
        Retrying(dead, RetryPolicy(max_retries=1), sleep=waits.append).write(records(spark, ("a", "t", "x")), 0)
    assert dead.calls == 2
    with pytest.raises(ValueError):
        Retrying(fan)


def test_save_failure_can_be_survived(spark):
    batch = records(spark, ("a", "t", "x"))
    assert save(Broken(), batch, on_error="warn") is False
    with pytest.raises(SinkError):
        save(Broken(), batch)


def test_snapshot_upserts(spark, tmp_path):
    sink = SnapshotSink(str(tmp_path / "s"))
    sink.init(spark)
    sink.write(records(spark, ("u", "first", "1"), ("v", "keep", "1")), 0)
    sink.write(records(spark, ("u", "second", None)), 1)
    sink.write(records(spark, ("u", "second", None)), 1)
    sink.init(spark)
    assert sorted((r.url, r.title, r.text) for r in sink.read(spark).collect()) == [("u", "second", None), ("v", "keep", "1")]


def test_snapshot_outlives_a_failed_batch(spark, tmp_path):
    sink = SnapshotSink(str(tmp_path / "s"))
    sink.init(spark)
    sink.write(records(spark, ("u", "first", "1"), ("v", "keep", "1")), 0)
    shutil.rmtree(tmp_path / "s" / "batch=1", ignore_errors=True)  # what a write cut short may leave: nothing
    assert {r.title for r in sink.read(spark).collect()} == {"first", "keep"}
    sink.write(records(spark, ("u", "second", None)), 1)
    smaller = sink.compact(spark, str(tmp_path / "t"))
    assert {r.title for r in smaller.read(spark).collect()} == {"second", "keep"}


def test_a_bad_path_is_a_sink_error(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    bad = JsonLinesSink(str(tmp_path / "file" / "below"))
    rows = records(spark, ("u", "t", "1"))
    with pytest.raises(SinkError):
        bad.write(rows, 0)
    assert save(FanOut([bad, JsonLinesSink(str(tmp_path / "j"))]), rows, 0, on_error="warn") is False
    assert read_jsonl_records(spark, str(tmp_path / "j")).count() == 1


def test_latest_keeps_a_row_without_an_order(spark):
    rows = spark.createDataFrame([("u", "x", None), ("v", "a", None), ("v", "b", 1)], "url string, title string, seq long")
    assert sorted(tuple(r) for r in latest_per_key(rows).collect()) == [("u", "x", None), ("v", "b", 1)]


def log(spark, rows):
    """(url, status, error_class, second)"""
    full = [(i, datetime.fromtimestamp(1_700_000_000 + s, timezone.utc), u.split("/")[2], u, st, e) for i, (u, st, e, s) in enumerate(rows)]
    return spark.createDataFrame(full, "seq long, ts timestamp, host string, url string, status int, error_class string")


RUN = [("http://a.com/1", 200, None, 0), ("http://a.com/2", 200, None, 1), ("http://b.com/1", 301, None, 3), ("http://c.com/", 404, "PermanentError", 4)]


def test_run_summary(spark):
    row = run_summary(log(spark, RUN)).first()
    assert (row.total_pages, row.successful, row.failed, row.elapsed_seconds, row.pages_per_second) == (4, 3, 1, 4.0, 1.0)
    assert row.status_codes == {"200": 2, "301": 1, "404": 1}
    assert [tuple(d) for d in row.top_domains] == [("a.com", 2), ("b.com", 1)]
    assert row.started_at == "2023-11-14T22:13:20+00:00"


def test_empty_run(spark):
    empty = log(spark, RUN).limit(0)
    row = run_summary(empty).first()
    assert (row.total_pages, row.pages_per_second, row.started_at, row.status_codes) == (0, 0.0, None, {})
    assert "no data" in html_report(run_summary(empty)).first().value


def test_html_report(spark):
    page = html_report(run_summary(log(spark, RUN))).first().value
    assert page.startswith("<!doctype html>") and "a.com" in page and "width:50%" in page and "width:100%" in page
    bars = bar_widths(spark.createDataFrame([("s", 3), ("s", 2), ("t", 1)], "section string, n int"))
    assert sorted(r.width for r in bars.collect()) == [66, 100, 100]


def test_error_report_and_exports(spark, tmp_path):
    attempts = spark.createDataFrame(
        [("TransientError", 0, 1.0), (None, 1, None), ("PermanentError", 0, None)], "error_class string, attempt int, wait_s double"
    )
    failures = spark.createDataFrame(
        [("http://b", 1, "PermanentError", "old"), ("http://b", 2, "PermanentError", "p"), (None, 3, "NetworkError", "n")],
        "url string, seq long, error_class string, message string",
    )
    results = spark.createDataFrame([("u", "failed", "r"), ("v", "blocked", "b")], "url string, outcome string, reason string")
    parts = error_report(attempts, failures, results)
    assert {r.error_class: r.n for r in parts["errors_by_type"].collect()} == {"TransientError": 1, "PermanentError": 1}
    assert parts["retries"].first().asDict() == {"retries_attempted": 1, "retry_successes": 1, "total_retry_wait": 1.0, "avg_retry_wait": 1.0}
    assert {r.url: r.reason for r in parts["final_failures"].collect()} == {"http://b": "PermanentError: p", "<unknown>": "NetworkError: n"}
    assert parts["failed_urls"].first().reason == "r" and parts["blocked_urls"].first().url == "v"
    for name, part in parts.items():
        PrettyJsonSink(str(tmp_path / name)).write(part, 0)
    assert json.loads("".join(lines(tmp_path / "retries")))[0]["avg_retry_wait"] == 1.0


def test_speed_and_progress(spark):
    row = fetchlog.speed_stats(log(spark, RUN)).first()
    assert (row.requests, row.req_per_sec, row.avg_delay, row.blocked) == (4, 1.0, pytest.approx(4 / 3), 0)
    assert fetchlog.speed_stats(log(spark, RUN[:1])).first().asDict() == {"requests": 1, "req_per_sec": 0.0, "avg_delay": 0.0, "blocked": 0}
    counts = spark.createDataFrame([(5, 10.0)], "processed long, elapsed_s double")
    row = fetchlog.progress_metrics(counts, 20).first()
    assert (row.percent, row.rate, row.eta_s) == (25.0, 0.5, 30.0)
    assert fetchlog.progress_metrics(counts, 4).first().eta_s == 0
    assert fetchlog.progress_metrics(counts, None).first().percent is None


@pytest.fixture
def stream_of(spark, tmp_path):
    """A log written as one file per slice, in order, and read one file per batch."""
    def make(rows, cuts):
        import time

        frame = log(spark, rows)
        for low, high in zip([0, *cuts], [*cuts, len(rows)]):
            frame.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            time.sleep(1.1)  # the source orders files by modification time
        return frame, spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return make


def drain(spark, tmp_path, rows, name):
    out = str(tmp_path / name)
    query = rows.writeStream.option("checkpointLocation", out + "-state").trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination()
    return spark.read.parquet(out)


MIXED = [(f"http://{'ab'[i % 2]}/{i % 5}", 200 if i % 3 == 0 else 503, None if i % 3 == 0 else "TransientError", i * 7) for i in range(40)]


def test_streams_equal_batches(spark, tmp_path, stream_of):
    frame, stream = stream_of(MIXED, [13, 21])
    policy = BreakerPolicy(2, 30)
    ok = fetchlog.good().alias("ok")
    want = {(r.seq, r.allowed, r.state_after) for r in replay_breaker(frame.select("*", ok), policy).collect()}
    got = drain(spark, tmp_path, stream_breaker(stream.select("*", ok), policy), "breaker").collect()
    assert {(r.seq, r.allowed, r.state_after) for r in got} == want

    pace = PacePolicy(1 / 10)
    want = {(r.seq, r.gap_s, r.wait_s, r.violation) for r in audit_pace(frame, pace).collect()}
    got = drain(spark, tmp_path, stream_pace(stream, pace), "pace").collect()
    clean = lambda g: None if g is None or g != g else g
    assert {(r.seq, clean(r.gap_s), r.wait_s, r.violation) for r in got} == want

    dedup_stream(stream, str(tmp_path / "seen"), str(tmp_path / "dedup")).awaitTermination()
    got = [r.url for r in read_deduped(spark, str(tmp_path / "seen"), stream.schema).collect()]
    assert sorted(got) == sorted({u for u, *_ in MIXED})


def test_live_counts(spark, tmp_path, stream_of):
    _, stream = stream_of(MIXED, [20])
    query = live_counts(stream).writeStream.outputMode("complete").format("memory").queryName("live").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("live").first().asDict() == {"successful": 14, "failed": 26, "processed": 40, "elapsed_s": 273.0}


def test_continuous_save(spark, tmp_path):
    records(spark, ("a", "t", "x"), ("b", "t", "y")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.PAGE_RECORDS).parquet(str(tmp_path / "in"))
    sink = FanOut([JsonLinesSink(str(tmp_path / "j")), SnapshotSink(str(tmp_path / "s"))])
    for _ in range(2):
        save_stream(stream, sink, str(tmp_path / "state")).awaitTermination()
    assert read_jsonl_records(spark, str(tmp_path / "j")).count() == 2
    assert {r.url for r in sink.sinks[1].read(spark).collect()} == {"a", "b"}


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    """Streams with checkpoints of their own add to one path; a restart of the last one adds nothing."""
    sinks = FanOut([JsonLinesSink(str(tmp_path / "j")), SnapshotSink(str(tmp_path / "s"))])
    for state, names in (("one", "ab"), ("two", "cb"), ("two", "cb")):
        folder = str(tmp_path / f"in-{state}")
        records(spark, *[(n, f"t {state}", "x") for n in names]).write.mode("ignore").parquet(folder)
        stream = spark.readStream.schema(schemas.PAGE_RECORDS).parquet(folder)
        dedup_stream(stream, str(tmp_path / "seen"), str(tmp_path / f"dedup-{state}")).awaitTermination()
        save_stream(stream, sinks, str(tmp_path / f"save-{state}")).awaitTermination()
    assert sorted(r.url for r in read_deduped(spark, str(tmp_path / "seen"), schemas.PAGE_RECORDS).collect()) == ["a", "b", "c"]
    assert sorted(r.url for r in read_jsonl_records(spark, str(tmp_path / "j")).collect()) == ["a", "b", "b", "c"]
    kept = {r.url: r.title for r in sinks.sinks[1].read(spark).collect()}
    assert kept == {"a": "t one", "b": "t two", "c": "t two"}


def test_the_earliest_record_comes_from_the_files(spark, monkeypatch):
    from seine.catalog import saving

    written = []
    read = saving.read_jsonl_records
    monkeypatch.setattr(saving, "read_jsonl_records", lambda spark, path: written.append(path) or read(spark, path))
    got = saving.earliest_record(spark, "/root/testdata/sf0.001").collect()
    want = saving.flat_records(saving.earliest_records(saving.records_of(spark, "/root/testdata/sf0.001"))).collect()
    assert len(written) == 1 and got == want and len(got) == 1
