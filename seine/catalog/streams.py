"""Streaming forms over the events and pages as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.extract import parse_pages
from ..operators.fetchlog import good, progress_metrics
from ..operators.records import page_records
from ..session import scratch_path
from ..sinks import JsonLinesSink, read_jsonl_records
from ..sources.captures import stream_captures
from ..streaming.flows import dedup_stream, live_counts, read_deduped, save_stream
from ..streaming.state import BREAKER_ROWS, PACE_ROWS, stream_breaker as breaker_rows, stream_pace
from . import fetches, inputs
from .pages import RECORDS_SQL, flat_records


def _events(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return inputs.as_fetch_log(stream_captures(spark, f"{sf_dir}/events.parquet*", inputs.EVENTS))


def _drain(rows, schema):
    """Run a stream over what is there and read what it wrote."""
    spark = rows.sparkSession
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    query = rows.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def stream_breaker(spark, sf_dir):
    log = _events(spark, sf_dir).select("seq", "host", "ts", good().alias("ok"))
    rows = _drain(breaker_rows(log, fetches.BREAKER), BREAKER_ROWS)
    return rows.select("seq", "host", "ok", "allowed", "state_after")


def stream_gap(spark, sf_dir):
    rows = _drain(stream_pace(_events(spark, sf_dir), fetches.PACE), PACE_ROWS)
    return rows.select(
        "seq", "pace_key", F.round("gap_s", 3).alias("gap_s"), F.round("wait_s", 3).alias("wait_s"), "violation"
    )


def stream_dedup(spark, sf_dir):
    """Every URL once; the log reaches further back than any horizon."""
    urls, path = _events(spark, sf_dir).select("url"), scratch_path(spark, "seen")
    dedup_stream(urls, path, scratch_path(spark, "state")).awaitTermination()
    return read_deduped(spark, path, urls.schema)


def stream_dedup_again(spark, sf_dir):
    """Two streams, each with a checkpoint of its own, into one table: the second adds what the first lacks."""
    urls, path = _events(spark, sf_dir).select("seq", "url"), scratch_path(spark, "seen")
    for odd in (1, 0):
        mine = urls.where(F.col("seq") % 2 == odd).select("url")
        dedup_stream(mine, path, scratch_path(spark, "state")).awaitTermination()
    return read_deduped(spark, path, mine.schema)


def stream_counters(spark, sf_dir):
    counts = live_counts(_events(spark, sf_dir))
    out, state = scratch_path(spark, "counts"), scratch_path(spark, "state")
    query = (
        counts.writeStream.outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True)
        .foreachBatch(lambda batch, _id: batch.write.mode("overwrite").parquet(out)).start()
    )
    query.awaitTermination()
    shown = spark.read.schema("successful long, failed long, processed long, elapsed_s double").parquet(out)
    metrics = progress_metrics(shown, total=1_000_000_000)
    return metrics.select(
        "successful", "failed", "processed", F.round("elapsed_s", 2).alias("elapsed_s"), F.round("percent", 6).alias("percent")
    )


def stream_save(spark, sf_dir):
    """Pages parsed and saved as they arrive, then read back."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    pages = stream_captures(spark, f"{sf_dir}/pages.parquet*", inputs.PAGES)
    parsed = parse_pages(pages, keep=("page_id", "url")).withColumn("content_type", F.lit("text/html"))
    saved_at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("page_id") * 1_000_000)
    path = scratch_path(spark, "saved")
    save_stream(page_records(parsed, saved_at), JsonLinesSink(path), scratch_path(spark, "state")).awaitTermination()
    return flat_records(read_jsonl_records(spark, path))


QUERIES = {
    "stream_breaker": stream_breaker,
    "stream_gap": stream_gap,
    "stream_dedup": stream_dedup,
    "stream_dedup_again": stream_dedup_again,
    "stream_counters": stream_counters,
    "stream_save": stream_save,
}

_GAP = fetches.ORACLES["politeness_audit"].replace("CASE WHEN host LIKE '%3.example.com' THEN greatest(7200.0, 10000.0) ELSE 7200.0 END", "7200.0")

ORACLES = {
    "stream_breaker": fetches.ORACLES["breaker_replay"],
    "stream_gap": f"SELECT seq, pace_key, gap_s, wait_s, violation FROM ({_GAP})",
    "stream_dedup": f"WITH log AS ({inputs.FETCH_LOG_SQL}) SELECT DISTINCT url FROM log",
    "stream_dedup_again": f"WITH log AS ({inputs.FETCH_LOG_SQL}) SELECT DISTINCT url FROM log",
    "stream_counters": f"""
      WITH log AS ({inputs.FETCH_LOG_SQL}) SELECT count(*) FILTER (error_class IS NULL) AS successful,
        count(error_class) AS failed, count(*) AS processed,
        round(CAST((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS DOUBLE), 2) AS elapsed_s,
        round(count(*) / 1000000000.0 * 100, 6) AS percent FROM log""",
    "stream_save": RECORDS_SQL,
}
