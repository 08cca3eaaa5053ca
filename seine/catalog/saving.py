"""Saved records: files, snapshots and read-back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators.records import earliest_records
from ..session import cut_lineage, scratch_path
from ..sinks import CsvSink, FanOut, JsonLinesSink, Retrying, SnapshotSink, read_csv_records, read_jsonl_records
from . import inputs
from .pages import RECORDS_SQL, flat_records, records_of


def sink_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    JsonLinesSink(path).write(records_of(spark, sf_dir), 0)
    return flat_records(read_jsonl_records(spark, path))


def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    CsvSink(path).write(records_of(spark, sf_dir), 0)
    return flat_records(read_csv_records(spark, path))


def sink_fan_out(spark, sf_dir):
    """Both file sinks fed from one pass, each retried on its own; rows per sink."""
    paths = scratch_path(spark, "jsonl"), scratch_path(spark, "csv")
    sink = FanOut([Retrying(JsonLinesSink(paths[0])), Retrying(CsvSink(paths[1]))])
    sink.init(spark)
    sink.write(records_of(spark, sf_dir), 0)
    sink.close()
    lines = read_jsonl_records(spark, paths[0]).select("url", F.size("links").alias("n_links"), F.lit("jsonl").alias("sink"))
    cells = read_csv_records(spark, paths[1]).select("url", F.size("links").alias("n_links"), F.lit("csv").alias("sink"))
    return lines.unionByName(cells)


def earliest_record(spark, sf_dir):
    """The earliest record of those a sink saved, read back from its files."""
    path = scratch_path(spark, "jsonl")
    JsonLinesSink(path).write(records_of(spark, sf_dir), 0)
    return flat_records(earliest_records(read_jsonl_records(spark, path)))


_UPDATES = schemas.T.StructType([
    schemas.T.StructField("url", schemas.T.StringType()),
    schemas.T.StructField("title", schemas.T.StringType()),
    schemas.T.StructField("seq", schemas.T.LongType()),
])


def upsert_latest(spark, sf_dir):
    """All pages saved once, then those of blog hosts again with a new title."""
    pages = cut_lineage(inputs.parsed_with_id(spark, sf_dir, ("title",)), "titles")
    first = pages.select("url", "title", F.lit(0).cast("long").alias("seq"))
    again = pages.where(F.col("url").contains("://blog.")).select("url", F.concat("title", F.lit(" (new)")).alias("title"), F.lit(1).cast("long").alias("seq"))
    sink = SnapshotSink(scratch_path(spark, "snapshot"), _UPDATES, order="seq")
    sink.init(spark)
    sink.write(first, 0)
    older = again.withColumns({"title": F.lit("older"), "seq": F.lit(-1).cast("long")})
    undated = again.withColumns({"title": F.lit("undated"), "seq": F.lit(None).cast("long")})
    sink.write(again.unionByName(older).unionByName(undated), 1)
    return sink.read(spark)


QUERIES = {
    "sink_jsonl_roundtrip": sink_jsonl_roundtrip,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_fan_out": sink_fan_out,
    "earliest_record": earliest_record,
    "upsert_latest": upsert_latest,
}

ORACLES = {
    "sink_jsonl_roundtrip": RECORDS_SQL,
    "sink_csv_roundtrip": RECORDS_SQL,
    "sink_fan_out": f"""
      WITH r AS ({RECORDS_SQL}), n AS (
        SELECT url, CAST(CASE WHEN links = '' THEN 0 ELSE len(string_split(links, ' ')) END AS INT) AS n_links FROM r)
      SELECT url, n_links, 'jsonl' AS sink FROM n UNION ALL SELECT url, n_links, 'csv' FROM n""",
    "earliest_record": f"SELECT * FROM ({RECORDS_SQL}) ORDER BY crawled_us, url LIMIT 1",
    "upsert_latest": f"""
      WITH r AS ({RECORDS_SQL})
      SELECT url, CASE WHEN url LIKE '%://blog.%' THEN concat(title, ' (new)') ELSE title END AS title,
        CAST(CASE WHEN url LIKE '%://blog.%' THEN 1 ELSE 0 END AS BIGINT) AS seq FROM r""",
}
