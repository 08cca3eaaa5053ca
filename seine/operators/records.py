"""Saved page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_records(parsed: DataFrame, crawled_at: Column | None = None) -> DataFrame:
    """The eight-column record of a parsed page.

    Headings, images, lists and tables fold into metadata. ``parsed`` may carry
    ``status_code`` and ``content_type``; a missing status is 200, a missing
    type ''.
    """
    have = set(parsed.columns)
    optional = lambda name, default: F.coalesce(F.col(name), default) if name in have else default
    metadata = F.struct(
        F.col("metadata.title"), F.col("metadata.description"), F.col("metadata.keywords"),
        "headings", "images", "lists", "tables",
    )
    return parsed.select(
        "url",
        "title",
        "text",
        "links",
        metadata.alias("metadata"),
        (F.current_timestamp() if crawled_at is None else crawled_at).alias("crawled_at"),
        optional("status_code", F.lit(200)).cast("int").alias("status_code"),
        optional("content_type", F.lit("")).alias("content_type"),
    )


def latest_per_key(rows: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """The last row per key. Rows without an order value come before all others; ties go by a hash of the row.

    An aggregate rather than a window: each task keeps one row per key before the
    shuffle, so a key holding a third of all rows ships one row per task.
    """
    whole = F.struct(*rows.columns)
    rank = F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*rows.columns))
    last = rows.groupBy(key).agg(F.max_by(whole, rank).alias("row"))
    return last.select("row.*")


def earliest_records(records: DataFrame, n: int = 1) -> DataFrame:
    """The first saved records by time, URL breaking ties."""
    return records.orderBy("crawled_at", "url").limit(n)
