"""Sitemap documents: location lists, index expansion and seeds."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..session import cut_lineage


def _local(tag) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def _read(url: str, xml: str | None) -> dict | None:
    try:
        root = ET.fromstring(xml) if xml else None
    except ET.ParseError:
        root = None
    if root is None:
        return None
    locs = [node.text.strip() for node in root.iter() if _local(node.tag) == "loc" and node.text]
    return {"url": url, "is_index": _local(root.tag) == "sitemapindex", "locs": locs}


def parse_sitemaps(docs: DataFrame) -> DataFrame:
    """``(url, xml)`` to (url, is_index, locs); malformed or empty ones vanish."""
    arrow = to_arrow_schema(schemas.SITEMAP_PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("url").to_pylist(), batch.column("xml").to_pylist())
            rows = [row for row in (_read(url, xml) for url, xml in pairs) if row]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select("url", "xml").mapInArrow(run, schemas.SITEMAP_PARTS)


def sitemap_locs(docs: DataFrame) -> DataFrame:
    """All locations of each document in document order, repeats kept."""
    parsed = parse_sitemaps(docs)
    return parsed.select("url", "is_index", F.posexplode("locs").alias("pos", "loc"))


def expand_sitemaps(roots: DataFrame, docs: DataFrame, max_index_depth: int = 3) -> DataFrame:
    """Page locations below each root (``url``), in depth-first document order.

    Each level is one equi-join of the current locations with the documents they
    name, written to the shared folder so that no level is computed twice. ``path``
    is the trail of positions; ordering by it restores document order without
    numbering rows globally. Expansion ends with the last index, or at the depth
    limit, where an index yields nothing; that also ends cycles.
    """
    parts = cut_lineage(parse_sitemaps(docs), "sitemaps")
    level = roots.select(F.col("url").alias("root_url"), F.col("url"), F.array().cast("array<int>").alias("path"))
    found = []
    for depth in range(max_index_depth + 1):
        opened = level.join(parts, "url").select(
            "root_url", "is_index", "path", F.posexplode("locs").alias("pos", "loc")
        )
        opened = cut_lineage(opened.withColumn("path", F.concat("path", F.array("pos"))), "level")
        pages = opened.where(~F.col("is_index"))
        found.append(pages.select("root_url", "loc", F.lit(depth).alias("depth"), "path"))
        level = opened.where("is_index").select("root_url", F.col("loc").alias("url"), "path")
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def seed_urls(start: DataFrame, sitemap: DataFrame | None = None) -> DataFrame:
    """Start URLs followed by sitemap URLs: (url, origin, path).

    ``start`` has ``url`` and ``pos``; ``sitemap`` comes from
    :func:`expand_sitemaps`. Ordering by (origin, path) is the seed order.
    Raises ValueError when there is nothing to start from.
    """
    seeds = start.select("url", F.lit(0).alias("origin"), F.array(F.col("pos").cast("int")).alias("path"))
    if sitemap is not None:
        seeds = seeds.unionByName(sitemap.select(F.col("loc").alias("url"), F.lit(1).alias("origin"), "path"))
    if seeds.isEmpty():
        raise ValueError("no start URLs: give start URLs or a sitemap")
    return seeds
