"""Captured pages to parsed pages and the tables below them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..session import spread
from .page_events import extract

# Rows handed back at a time; output batches stay small however large pages are.
_SLICE = 128


def bound(value: Column, make) -> Column:
    """``make`` of a value that is evaluated once, however often ``make`` names it, and not written for that."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _in_range(values: Column, span: Column) -> Column:
    return F.slice(values, span["start"], span["length"])


def _nested_lists(spans: Column) -> Column:
    def nest(texts):
        return F.transform(spans["lists"], lambda found: F.struct(found["type"].alias("type"), _in_range(texts, found).alias("items")))

    # Transformed texts are references, so the slices share them without a copy.
    return bound(F.transform(spans["texts"], lambda text: text), nest)


def _nested_tables(spans: Column) -> Column:
    rows = lambda texts: F.transform(spans["rows"], lambda row: _in_range(texts, row))
    tables = lambda rows: F.transform(spans["tables"], lambda table: _in_range(rows, table))
    return bound(F.transform(spans["texts"], lambda text: text), lambda texts: bound(rows(texts), tables))


# Fields whose texts repeat at every level of nesting: sent once, as ranges, and nested by Spark.
_SPANNED = {
    "lists": ("list_spans", schemas.LIST_SPANS, _nested_lists),
    "tables": ("table_spans", schemas.TABLE_SPANS, _nested_tables),
}


def parse_pages(
    captures: DataFrame,
    fields: Sequence[str] = tuple(schemas.PARSED_FIELDS),
    keep: Sequence[str] = ("url",),
    error: str | None = None,
) -> DataFrame:
    """One Arrow-batched pass from ``(url, html)`` to the wanted parsed fields.

    Only ``keep``, ``url`` and ``html`` are read, and only ``fields`` are built: a
    Python stage hides its needs from column pruning, so it is told. Several
    consumers should share one written result. ``error`` names a further column: why a
    page could not be read, null for the others. Lists and tables leave Python with every
    text once; the values that repeat it at each level of nesting are built in Spark.
    """
    keep = tuple(keep)
    read = tuple(dict.fromkeys((*keep, "url", "html")))
    source = spread(captures.select(*read))
    sent = {f: _SPANNED[f][1] if f in _SPANNED else schemas.PARSED_FIELDS[f] for f in fields}
    schema = T.StructType(
        [source.schema[name] for name in keep] + [T.StructField(f, kind) for f, kind in sent.items()]
        + ([T.StructField(error, T.StringType())] if error else [])
    )
    arrow = to_arrow_schema(schema)
    wanted = tuple(_SPANNED[f][0] if f in _SPANNED else f for f in sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                piece = batch.slice(start, _SLICE)
                urls, pages = piece.column("url").to_pylist(), piece.column("html").to_pylist()
                found = [extract(html, url, wanted) for url, html in zip(urls, pages)]
                columns = list(zip(*(values for values, _ in found)))
                arrays = [piece.column(name).cast(arrow.field(name).type) for name in keep]
                arrays += [pa.array(list(v), arrow.field(f).type) for f, v in zip(sent, columns)]
                if error:
                    arrays.append(pa.array([message for _, message in found], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    parsed = source.mapInArrow(run, schema)
    return parsed.withColumns({f: _SPANNED[f][2](F.col(f)).cast(schemas.PARSED_FIELDS[f]) for f in sent if f in _SPANNED})


def link_edges(parsed: DataFrame) -> DataFrame:
    """(src_url, pos, dst_url), positions from 0 in first-seen order."""
    return parsed.select(F.col("url").alias("src_url"), F.posexplode("links").alias("pos", "dst_url"))


def heading_rows(parsed: DataFrame, key: str = "url") -> DataFrame:
    return parsed.select(key, F.posexplode("headings").alias("pos", "h")).select(key, "pos", "h.level", "h.text")


def image_rows(parsed: DataFrame, key: str = "url") -> DataFrame:
    return parsed.select(key, F.posexplode("images").alias("pos", "i")).select(key, "pos", "i.src", "i.alt")


def list_rows(parsed: DataFrame, key: str = "url") -> DataFrame:
    lists = parsed.select(key, F.posexplode("lists").alias("list_pos", "l"))
    return lists.select(key, "list_pos", "l.type", F.posexplode("l.items").alias("item_pos", "item"))


def table_cells(parsed: DataFrame, key: str = "url") -> DataFrame:
    tables = parsed.select(key, F.posexplode("tables").alias("table_pos", "t"))
    rows = tables.select(key, "table_pos", F.posexplode("t").alias("row_pos", "r"))
    return rows.select(key, "table_pos", "row_pos", F.posexplode("r").alias("col_pos", "cell"))


# --- Native forms -----------------------------------------------------------
# For jobs that need a single flat field these stay inside the JVM. They read
# the same rules from the markup's surface and agree with the parsed pass on
# pages without nested or stray markup in the element at hand.

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"


def visible_markup(html: Column) -> Column:
    """Markup without comments, scripts, styles and templates."""
    return F.regexp_replace(html, _HIDDEN, "<>")


def title_markup(html: Column) -> Column:
    """Raw (still escaped) text of the first title."""
    return F.trim(F.regexp_extract(visible_markup(html), r"(?is)<title\b[^>]*>(.*?)</title", 1))


def summarize(parsed: DataFrame, first_links: int = 5) -> DataFrame:
    """Text length, link and image counts and the first links of each page."""
    return parsed.select(
        "url",
        "title",
        F.length("text").alias("text_length"),
        F.size("links").alias("links_count"),
        F.size("images").alias("images_count"),
        F.slice("links", 1, first_links).alias("first_links"),
    )
