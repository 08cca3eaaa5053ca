"""Explicit schemas of the data model. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

CAPTURES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("keywords", T.StringType()),
])

HEADINGS = T.ArrayType(T.StructType([
    T.StructField("level", T.StringType()),
    T.StructField("text", T.StringType()),
]))
IMAGES = T.ArrayType(T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("alt", T.StringType()),
]))
LISTS = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("items", STRINGS),
]))
TABLES = T.ArrayType(T.ArrayType(STRINGS))

# Lists and tables as the page parser sends them: texts once, and ranges of places among them, from 1.
_RANGE = [T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]
LIST_SPANS = T.StructType([
    T.StructField("texts", STRINGS),
    T.StructField("lists", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), *_RANGE]))),
])
TABLE_SPANS = T.StructType([
    T.StructField("texts", STRINGS),
    T.StructField("rows", T.ArrayType(T.StructType(_RANGE))),
    T.StructField("tables", T.ArrayType(T.StructType(_RANGE))),
])

# The fields the page parser can produce, in output order.
PARSED_FIELDS = {
    "title": T.StringType(),
    "text": T.StringType(),
    "links": STRINGS,
    "tables": TABLES,
    "lists": LISTS,
    "images": IMAGES,
    "headings": HEADINGS,
    "metadata": METADATA,
}

PARSED_PAGES = T.StructType(
    [T.StructField("url", T.StringType())]
    + [T.StructField(name, kind) for name, kind in PARSED_FIELDS.items()]
)

RECORD_METADATA = T.StructType(
    METADATA.fields
    + [
        T.StructField("headings", HEADINGS),
        T.StructField("images", IMAGES),
        T.StructField("lists", LISTS),
        T.StructField("tables", TABLES),
    ]
)

PAGE_RECORDS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("links", STRINGS),
    T.StructField("metadata", RECORD_METADATA),
    T.StructField("crawled_at", T.TimestampType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
])

FETCH_ATTEMPTS = T.StructType([
    T.StructField("op_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("wait_s", T.DoubleType()),
])

ROBOTS_RULES = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("entry_idx", T.IntegerType()),
    T.StructField("is_default", T.BooleanType()),
    T.StructField("agents", STRINGS),
    T.StructField("delay", T.DoubleType()),
    T.StructField("rules", T.ArrayType(T.StructType([
        T.StructField("allow", T.BooleanType()),
        T.StructField("path", T.StringType()),
    ]))),
])

SITEMAP_PARTS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("is_index", T.BooleanType()),
    T.StructField("locs", STRINGS),
])
