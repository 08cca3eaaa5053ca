"""Captured pages as batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.extract import parse_pages


def read_captures(spark: SparkSession, path: str, schema: StructType = schemas.CAPTURES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_captures(
    spark: SparkSession, path: str, schema: StructType = schemas.CAPTURES, files_per_trigger: int = 64
) -> DataFrame:
    """New capture files below a folder, or matching a glob."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def lookup_captures(requested: DataFrame, captures: DataFrame) -> DataFrame:
    """Each distinct requested URL once, with its html or ''.

    The pages found come first, by an inner join whose requested side may be broadcast,
    so that few requests do not exchange the whole archive.
    """
    wanted = requested.select("url").distinct()
    hits = captures.select("url", "html").join(wanted, "url")
    return wanted.join(hits, "url", "left").select("url", F.coalesce("html", F.lit("")).alias("html"))


def fetch_and_parse(spark: SparkSession, path: str, schema: StructType = schemas.CAPTURES) -> DataFrame:
    """Stored captures straight to parsed pages."""
    return parse_pages(read_captures(spark, path, schema))
