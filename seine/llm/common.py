"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows of whole texts that a Python worker holds at once.
TEXT_BATCH_ROWS = 256
# Bits of a map of hashed keys. A full map only filters less.
MARK_BITS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Lower the session's rows per Arrow batch, so that batches of long texts fit a worker."""
    if int(spark.conf.get(BATCH_ROWS_KEY)) > rows or int(spark.conf.get(BATCH_ROWS_KEY)) <= 0:
        spark.conf.set(BATCH_ROWS_KEY, str(rows))


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXT_BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a worker makes of whole texts stays small.

    Spark bounds the bytes of the batches it sends (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(name: str = "text"):
    """A text column as its bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"")).alias(name)


def keep_rows(df: DataFrame, keeps, column: str = "text") -> DataFrame:
    """The rows of ``df`` for which ``keeps`` holds, every column untouched.

    ``keeps`` takes a list of texts as bytes (None for null) and returns a list of
    booleans. Rows are judged where they lie, so repeated rows and further columns
    of any name pass through.
    """
    small_batches(df.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(keeps(texts), pa.bool_()))

    return df.mapInArrow(judge, df.schema)


def _mark(columns: tuple[str, ...], size: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(size))


def marked(keys: DataFrame, *columns: str, size: int = MARK_BITS) -> Column:
    """Whether a row's ``columns`` may be among ``keys`` (the same columns): never wrongly false.

    The keys become a map of ``size`` bits, which goes to the tasks as a constant,
    a scalar subquery over a written one-row table. Rows without a mark need no join.
    """
    spark = keys.sparkSession
    words = keys.select(_mark(columns, size).alias("m")).groupBy(F.expr("cast(m div 64 as int)").alias("place")).agg(F.expr("bit_or(shiftleft(1L, cast(m % 64 as int)))").alias("bits"))
    places = spark.range(size // 64).select(F.col("id").cast("int").alias("place"))
    every = places.join(words, "place", "left").select("place", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    row = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "bits"))), lambda x: x["bits"]).alias("marks"))
    view = f"marks_{uuid.uuid4().hex}"
    cut_lineage(row, "marks").createOrReplaceTempView(view)
    place = f"pmod(xxhash64({', '.join(f'`{c}`' for c in columns)}), {size}L)"
    return F.expr(f"shiftright((SELECT marks FROM {view})[cast({place} div 64 as int)], cast({place} % 64 as int)) & 1 = 1")
