"""Keyed upserts as batches of changes, merged when read."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas
from ..operators.records import latest_per_key
from .base import PageSink, SinkError


class SnapshotSink(PageSink):
    """One row per ``key``; the batch of the highest id wins and replaces all other columns.

    A batch writes its own rows, one per key, into a folder of its own and touches
    nothing stored before: its cost does not grow with the table, and a write that fails
    half-way can lose rows of that batch only, which its retry writes again. Reading takes
    the last row of each key. ``compact`` writes what is read as the first batch of
    another folder, for the caller to switch to once it is complete.
    """

    def __init__(
        self, path: str, schema: StructType = schemas.PAGE_RECORDS, *, key: str = "url", order: str = "crawled_at",
    ) -> None:
        self.path, self.schema, self.key, self.order = path.rstrip("/"), schema, key, order

    def init(self, spark: SparkSession) -> None:
        """Make the folder readable before its first batch."""
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(f"{self.path}/batch=-1")

    def read(self, spark: SparkSession) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField("batch", LongType())])
        return latest_per_key(spark.read.schema(stored).parquet(self.path), self.key, "batch").select(*self.schema.names)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        fresh = latest_per_key(batch.select(*self.schema.names), self.key, self.order)
        try:
            fresh.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        except (PySparkException, Py4JError, OSError) as error:
            raise SinkError(str(error)) from error

    def compact(self, spark: SparkSession, path: str) -> SnapshotSink:
        """The snapshot as a sink of its own at ``path``."""
        smaller = SnapshotSink(path, self.schema, key=self.key, order=self.order)
        self.read(spark).write.mode("overwrite").parquet(f"{smaller.path}/batch=-1")
        return smaller
