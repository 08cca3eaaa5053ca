"""JSON and CSV outputs, one folder per batch below the sink's folder."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import ISO, iso_time, json_cell
from .base import PageSink, SinkError


class _FolderSink(PageSink):
    """Batch ``n`` lives in ``<path>/batch=n`` and is overwritten when retried, so
    appending is adding batches and a rerun never doubles rows."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def target(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        try:
            self._write(batch, self.target(batch_id))
        except (PySparkException, Py4JError, OSError) as error:
            raise SinkError(str(error)) from error

    def _write(self, batch: DataFrame, target: str) -> None:
        raise NotImplementedError


class JsonLinesSink(_FolderSink):
    """One JSON object per line; nulls kept, text unescaped, ISO-8601 times."""

    def _write(self, batch: DataFrame, target: str) -> None:
        times = {f.name: iso_time(F.col(f.name)) for f in batch.schema if isinstance(f.dataType, T.TimestampType)}
        options = {"ignoreNullFields": "false", "timestampFormat": ISO}
        batch.withColumns(times).write.mode("overwrite").options(**options).json(target)


class PrettyJsonSink(_FolderSink):
    """One indented JSON array in a single text row.

    For bounded tables (summaries, error counts): the array is one value.
    """

    def __init__(self, path: str, order: tuple[str, ...] = ()) -> None:
        super().__init__(path)
        self.order = order

    def _write(self, batch: DataFrame, target: str) -> None:
        rows = F.collect_list(F.struct("*"))
        if self.order:
            keyed = F.collect_list(F.struct(F.struct(*self.order).alias("key"), F.struct("*").alias("row")))
            # Only the key is compared: rows may hold maps, which have no order.
            by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
            rows = F.transform(F.array_sort(keyed, by_key), lambda item: item["row"])
        text = F.to_json(rows, {"pretty": "true", "ignoreNullFields": "false", "timestampFormat": ISO})
        batch.agg(text.alias("value")).write.mode("overwrite").text(target)


def csv_cell(name: str, kind: T.DataType) -> Column:
    """Nested values as JSON text, times as ISO-8601, the rest as they are."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return json_cell(F.col(name)).alias(name)
    if isinstance(kind, T.TimestampType):
        return iso_time(F.col(name)).alias(name)
    return F.col(name)


class CsvSink(_FolderSink):
    """Header once per file, RFC 4180 quoting, null and '' both empty."""

    def __init__(self, path: str, encoding: str = "UTF-8") -> None:
        super().__init__(path)
        self.encoding = encoding

    def _write(self, batch: DataFrame, target: str) -> None:
        flat = batch.select(*[csv_cell(field.name, field.dataType) for field in batch.schema])
        options = {
            "header": "true", "escape": '"', "emptyValue": "", "nullValue": "", "encoding": self.encoding,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        }
        flat.write.mode("overwrite").options(**options).csv(target)


def read_jsonl_records(spark: SparkSession, path: str, schema: T.StructType = schemas.PAGE_RECORDS) -> DataFrame:
    """All batches of a :class:`JsonLinesSink`, without the batch column."""
    return spark.read.schema(schema).json(path).select(*schema.names)


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType = schemas.PAGE_RECORDS) -> DataFrame:
    """All batches of a :class:`CsvSink`, nested cells parsed again.

    Empty cells come back as null, whether they were null or ''.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    text = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema
    ])
    rows = spark.read.schema(text).options(
        header="true", multiLine="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return rows.select(*[
        F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in schema
    ])
