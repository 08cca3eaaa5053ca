"""Stream dedup, live counters and continuous saving."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.fetchlog import good
from ..sinks.base import PageSink, save


# Batch numbers of a stream, one after the other from its first.
STREAM_BATCHES = 1_000_000


def first_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number of a stream's first batch, of the time it was first started.

    It is kept beside the checkpoint's own files, so a restart goes on with the same numbers,
    and a stream with a new checkpoint has later ones: it adds to what is stored, and
    replaces nothing. Start streams into one path one after the other.
    """
    path = f"{checkpoint}/first_batch"
    own = spark.createDataFrame([(int(time.time() * 1000) * STREAM_BATCHES,)], "first long")
    own.write.mode("ignore").parquet(path)
    kept = spark.read.schema("first long").parquet(path)
    if kept.isEmpty():  # an earlier start was cut short before its row
        own.write.mode("overwrite").parquet(path)
    return kept.first()[0]


def dedup_stream(rows: DataFrame, path: str, checkpoint: str, key: str = "url", *, once: bool = True) -> StreamingQuery:
    """Append a row of every new key to ``path``, however late it comes.

    The table at ``path`` is both the result and what has been seen: each micro-batch
    keeps the keys that all batches before it lack, those of earlier streams included; of a
    key's rows in one batch any one. A replayed batch replaces its own rows.
    A null key counts as one key.
    """
    columns = rows.columns
    spark = rows.sparkSession
    first = first_batch(spark, checkpoint)
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("ignore").parquet(f"{path}/batch=-1")

    def keep(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        seen = read_deduped(spark, path, rows.schema, before=number).select(F.col(key).alias("_seen"))
        fresh = batch.dropDuplicates([key])
        fresh = fresh.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        fresh.select(*columns).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_deduped(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The rows that ``dedup_stream`` kept, of the batches before a given one or of all."""
    stored = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)
    return (stored if before is None else stored.where(F.col("batch") < before)).select(*schema.names)


def live_counts(log: DataFrame) -> DataFrame:
    """Processed, failed and total counts with first and last time.

    Complete-mode aggregate; ``progress_metrics`` turns it into rate and ETA.
    """
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    return log.groupBy().agg(
        F.count_if(good()).alias("successful"),
        F.count_if(~good()).alias("failed"),
        F.count("*").alias("processed"),
        ((F.max(ts) - F.min(ts)) / F.lit(1_000_000.0)).alias("elapsed_s"),
    )


def save_stream(
    records: DataFrame, sink: PageSink, checkpoint: str, *, on_error: str = "raise", once: bool = True
) -> StreamingQuery:
    """Write every micro-batch to ``sink`` as it completes.

    Sinks replace a batch by its id, so a restart that replays the last batch
    leaves no duplicates; a stream with a new checkpoint has ids of its own, which come
    later. With ``once`` the query drains what is there and stops.
    """
    first = first_batch(records.sparkSession, checkpoint)
    sink.init(records.sparkSession)
    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: save(sink, batch, first + batch_id, on_error)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
