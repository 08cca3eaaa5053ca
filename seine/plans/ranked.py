"""The first n rows of an order, for any n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Up to here a top-k in the driver's merge is cheap; beyond, it is done in place.
TOP_K_ROWS = 100_000


def rank_all(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` numbered from 1 by a total ``order``, without bringing them into one task.

    They are range-sorted and written with their partition's number; the counts of the
    partitions give each its offset.
    """
    parts = rows.sparkSession.sparkContext.defaultParallelism * 4
    placed = cut_lineage(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(offsets, "_part").withColumn(name, F.col("_offset") + within).drop("_part", "_offset")


def take_first(rows: DataFrame, order: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows by ``order`` (unique values).

    A small ``n`` is a top-k. A large one is range-sorted and written with its
    partition number; partition counts give each partition its offset, and only
    rows are ranked inside their own partition. Nothing passes through one task.
    """
    if n <= TOP_K_ROWS:
        return rows.orderBy(order).limit(n)
    parts = rows.sparkSession.sparkContext.defaultParallelism * 4
    placed = cut_lineage(
        rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_part").orderBy(order)
    ranked = placed.join(offsets.where(F.col("_offset") < n), "_part").withColumn("_rn", F.row_number().over(within))
    return ranked.where(F.col("_offset") + F.col("_rn") <= n).drop("_part", "_offset", "_rn")
