"""Order-dependent columns for keys of any size.

A window over a key sorts all rows of the key in one task, which is fine until a key
is hot. The rows of keys of more than ``HEAVY_ROWS`` rows are therefore cut by rows: they
are range-partitioned along (key, order) into parts of about equal counts, whatever the
values are, and written with their part's number. The windows run per (part, key), each
part hands one summary row of a key on, and a second window over those summaries supplies
what came before. The results equal the plain window's; other keys cost one count more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

# Rows of one key a single task may well sort. Heavy keys are at most rows / HEAVY_ROWS
# in number, so the list of them stays small beside the data.
HEAVY_ROWS = 4_000_000
# Spark allows 100,000 buckets; with more parts than this a bucket holds several.
MAX_BUCKETS = 10_000
# Every part is a task whose result, and whose share of the sample for the ranges, goes to the driver:
# a smaller bound than HEAVY_ROWS cuts heavy keys into at most so many parts, HEAVY_ROWS into any number.
MAX_PARTS = 1_000


def range_parts(rows: DataFrame, order: Sequence[str], parts: int, *first: str) -> DataFrame:
    """``rows`` cut along ``order`` into ``parts`` ranges of about equal row counts, numbered in ``_part``.

    They are written as a table bucketed by that number, so grouping or a window by
    ``_part`` and further columns reads it without another exchange. ``first`` names the
    leading columns the rows of a part are sorted by in the files. The catalog entry is
    dropped at once; the files stay in the shared folder.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    path, name = scratch_path(spark, "ranged"), f"ranged_{uuid.uuid4().hex}"
    placed.write.format("parquet").bucketBy(min(parts, MAX_BUCKETS), "_part").sortBy("_part", *first).option("path", path).saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, where null equals null; the right side's keys go."""
    named = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(named, same, how).drop(*[f"_same_{k}" for k in keys])


def split_heavy(rows: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of the light keys, those of keys with more than ``heavy_rows`` rows (None if none), and parts to cut these into.

    The list of heavy keys is written, not kept as a plan: its real size then decides how it
    is joined. Two parts for every ``heavy_rows`` rows leave room for ranges found by sampling;
    beyond ``MAX_PARTS`` parts grow instead, up to the rows of two parts for every ``HEAVY_ROWS``.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > heavy_rows)
    heavy = cut_lineage(counted, "heavy")
    total = heavy.agg(F.sum("_rows")).first()[0]
    if not total:
        return rows, None, 0
    names = heavy.select(*keys)
    wanted, needed = (-(-2 * total // max(bound, 1)) for bound in (heavy_rows, HEAVY_ROWS))
    parts = min(wanted, max(needed, MAX_PARTS), total)
    return null_safe(rows, names, keys, "left_anti"), null_safe(rows, names, keys, "left_semi"), parts


class Ordered:
    """Rows in ``order`` within ``keys``, to which order-dependent columns are added.

    Columns added one after the other share one sorting: rows of light keys are exchanged
    once, those of heavy keys cut once. Nulls of ``order`` come first; null keys are one key.
    """

    def __init__(
        self, rows: DataFrame, keys: Sequence[str], order: Sequence[str], heavy_rows: int = HEAVY_ROWS, *, parts: int | None = None
    ) -> None:
        """``parts``, if given, cuts all rows into so many, for keys known to be few and large."""
        self.keys, self.order = list(keys), list(order)
        if parts:
            self.light, hot = rows.limit(0), rows
        else:
            self.light, hot, parts = split_heavy(rows, keys, heavy_rows)
        self.hot = None if hot is None else range_parts(hot, [*keys, *order], parts, *keys, *order)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Change rows without moving them; keys and order must stay."""
        self.light, self.hot = change(self.light), None if self.hot is None else change(self.hot)
        return self

    def add(
        self,
        *,
        last_before: Mapping[str, str] | None = None,
        max_before: Mapping[str, str] | None = None,
        running_sum: Mapping[str, str] | None = None,
        last_row: str | None = None,
    ) -> Ordered:
        """Add columns that depend on the rows before.

        ``last_before`` maps an output name to a column whose last non-null value on
        an earlier row of the key is wanted. ``max_before`` does the same for the
        largest value; for values that rise with ``order`` the two agree, and the
        maximum is the one a hash aggregate can take. ``running_sum`` maps an output name
        to a column summed up to and including the row. ``last_row`` names a flag for the
        last row of a key.
        """
        wanted = dict(last_before or {}), dict(max_before or {}), dict(running_sum or {})
        self.light = self._within(self.light, [], wanted, last_row)
        if self.hot is not None:
            # Only a key that spans parts carries anything, so the carried rows are about as many as parts.
            carried = cut_lineage(self._carried(*wanted), "carried")
            met = null_safe(self.hot, carried, ["_part", *self.keys], "left")
            self.hot = self._within(met, ["_part"], wanted, last_row)
        return self

    def rows(self) -> DataFrame:
        return self.light if self.hot is None else self.light.unionByName(self.hot.drop("_part"))

    def _within(self, rows: DataFrame, part: list[str], wanted, last_row: str | None) -> DataFrame:
        last_before, max_before, running_sum = wanted
        inside = Window.partitionBy(*part, *self.keys).orderBy(*self.order)
        before, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
        carry = lambda out: F.col(f"_carry_{out}") if part else F.lit(None)
        added = [F.coalesce(F.last(source, ignorenulls=True).over(before), carry(out)).alias(out) for out, source in last_before.items()]
        added += [F.greatest(F.max(source).over(before), carry(out)).alias(out) for out, source in max_before.items()]
        added += [(F.sum(source).over(upto) + F.coalesce(carry(out), F.lit(0))).alias(out) for out, source in running_sum.items()]
        if last_row:
            ends = F.lead(F.lit(1)).over(inside).isNull()
            added.append((ends & F.coalesce("_last_part", F.lit(True)) if part else ends).alias(last_row))
        kept = [c for c in rows.columns if not c.startswith("_carry_") and c != "_last_part"]
        return rows.select(*kept, *added)

    def _carried(self, last_before, max_before, running_sum) -> DataFrame:
        """What a part of a key takes over from the parts before it, for keys in several parts."""
        position = F.struct(*self.order)
        edges = self.hot.groupBy("_part", *self.keys).agg(F.count("*").alias("_n"), *[
            F.max_by(F.col(source), F.when(F.col(source).isNotNull(), position)).alias(f"_edge_{out}")
            for out, source in last_before.items()
        ], *[F.max(source).alias(f"_edge_{out}") for out, source in max_before.items()
        ], *[F.sum(source).alias(f"_edge_{out}") for out, source in running_sum.items()])
        parts = Window.partitionBy(*self.keys).orderBy("_part")
        earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
        return edges.select("_part", *self.keys, F.lead("_part").over(parts).isNull().alias("_last_part"), F.count("*").over(Window.partitionBy(*self.keys)).alias("_spans"), *[
            F.last(f"_edge_{out}", ignorenulls=True).over(earlier).alias(f"_carry_{out}") for out in last_before
        ], *[F.max(f"_edge_{out}").over(earlier).alias(f"_carry_{out}") for out in max_before
        ], *[F.sum(f"_edge_{out}").over(earlier).alias(f"_carry_{out}") for out in running_sum]).where("_spans > 1").drop("_spans")


def number_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Row numbers from 1 per key in ``order``."""
    ones = rows.withColumn("_one", F.lit(1).cast("bigint"))
    return Ordered(ones, keys, order, heavy_rows).add(running_sum={out: "_one"}).rows().drop("_one")
