"""Connected components by contraction with random priorities.

Every round joins each vertex to the neighbour, itself included, of least priority and
replaces the edges by edges between the labels. Priorities differ from round to round,
so a path or a star of any size shrinks by a constant factor at least. Each round is a
written table; neither links nor labels pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """id and component_id, the least id reachable, of every id of ``edges`` (a, b).

    Repeated and reversed edges and loops are allowed; null ends are left out.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = cut_lineage(edges.distinct(), "edges")
    labels = []
    while not labels or not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).union(edges.select("a", F.col("a").alias("b"))).union(edges.select("b", F.col("b").alias("a")))
        least = F.min_by("b", F.xxhash64("b", F.lit(len(labels) + 1)))
        step = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(least.alias("label")), "labels")
        labels.append(step)
        ends = edges.join(step.select(F.col("id").alias("a"), F.col("label").alias("x")), "a")
        ends = ends.join(step.select(F.col("id").alias("b"), F.col("label").alias("y")), "b").where("x <> y")
        edges = cut_lineage(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    roots = labels.pop()
    while labels:
        upper = roots.select(F.col("id").alias("label"), F.col("label").alias("root"))
        roots = labels.pop().join(upper, "label", "left").select("id", F.coalesce("root", "label").alias("label"))
    roots = cut_lineage(roots, "roots")
    least = roots.groupBy("label").agg(F.min("id").alias("component_id"))
    return roots.join(least, "label").select("id", "component_id")
