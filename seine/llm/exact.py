"""Exact dedup against a persistent digest index.

The index is a table of the digests seen so far, bucketed and sorted by digest. New
documents are digested where they lie; their distinct digests meet the index in a
sort-merge anti-join that leaves the index where it is, and the new ones are appended.
Texts are equal when identical after lower-casing A-Z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path
from .common import marked, small_batches, text_bytes


def normal_digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower changes A-Z only


def digests(documents: DataFrame) -> DataFrame:
    """doc_id and digest of every row; null text counts as empty."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(map(normal_digest, batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "digest"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).mapInArrow(run, "doc_id long, digest binary")


class DigestIndex:
    """Digests seen so far: digest, keep_id, n_rows (of the batch that brought it), keep_rows.

    ``keep_id`` is the largest doc_id of the digest's batch, null only if all its ids
    are; ``keep_rows`` counts the rows with that id. The table lives at ``path``, so a
    later session opens it again under any ``name``.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, n_rows BIGINT, keep_rows BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def entries(self) -> DataFrame:
        """What the index holds, as plain files: joins with hot digests can then be split."""
        return self.spark.read.schema(self.spark.table(self.name).schema).parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (doc_id, digest) that the index lacks.

        Copies shrink to one row before they are exchanged, by id first and then by
        digest. A repeated call, after a failure or not, adds nothing twice.
        """
        by_id = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
        groups = by_id.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.sum("n").alias("n_rows"),
            F.coalesce(F.max_by("n", "doc_id"), F.sum("n")).alias("keep_rows"),
        )
        seen = self.spark.table(self.name).select("digest").hint("merge")
        new = groups.join(seen, "digest", "left_anti")
        new.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, digest) with the entry of their digest and whether they stay.

        Rows that repeat the kept id with the same text all count as the kept document.
        """
        found = rows.join(self.entries(), "digest", "left")
        return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def keep_one(documents: DataFrame, buckets: int = 64) -> DataFrame:
    """The rows of ``documents`` that stay, every column untouched: of equal texts that of the largest doc_id.

    Where rows repeat the kept id with the same text, one of them stays. A row without an
    id stays only if no copy has one.
    """
    spark = documents.sparkSession
    rows = cut_lineage(digests(documents), "digests")
    path = scratch_path(spark, "digest_index")
    index = DigestIndex(spark, path.rpartition("/")[2].replace("-", "_"), path, buckets)
    index.add(rows)
    # Only rows whose id some copy shares or loses by need a second look.
    open_ids = index.resolve(rows).where(~F.col("kept") | (F.col("keep_rows") > 1)).select("doc_id").distinct()
    maybe = marked(cut_lineage(open_ids, "copies"), "doc_id")
    names = documents.columns
    plain = documents.toDF(*[n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(names)])
    schema = T.StructType([*plain.schema.fields, T.StructField("digest", T.BinaryType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield batch.append_column("digest", pa.array([normal_digest(t or b"") for t in texts], pa.binary()))

    met = plain.where(maybe).mapInArrow(digest, schema).join(index.entries(), "digest")
    met = met.where(F.col("doc_id").cast("long").eqNullSafe(F.col("keep_id")))
    one, several = met.where("keep_rows = 1"), met.where("keep_rows > 1").dropDuplicates(["digest"])
    return plain.where(~maybe).union(one.union(several).select(*plain.columns)).toDF(*names)
