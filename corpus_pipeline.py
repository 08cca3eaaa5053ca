"""The training-corpus pipeline: documents in, packed sequences out.

Every stage takes the session, what its predecessor kept and the folder of the tables,
and is written out before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seine.llm import catalog, exact, langid, minhash, packing, toxicity
from seine.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; empty and letterless ones go."""
    return langid.keep_known(docs, langid.train(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain trained on the labels does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels, catalog.categories()))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest doc_id; a repeated row of it goes too."""
    return exact.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies on five-word shingles, that of the least doc_id."""
    return minhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, ids as a checksum."""
    path = catalog.tokenizer_path("word_bpe_49k.json")
    pieces = packing.pack(docs, lambda: packing.WordTokenizer(path))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("packing", packed),
]

# Trained models and packing have no SQL form; the tests hold the dedup stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
