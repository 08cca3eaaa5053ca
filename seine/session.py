"""Session defaults, lineage cuts and input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Whether the shuffle files of a query go when it ends, or when the driver next collects garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Spark's default bytes per scan split.
SPLIT_BYTES = 128 * 1024 * 1024

# Settings for sessions made here. On a cluster the operator's own values apply.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture doubles the gateway traffic of building expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "seine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stream state.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own, since its executors share the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="seine-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut", *, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result survives executor loss, since it is files rather than blocks, and
    later plans start from a columnar scan with real size statistics. With ``tidy`` the
    shuffle files of the writing go as soon as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP_KEY, "false")
    try:
        if tidy:
            spark.conf.set(CLEANUP_KEY, "true")
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy stage over a small input as many partitions as cores.

    The optimizer's size estimate decides, without running anything: an input of
    at least a quarter split per core already fills the cluster and is passed
    through, so large inputs never shuffle their documents. A smaller one is dealt
    out evenly, whatever its keys are.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPLIT_BYTES // 4 else df
