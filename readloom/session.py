"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "readloom", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode and where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), f"readloom-{spark.sparkContext.applicationId}")


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A path nobody used before, in the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps the partitioning of ``df``."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished plans: its cleaner waits until the driver collects garbage, by default half an hour."""
    spark._jvm.System.gc()


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` through packed parquet files in the shared folder: lineage is cut as by a checkpoint, in a fraction of its bytes.

    The partitioning of ``df`` is forgotten; readers open the columns they need only.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def fixed_layout(spark: SparkSession, rows: int, rows_per_task: int = 1 << 18):
    """Run with static plans, so that checkpoints remember how their rows are partitioned.

    An adaptive plan does not know its final partitioning in advance, and a checkpoint taken from
    it is shuffled again by every later join. Loops that join one table many times lay it out here.
    As nothing coalesces or splits partitions then, their number follows from ``rows`` alone.
    """
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {key: spark.conf.get(key) for key in keys}
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], str(wanted))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
