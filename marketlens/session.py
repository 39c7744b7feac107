"""Session settings and tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "marketlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster names in spark.checkpoint.dir; a folder of its own only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/marketlens-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}"


def settle(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write a frame that is read more than once as a table in the shared folder and read it back.

    Expensive parsing runs once, later reads prune columns, the planner sees real sizes, and a lost
    executor re-reads files instead of recomputing. ``codec`` names a closer compression for long texts.
    """
    spark = df.sparkSession
    path = shared_path(spark, "settled")
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread rows of a scan of few tasks, before CPU-heavy expressions.

    A scan of several tasks per core already fills the cluster and is returned unchanged, without a shuffle. One of at least
    a task per core is cut into several per core, so that no task has a core's whole share of a large table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.rdd.getNumPartitions()
    return df if tasks >= 4 * cores else df.repartition(4 * cores if tasks >= cores else cores)


def small_side(df: DataFrame) -> DataFrame:
    """Settle an aggregate, so that the planner knows its bytes.

    It is broadcast below spark.sql.autoBroadcastJoinThreshold; above, the join stays a shuffle join
    under AQE skew handling.
    """
    return settle(df)
