"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "adledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the daily jobs are tuned for.

    Operators never depend on these settings for their results, only for speed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach, below the folder that ``spark.checkpoint.dir`` names.

    Only on a single machine (a local master, as in tests) may that setting be missing: then one temporary
    folder is made for the session and put into the setting. Anywhere else a missing setting is an error,
    because each executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="adledger-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def task_count(spark: SparkSession) -> int:
    """Tasks that rows are dealt to where their work far outweighs their bytes: as many as after any shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` written once as Parquet in the shared folder, and read from there.

    What follows is planned from the written files: nothing above is computed again, a lost executor costs
    only its own tasks, and Spark knows the true size when it chooses a join.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
