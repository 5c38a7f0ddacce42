"""Stores that change in one step: whole versions beside each other, and six tables whose days are switched together.

A version is written under a name of its own and renamed to the next number. The rename is the only step that readers
notice, and it fails when that number is there already, so of two writers that start from one version one is told. What
readers had open stays until ``keep`` newer versions are there. The file system must rename a folder in one step.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.schemas import table_columns, table_schema
from adledger.session import saved

DAY = "hub_partition_date"
#: Batch of a day that is stored in its own folder, as before the first publication.
IN_FOLDERS = "folders"


class NewerVersion(RuntimeError):
    """Another writer was first."""


def _fs(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, target = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions there are, ascending."""
    return sorted(int(n[1:]) for n in _names(spark, root) if n[:1] == "v" and n[1:].isdigit())


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v{number:012d}"


def commit(df: DataFrame, root: str, after: int = 0, keep: int = 2) -> int:
    """Writes ``df`` as the version after ``after`` and removes all but the last ``keep``; its number.

    ``df`` may read the version before: nothing of that is touched until the new one is in place.
    """
    spark = df.sparkSession
    staged, number = f"{root.rstrip('/')}/.staged-{uuid.uuid4().hex}", after + 1
    df.write.parquet(staged)
    jvm = spark._jvm
    fs, source = _fs(spark, staged)
    target = jvm.org.apache.hadoop.fs.Path(version_path(root, number))
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(source, target, plain)
    except Py4JJavaError as error:
        fs.delete(source, True)
        if fs.exists(target):
            raise NewerVersion(f"version {number} of {root} is there already") from error
        raise
    for old in versions(spark, root)[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(version_path(root, old)), True)
    return number


# --- tables by day --------------------------------------------------------------------------------------

def published(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, f"{root.rstrip('/')}/days"))


def live_days(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """Which batch holds each table's days, ``(table, hub_partition_date, batch)``, and the version that says so.

    Before the first publication these are the day folders there are.
    """
    root, schema = root.rstrip("/"), f"table string, {DAY} date, batch string"
    if numbers := versions(spark, f"{root}/days"):
        return spark.read.schema(schema).parquet(version_path(f"{root}/days", numbers[-1])), numbers[-1]
    stored = [(table, name[len(DAY) + 1:]) for table in _names(spark, root) for name in _names(spark, f"{root}/{table}") if name.startswith(f"{DAY}=")]
    found = spark.createDataFrame(stored, f"table string, {DAY} string")
    return found.select("table", F.col(DAY).cast("date").alias(DAY), F.lit(IN_FOLDERS).alias("batch")), 0


def publish(tables: dict[str, DataFrame], root: str, days: DataFrame, tries: int = 5) -> int:
    """Makes the rows of ``tables`` all that is stored of ``days`` (a column of dates), in all of the tables at once.

    Rows are written once, as one batch beside what is stored, with many small days in one file; then the list of days is
    switched to it. So the cost follows the rows and not the days, and a reader sees the days as they were or
    as they will be. A writer that stops before the switch leaves everything as it was. ``tables`` are aligned and
    hold no other days.
    """
    spark, root = days.sparkSession, root.rstrip("/")
    batch, asked = uuid.uuid4().hex, saved(days.select(F.col(days.columns[0]).cast("date").alias(DAY)).distinct(), "published-days")
    for table, rows in tables.items():
        rows.hint("rebalance").sortWithinPartitions(DAY).write.parquet(f"{root}/batches/{batch}/{table}")
    new = asked.select(F.explode(F.array(*(F.lit(t) for t in tables))).alias("table"), DAY)
    for attempt in range(tries):
        old, number = live_days(spark, root)
        # as many rows as tables times calendar days
        listed = old.join(new, ["table", DAY], "left_anti").unionByName(new.withColumn("batch", F.lit(batch)))
        try:
            return commit(listed.coalesce(1), f"{root}/days", number)
        except NewerVersion:
            if attempt + 1 == tries:
                raise
    return 0


def read_published(spark: SparkSession, root: str, table: str, date: str | None = None) -> DataFrame:
    """The live rows of one table. Only batches that hold an asked day are read, and of those the day's row groups."""
    root, schema, columns = root.rstrip("/"), table_schema(table), table_columns(table)
    days = live_days(spark, root)[0].filter(F.col("table") == table).drop("table")
    if date:
        days = days.filter(F.col(DAY) == F.lit(date).cast("date"))
    # batches, at most one for each day
    batches = sorted(r["batch"] for r in days.select("batch").distinct().collect())
    out = spark.createDataFrame([], schema)
    paths = [f"{root}/batches/{b}/{table}" for b in batches if b != IN_FOLDERS]
    if paths:
        rows = spark.read.schema(schema).parquet(*paths).select("*", F.regexp_extract("_metadata.file_path", r"/batches/([^/]+)/[^/]+/[^/]+$", 1).alias("batch"))
        out = rows.join(F.broadcast(days), [DAY, "batch"], "left_semi").select(*columns)
    if IN_FOLDERS in batches:
        old = spark.read.schema(schema).parquet(f"{root}/{table}").select(*columns)
        old = old.join(F.broadcast(days.filter(F.col("batch") == IN_FOLDERS).select(DAY)), DAY, "left_semi").select(*columns)
        out = out.unionByName(old) if paths else old
    return out.filter(F.col(DAY) == F.lit(date).cast("date")) if date else out


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Removes batches that no kept version of the list of days names, and gives their names.

    To be run when no publication is under way: one that has not switched yet looks abandoned.
    """
    root = root.rstrip("/")
    kept = {r["batch"] for n in versions(spark, f"{root}/days") for r in spark.read.parquet(version_path(f"{root}/days", n)).select("batch").distinct().collect()}
    gone = [b for b in _names(spark, f"{root}/batches") if b not in kept]
    for b in gone:
        fs, target = _fs(spark, f"{root}/batches/{b}")
        fs.delete(target, True)
    return gone
