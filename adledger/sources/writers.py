"""Sinks (S6, S7, S11) and table upkeep."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from adledger import schemas
from adledger.operators.layout import backfill_window
from adledger.operators.ordering import first_rows
from adledger.session import saved, task_count
from adledger.sources.readers import LINES_ENDING, path_exists, read_baseline, read_hub_table
from adledger.sources.versions import commit, publish, published, versions

PARTITION_COLUMN = "hub_partition_date"


def align(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order; absent ones null or their default, extra ones dropped."""
    defaults = schemas.DEFAULTS.get(table, {})
    columns = []
    for name, kind in schemas.table_types(table).items():
        value = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        columns.append((F.coalesce(value, F.lit(defaults[name])) if name in defaults else value).alias(name))
    return df.select(*columns)


def dedupe_by_key(df: DataFrame, keys: list[str], sequence: str = "seq") -> DataFrame:
    """The last row of each primary key by sequence."""
    return first_rows(df, keys, [F.desc(sequence)])


def last_of_key(df: DataFrame, table: str) -> DataFrame:
    """One row per primary key of a table: the last by ``seq`` where rows carry it, then by all their values."""
    sequence = [F.desc("seq")] if "seq" in df.columns else []
    return first_rows(df, schemas.PRIMARY_KEYS[table], [*sequence, *(F.desc(c) for c in schemas.table_columns(table) if c in df.columns)])


def write_hub_table(df: DataFrame, root: str, table: str) -> None:
    """One folder per table and day; only the days in the batch are replaced.

    Rows are rebalanced by day first: a day is a few files, and a large day is split over several tasks. Where days
    are published in batches, these days are published too.
    """
    if published(df.sparkSession, root):
        rows = saved(align(df, table), "batch")
        publish({table: rows}, root, rows.select(PARTITION_COLUMN).distinct())
        return
    (
        align(df, table)
        .hint("rebalance", PARTITION_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
        .parquet(f"{root.rstrip('/')}/{table}")
    )


def drop_partition(spark: SparkSession, root: str, table: str, date: str) -> None:
    folder = f"{root.rstrip('/')}/{table}/{PARTITION_COLUMN}={date}"
    if path_exists(spark, folder):
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def replace_partition(df: DataFrame, root: str, table: str, date: str) -> None:
    """The batch takes the place of the stored day, one row per key; an empty batch still empties it.

    The batch is worked out once and kept in the shared folder while it is looked at and written.
    """
    batch = saved(align(last_of_key(df.filter(F.col(PARTITION_COLUMN) == F.lit(date).cast("date")), table), table), "batch")
    if published(df.sparkSession, root):
        publish({table: batch}, root, df.sparkSession.createDataFrame([(date,)], "date string"))
    elif batch.isEmpty():
        drop_partition(df.sparkSession, root, table, date)
    else:
        write_hub_table(batch, root, table)


def ensure_schema(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All six tables with every column, whatever is stored; columns a file lacks read as null."""
    return {table: read_hub_table(spark, root, table) for table in schemas.TABLES}


def _as_stored(rows: DataFrame, table: str) -> DataFrame:
    """Rows as they are stored: aligned, one per primary key."""
    return align(last_of_key(rows, table), table)


def push_partition(tables: dict[str, DataFrame], root: str, date: str) -> bool:
    """Replace one day in all six tables in one step; nothing is done when the hub table has no row for it.

    Readers see the old day in every table until the list of days is switched, and the new one after.
    """
    spark, of_day = tables["hub_daily"].sparkSession, F.col(PARTITION_COLUMN) == F.lit(date).cast("date")
    if tables["hub_daily"].filter(of_day).isEmpty():
        return False
    publish({t: _as_stored(df.filter(of_day), t) for t, df in tables.items()}, root, spark.createDataFrame([(date,)], "date string"))
    return True


def backfill(tables: dict[str, DataFrame], root: str, days: int = 0) -> None:
    """Replace all days of the window in all tables, as one batch whose cost follows its rows.

    Days without a hub row are left as stored. A day that lost its rows in one table is emptied there.
    """
    wanted = backfill_window(tables["hub_daily"].select(F.col(PARTITION_COLUMN).alias("date")), days)
    wanted = saved(wanted.select(F.col("date").alias(PARTITION_COLUMN)), "days")
    publish({t: _as_stored(df.join(wanted, PARTITION_COLUMN, "left_semi"), t) for t, df in tables.items()}, root, wanted)


def report_documents(scrapers: DataFrame, totals: DataFrame) -> DataFrame:
    """One JSON report per site and day from scraper rows and site totals.

    A report lists the scrapers of one site, a configured handful; listings never enter it.
    """
    keys = ["site_id", "run_date"]
    fields = [c for c in scrapers.columns if c not in keys]
    grouped = scrapers.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("scraper").alias("k"), F.struct(*fields).alias("v"))))).alias("scrapers")
    )
    joined = totals.join(grouped, keys, "left")
    body = F.to_json(F.struct("run_date", "site_id", *[c for c in totals.columns if c not in keys], "scrapers"))
    return joined.select(*keys, body.alias("body"))


def hub_documents(site_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """One merged JSON document per hub date from site rows and hub totals."""
    fields = [c for c in site_rows.columns if c not in ("hub_date", "seq", "doc")]
    as_text = F.to_json(F.struct(*fields, F.col("doc").alias("report")))
    sites = site_rows.select("hub_date", "seq", as_text.alias("s")).groupBy("hub_date").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "s"))), lambda e: e["s"]), ",").alias("sites")
    )
    head = totals.select(
        "hub_date",
        F.to_json(F.struct(F.col("hub_date").cast("string").alias("run_date"), *[c for c in totals.columns if c != "hub_date"])).alias("head"),
    )
    whole = F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.lit(',"sites":['), F.coalesce("sites", F.lit("")), F.lit("]}"))
    return head.join(sites, "hub_date", "left").select("hub_date", whole.alias("body"))


def write_documents(docs: DataFrame, root: str, lines: bool = False) -> None:
    """Each ``(key, body)`` row as one file under ``root``, or with ``lines`` as one line of a file in the key's folder.

    Tasks write the files they hold, so nothing passes through the driver. A file costs far more than its bytes, so
    documents are dealt out by key first, however few tasks they come from; those of one key meet in one task. A file
    is written under a name of its own and then renamed, so a task that is stopped or run twice never leaves half a
    document under a key. ``root`` must be a folder that all executors share.
    """
    if lines:
        return _write_lines(docs, root)

    def write_part(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(root)
        made = set()
        for row in rows:
            path = f"{base}/{row['key']}"
            folder, name = path.rsplit("/", 1)
            if folder not in made:
                target.create_dir(folder, recursive=True)
                made.add(folder)
            own = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with target.open_output_stream(own) as out:
                out.write(row["body"].encode("utf-8"))
            target.move(own, path)

    docs.select("key", "body").repartition(task_count(docs.sparkSession), "key").foreachPartition(write_part)


def _write_lines(docs: DataFrame, root: str) -> None:
    """The documents of each folder as lines ``{"name", "body"}`` of few compressed files in it.

    However short, a file of its own takes a block of the disk and a place in the driver's list, which is too much for
    millions of small documents. Keys are dealt out by range, so a folder comes to as many tasks as its documents are
    worth, and a task writes one file per folder. Files are named by the task's number, so a task run twice replaces its
    own; for the same reason ``root`` must be new. Of documents with one key the last stays.
    """
    if path_exists(docs.sparkSession, root):
        raise ValueError(f"{root} is there already: documents are written as lines only once")

    def write_part(rows: Iterator[Row]) -> None:
        from pyarrow import fs
        from pyspark import TaskContext

        target, base = fs.FileSystem.from_uri(root)
        task = TaskContext.get().partitionId()
        for n, (folder, held) in enumerate(groupby(rows, lambda row: row["folder"])):
            place, part = f"{base}/{folder}" if folder else base, f"part-{task:05d}-{n}"
            target.create_dir(place, recursive=True)
            own = f"{place}/.{part}.{uuid.uuid4().hex}"
            with target.open_output_stream(own, compression="gzip") as out:
                for name, same in groupby(held, lambda row: row["name"]):
                    *_, last = same
                    if last["body"] is None:
                        raise ValueError(f"no text to write under {folder}/{name}")
                    out.write(json.dumps({"name": name, "body": last["body"]}, ensure_ascii=False).encode("utf-8") + b"\n")
            target.move(own, f"{place}/{part}{LINES_ENDING}")

    place = [F.regexp_extract("key", r"(?s)^(.*)/", 1).alias("folder"), F.substring_index("key", "/", -1).alias("name")]
    placed = docs.select(*place, "body", F.monotonically_increasing_id().alias("seq"))
    dealt = placed.repartitionByRange(task_count(docs.sparkSession), "folder", "name").sortWithinPartitions("folder", "name", "seq")
    dealt.select("folder", "name", "body").foreachPartition(write_part)


def report_key(prefix: Column, date: Column) -> Column:
    return F.concat(prefix, F.lit("/monitor/"), date.cast("string"), F.lit("/report.json"))


def hub_document_key(date: Column) -> Column:
    return F.concat(F.lit("hub/"), date.cast("string"), F.lit("/all-sites.json"))


def write_baseline(df: DataFrame, path: str) -> int:
    """A new version of the stored statistics, which may be made of the one before; its number."""
    numbers = versions(df.sparkSession, path)
    return commit(df, path, numbers[-1] if numbers else 0)


def update_baseline(spark: SparkSession, path: str, observed: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], kind: str = "baseline") -> int:
    """S11 with B4: the newest stored statistics merged with what was observed, as the next version.

    The pointer is the version's number: a run that is stopped leaves the store as it was, and one that finds that
    another run was first fails with ``NewerVersion`` and can be repeated.
    """
    numbers = versions(spark, path)
    return commit(merge(read_baseline(spark, path, kind), observed), path, numbers[-1] if numbers else 0)
