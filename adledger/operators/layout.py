"""Partition layout and object inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.text import as_col, suffix

PARTITION = r"^(.*?)/?year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})/"


def partition_date(listing_date: Column | str) -> Column:
    """L1: rows listed on a day are saved under the next day."""
    return F.date_add(as_col(listing_date).cast("date"), 1)


def backfill_dates(dates: DataFrame) -> DataFrame:
    """Scrape and save date of each target date."""
    target = F.col("target_date").cast("date")
    return dates.select(F.date_sub(target, 1).alias("scrape_date"), target.alias("save_date"))


def partition_prefixes(days: DataFrame) -> DataFrame:
    """L2: the padded and unpadded folder prefixes of ``(base, date)``, without repeats."""
    day = F.col("date").cast("date")

    def prefix(month_format: str, day_format: str) -> Column:
        return F.concat(
            F.col("base"), F.lit("/year="), F.year(day).cast("string"),
            F.lit("/month="), F.date_format(day, month_format),
            F.lit("/day="), F.date_format(day, day_format), F.lit("/"),
        )

    forms = F.array_distinct(F.array(*[prefix(m, d) for m in ("MM", "M") for d in ("dd", "d")]))
    return days.select("base", "date", F.explode(forms).alias("prefix"))


def with_partition(objects: DataFrame) -> DataFrame:
    """Base folder and save date read from each key, null outside date folders.

    Padded and unpadded folders give the same date, so both forms of a day meet in one group.
    """
    key = F.col("key")

    def part(n: int) -> Column:
        return F.regexp_extract(key, PARTITION, n)

    date = F.concat_ws("-", part(2), F.lpad(part(3), 2, "0"), F.lpad(part(4), 2, "0")).try_cast("date")
    found = key.rlike(PARTITION)
    return objects.withColumn("base", F.when(found, part(1))).withColumn("save_date", F.when(found, date))


def objects_in_partition(objects: DataFrame, base: str, date: str) -> DataFrame:
    """L3: objects of one base folder and day under either form of the path, each key once."""
    prefix_test = F.col("key").startswith(f"{base.strip('/')}/year={date[:4]}/")
    found = with_partition(objects.filter(prefix_test)).filter(
        (F.col("base") == base.strip("/")) & (F.col("save_date") == F.lit(date).cast("date"))
    )
    return found.dropDuplicates(["key"])


def strip_base_placeholder(path: Column | str) -> Column:
    """L4: storage path without its leading ``{bucket}/`` and without outer slashes."""
    return F.regexp_replace(F.regexp_replace(F.trim(as_col(path)), r"^\{[^/]*/", ""), "^/+|/+$", "")


def storage_category(key: Column | str) -> Column:
    """Storage type by file extension."""
    ext = suffix(key)
    chosen = None
    for name, extensions in rules.STORAGE_TYPES.items():
        chosen = F.when(ext.isin(*extensions), name) if chosen is None else chosen.when(ext.isin(*extensions), name)
    return chosen.otherwise("other")


def real_objects(objects: DataFrame) -> DataFrame:
    return objects.filter(~F.col("key").endswith("/"))


def under_prefix(objects: DataFrame, prefix: str) -> DataFrame:
    clean = prefix.strip("/")
    return real_objects(objects).filter(F.col("key").startswith(f"{clean}/")) if clean else real_objects(objects)


def inventory(objects: DataFrame, prefix: str) -> DataFrame:
    """Number and bytes of objects under a prefix."""
    return under_prefix(objects, prefix).agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes")
    )


def type_sums() -> list[Column]:
    """Totals and bytes per storage type, one column each; no pivot, so one pass and one small row."""
    kind = F.col("storage_type")
    return [
        F.count(F.lit(1)).alias("objects"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
        *[F.count_if(kind == c).alias(f"{c}_objects") for c in rules.STORAGE_CATEGORIES],
        *[F.coalesce(F.sum(F.when(kind == c, F.col("size_bytes"))), F.lit(0)).alias(f"{c}_bytes")
          for c in rules.STORAGE_CATEGORIES],
    ]


def inventory_by_type(objects: DataFrame, prefix: str) -> DataFrame:
    """L6 split by storage type, every type present."""
    return under_prefix(objects, prefix).withColumn("storage_type", storage_category("key")).agg(*type_sums())


def daily_inventory_by_type(objects: DataFrame, base: str, date: str) -> DataFrame:
    """L7 over the objects of one day."""
    found = real_objects(objects_in_partition(objects, base, date))
    return found.withColumn("storage_type", storage_category("key")).agg(*type_sums())


def folder_totals(objects: DataFrame) -> DataFrame:
    """Bytes and counts of every folder over all it holds, however deep.

    Objects are added up per direct folder first; only those few totals are then spread to the folders above.
    """
    direct = (
        real_objects(objects)
        .withColumn("storage_type", storage_category("key"))
        .withColumn("folder", F.regexp_extract("key", r"^(.*)/[^/]*$", 1))
        .groupBy("folder", "storage_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("size_bytes"))
    )
    parts = F.split("folder", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    spread = direct.withColumn("prefix", F.explode(ancestors))
    kind = F.col("storage_type")
    return spread.groupBy("prefix").agg(
        F.sum("n").alias("objects"),
        F.sum("size_bytes").alias("size_bytes"),
        *[F.coalesce(F.sum(F.when(kind == c, F.col("size_bytes"))), F.lit(0)).alias(f"{c}_bytes")
          for c in rules.STORAGE_CATEGORIES],
    )


def scraper_storage(objects: DataFrame, scrapers: DataFrame, date: str) -> DataFrame:
    """Total and daily storage of every scraper, 0 where nothing is stored.

    ``scrapers`` has the configured path in ``base_path``. Folders meet scrapers by equality.
    """
    sites = scrapers.withColumn("prefix", strip_base_placeholder("base_path"))
    totals = folder_totals(objects)
    total_cols = [F.col("objects").alias("r2_file_count"), F.col("size_bytes").alias("r2_size_bytes")]
    total_cols += [F.col(f"{c}_bytes").alias(f"r2_{c}_bytes") for c in rules.STORAGE_CATEGORIES]
    day = (
        with_partition(real_objects(objects))
        .filter(F.col("save_date") == F.lit(date).cast("date"))
        .withColumn("storage_type", storage_category("key"))
        .groupBy(F.col("base").alias("prefix"))
        .agg(*type_sums())
    )
    day_cols = [F.col("size_bytes").alias("r2_daily_size")]
    day_cols += [F.col(f"{c}_bytes").alias(f"r2_daily_{c}_bytes") for c in rules.STORAGE_CATEGORIES]
    return (
        sites.join(totals.select("prefix", *total_cols), "prefix", "left")
        .join(day.select("prefix", *day_cols), "prefix", "left")
        .na.fill(0)
    )


def backfill_window(dates: DataFrame, days: int) -> DataFrame:
    """Dates within ``days`` that end at the latest date there is; 0 keeps all."""
    distinct = dates.select(F.col("date").cast("date").alias("date")).distinct()
    if days <= 0:
        return distinct
    latest = dates.select(F.max(F.col("date").cast("date"))).scalar()
    return distinct.filter(F.col("date") >= F.date_sub(latest, days - 1))


def rekey_plan(objects: DataFrame, bad: str, good: str) -> DataFrame:
    """Where each object under the wrong prefix should go."""
    rest = F.substr("key", F.lit(len(bad) + 1))
    return objects.filter(F.col("key").startswith(bad)).select(
        F.col("key").alias("from_key"), F.concat(F.lit(good), rest).alias("to_key")
    )


def partition_stats(objects: DataFrame, days: DataFrame) -> DataFrame:
    """Files, bytes and megabytes of each asked ``(base, date)``, zeros when empty.

    The key list of a partition is the stored object listing itself (:func:`objects_in_partition`), so it
    stays a table and is not gathered into one cell.
    """
    stored = with_partition(objects).groupBy("base", F.col("save_date").alias("date")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("total_size_bytes")
    )
    asked = days.select("base", F.col("date").cast("date").alias("date"))
    return (
        asked.join(stored, ["base", "date"], "left")
        .na.fill(0, ["file_count", "total_size_bytes"])
        .withColumn("total_size_mb", F.round(F.col("total_size_bytes") / (1024 * 1024), 2))
    )


def list_partition_dates(objects: DataFrame, suffix_name: str) -> DataFrame:
    """Dates whose folder holds a given file, in order."""
    date = F.regexp_extract("key", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return (
        objects.filter(F.col("key").endswith(f"/{suffix_name}"))
        .select(date.alias("date"))
        .filter(F.col("date") != "")
        .distinct()
        .orderBy("date")
    )
