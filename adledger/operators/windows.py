"""Distinct values per scraper and day in a form that merges, so that any window of days is counted without its rows.

A set is a few rows ``(scraper, kind, day, bucket, bits, texts)``. Whole numbers are bits: a bucket is 64 neighbours, one long.
Other values are texts in hashed buckets. Both merge exactly: longs by OR, texts by union. A day that is computed again
replaces its own sets and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.operators.ads import id_values
from adledger.operators.validation import phone_identities

KEYS = ["scraper", "kind"]
SET_COLUMNS = "scraper string, kind string, bucket bigint, bits bigint, texts array<string>, day date"


def ad_id_values(rows: DataFrame) -> DataFrame:
    """A1 by day: ``scraper, kind, day, value`` of every id text there is."""
    return id_values(rows, "day").filter(F.col("ad_id").isNotNull()).select("scraper", F.lit("ad_id").alias("kind"), "day", F.col("ad_id").alias("value"))


def phone_values(rows: DataFrame) -> DataFrame:
    """V6 by day: each phone as one of all, and as valid, of another country or invalid."""
    told = F.when(F.col("status") == "valid", "valid").when(F.col("status") == "wrong_country_code", "outside").otherwise("invalid")
    kinds = F.explode(F.array(F.lit("phone"), told)).alias("kind")
    return phone_identities(rows, "day").select("scraper", kinds, "day", F.col("identity").alias("value"))


def day_sets(values: DataFrame, buckets: int = 4096) -> DataFrame:
    """The sets of ``values`` (scraper, kind, day, value). Texts of a scraper and day are spread over ``buckets`` buckets;
    sets that are merged must have the same number."""
    number = F.when(F.col("value").rlike(r"^(0|[1-9][0-9]{0,17})$"), F.col("value").try_cast("bigint"))
    hashed = -1 - F.pmod(F.xxhash64("value"), F.lit(buckets))
    placed = values.select(*KEYS, F.col("day").cast("date").alias("day"), "value", number.alias("n"))
    return (
        placed.withColumn("bucket", F.coalesce(F.shiftright("n", 6), hashed))
        .groupBy(*KEYS, "bucket", "day")
        .agg(
            F.coalesce(F.bit_or(F.expr("shiftleft(1L, cast(n & 63 AS int))")), F.lit(0).cast("bigint")).alias("bits"),
            F.collect_set(F.when(F.col("n").isNull(), F.col("value"))).alias("texts"),
        )
        .select(*KEYS, "bucket", "bits", "texts", "day")
    )


def write_day_sets(sets: DataFrame, root: str) -> None:
    """One folder per day; only the days in the batch are replaced."""
    sets.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(root)


def read_day_sets(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SET_COLUMNS).parquet(root)


def window_counts(sets: DataFrame, days: int = 7) -> DataFrame:
    """``scraper, kind, day_to, distinct_count`` for each window of ``days`` days that holds anything and ends on or before
    the last day stored."""
    last = sets.agg(F.max("day").alias("last")).first()["last"]
    ends = F.sequence("day", F.least(F.date_add("day", days - 1), F.lit(last).cast("date")))
    each = sets.select(*KEYS, "bucket", "bits", "texts", F.explode(ends).alias("day_to"))
    merged = each.groupBy(*KEYS, "day_to", "bucket").agg(
        F.bit_count(F.bit_or("bits")).alias("numbers"), F.size(F.array_distinct(F.flatten(F.collect_list("texts")))).alias("others")
    )
    return merged.groupBy(*KEYS, "day_to").agg(F.sum(F.col("numbers") + F.col("others")).cast("bigint").alias("distinct_count"))
