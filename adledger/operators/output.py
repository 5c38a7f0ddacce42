"""Grouped output and run figures (G2-G7). Sheet names (G1) are in ``functions.text``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.functions.text import pct
from adledger.operators.ordering import first_rows


def info_rollup(listings: DataFrame, scraped: Column) -> DataFrame:
    """One row per category: listings, groups, whether it has sub-categories, scrape and save date."""
    return listings.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.bool_or(F.col("child") != "Main").alias("has_subcategories"),
        F.count_distinct("child").alias("subcategories_count"),
    ).select("*", scraped.cast("date").alias("scraped_date"), F.date_add(scraped.cast("date"), 1).alias("saved_date"))


def info_by_type(listings: DataFrame) -> DataFrame:
    """G2, second form: the kind of category, its child categories and its listings."""
    return listings.groupBy("category").agg(
        F.bool_or(F.col("child") != "Main").alias("_has"),
        F.count_distinct(F.when(F.col("child") != "Main", F.col("child"))).alias("child_categories_count"),
        F.count(F.lit(1)).alias("total_listings"),
        F.max("page").alias("total_pages"),
    ).select(
        "category", F.when(F.col("_has"), "Has Child Categories").otherwise("Direct Listings").alias("type"),
        "child_categories_count", "total_listings", "total_pages",
    )


def category_totals(listings: DataFrame) -> DataFrame:
    """Counts per child, per category and in total, in one rollup. A total has null names."""
    return listings.rollup("category", "child").agg(
        F.count(F.lit(1)).alias("listings"), F.grouping_id().alias("level")
    )


def category_summary(listings: DataFrame) -> DataFrame:
    """One row per category that has listings, its children as an ordered list of (child, listings).

    Children are counted before they are gathered, so a list holds one entry per child.
    """
    children = listings.groupBy("category", "child").agg(F.count(F.lit(1)).alias("listings"))
    return children.groupBy("category").agg(
        F.sum("listings").alias("listings_count"),
        F.count(F.lit(1)).alias("subcategories_count"),
        F.array_sort(F.collect_list(F.struct("child", "listings"))).alias("subcategories"),
    )


def summary_document(summary: DataFrame, scraped: Column) -> DataFrame:
    """The summary as one JSON document; it holds one entry per category."""
    entries = F.array_sort(F.collect_list(F.struct("category", "listings_count", "subcategories_count", "subcategories")))
    return summary.agg(
        F.count(F.lit(1)).alias("total_subcategories"), F.sum("listings_count").alias("total_listings"), entries.alias("subcategories")
    ).select(F.to_json(F.struct(scraped.alias("data_scraped_date"), "total_subcategories", "total_listings", "subcategories")).alias("body"))


def write_grouped(listings: DataFrame, path: str) -> None:
    """Listings by day, category and group, one folder each.

    Only the folders of the batch are replaced. Rows are rebalanced by folder before the write: small folders share a task, a large one is split over
    several, and no task holds files open for folders it barely feeds.
    """
    folders = ["year", "month", "day", "category", "child"]
    day = F.col("save_date").cast("date")
    (
        listings.withColumn("year", F.year(day))
        .withColumn("month", F.month(day))
        .withColumn("day", F.dayofmonth(day))
        .drop("save_date")
        .hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def run_metrics(requests: DataFrame) -> DataFrame:
    """Per run requests, failures, error share, rate and duration.

    ``session_count`` is the counter of the run's own session; the larger of it and the logged rows counts.
    """
    seconds = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    runs = requests.groupBy("run_id").agg(
        F.greatest(F.count(F.lit(1)), F.max("session_count")).alias("requests_total"),
        F.count_if("failed").alias("requests_failed"),
        (seconds / 1e6).alias("_sec"),
    )
    rate = F.when(F.col("_sec") > 0, F.col("requests_total") / (F.col("_sec") / 60.0)).otherwise(F.lit(0.0))
    return runs.select(
        "run_id", "requests_total", "requests_failed",
        pct(F.col("requests_failed"), F.col("requests_total")).alias("error_rate_pct"),
        F.round(rate, 2).alias("requests_per_min"),
        F.round("_sec", 2).alias("duration_sec"),
    )


def fetch_log_dedupe(log: DataFrame) -> DataFrame:
    """The first response of each address."""
    return first_rows(log, ["url"], ["ts", "request_id"])


def cache_hits(log: DataFrame, by: list[str]) -> DataFrame:
    """Requests answered from memory: requests minus distinct addresses."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("url").alias("fetched"),
        (F.count(F.lit(1)) - F.count_distinct("url")).alias("cache_hits"),
    )


def coverage_summary(listings: DataFrame, levels: list[str]) -> DataFrame:
    """Listings, pages, details fetched and errors per level, with totals of each level above.

    ``page_key`` names a page; pages are made distinct first, so the rollup adds plain counts.
    """
    per_page = listings.groupBy(*levels, "page_key").agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if("has_detail").alias("detail_fetches"),
        F.count_if("is_error").alias("errors"),
    )
    return per_page.rollup(*levels).agg(
        F.sum("listings").alias("listings"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("detail_fetches").alias("detail_fetches"),
        F.sum("errors").alias("errors"),
        F.grouping_id().alias("level"),
    )
