"""Alerts (R1-R6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.functions.text import file_name
from adledger.operators.ordering import first_rows

NULL_ID_LIMIT = 5
STALE_LIMIT = 20


def check_severity(name: Column) -> Column:
    """R2: severity by check name."""
    return (
        F.when((name == "file_readable") | name.startswith("sheet_exists"), "critical")
        .when(name.startswith("trend_rows_high"), "medium")
        .otherwise("high")
    )


def flatten_failures(checks: DataFrame, quality: DataFrame) -> DataFrame:
    """One row per failed check or quality breach."""
    failed = checks.filter(~F.col("passed")).select(
        "scraper", "file_key", F.col("check_name").alias("check"), "detail", F.lit("validation").alias("kind")
    )

    def breach(metric: str, limit: float, words: str) -> Column:
        text = F.concat(F.lit("Sheet '"), F.col("sheet"), F.lit("': "), F.col(metric).cast("string"), F.lit(f"% {words}"))
        return F.when(F.col(metric) >= limit, F.struct(F.lit(metric).alias("check"), text.alias("detail")))

    breaches = F.filter(
        F.array(breach("null_id_pct", NULL_ID_LIMIT, "null IDs"), breach("stale_date_pct", STALE_LIMIT, "stale dates")),
        lambda b: b.isNotNull(),
    )
    poor = quality.select("scraper", "file_key", F.inline(breaches)).withColumn("kind", F.lit("quality"))
    return failed.unionByName(poor).withColumn("file", file_name("file_key"))


def collect_alerts(verdicts: DataFrame, failures: DataFrame) -> DataFrame:
    """Alerts of scrapers without files, failed checks and quality breaches."""
    empty = verdicts.filter((F.col("files_found") == 0) & ~F.coalesce("files_optional", F.lit(False))).select(
        "scraper",
        F.lit("critical").alias("severity"),
        F.lit("no_files").alias("type"),
        F.lit("files_found").alias("check"),
        F.lit("No Excel files found for target date").alias("detail"),
        F.lit(None).cast("string").alias("file_key"),
    )
    severity = F.when(F.col("kind") == "validation", check_severity(F.col("check"))).otherwise("high")
    told = failures.select(
        "scraper", severity.alias("severity"), F.col("kind").alias("type"), "check", "detail", "file_key"
    )
    return empty.unionByName(told)


def alert_gate(
    alerts: DataFrame, total_scrapers: DataFrame, enabled: bool = True, on_any: bool = True, max_rate_pct: float = 0.0
) -> DataFrame:
    """Whether to send. With a rate, only when that share of scrapers has alerts.

    ``total_scrapers`` is the table of configured scrapers; both counts are one-row aggregates.
    """
    configured = total_scrapers.select(F.count(F.lit(1))).scalar()
    counted = alerts.agg(F.count(F.lit(1)).alias("alerts"), F.count_distinct("scraper").alias("failing_scrapers"))
    rate = F.when(F.col("total_scrapers") > 0, F.col("failing_scrapers") * 100.0 / F.col("total_scrapers")).otherwise(F.lit(100.0))
    send = F.lit(enabled and on_any) & (F.col("alerts") > 0)
    if max_rate_pct > 0:
        send = send & (rate >= max_rate_pct)
    return counted.withColumn("total_scrapers", configured).withColumn("send", send)


def failure_breakdown(failures: DataFrame, k: int = 20) -> DataFrame:
    """Failed checks by number of failures, with the first six scrapers and how many more."""
    per_scraper = failures.groupBy("check", "scraper").agg(F.count(F.lit(1)).alias("n"))
    counts = per_scraper.groupBy("check").agg(F.sum("n").alias("failures"), F.count(F.lit(1)).alias("_scrapers"))
    shown = first_rows(per_scraper, ["check"], ["scraper"], 6).groupBy("check").agg(F.array_sort(F.collect_list("scraper")).alias("_names"))
    more = F.when(F.col("_scrapers") > 6, F.concat(F.lit(" (+"), (F.col("_scrapers") - 6).cast("string"), F.lit(" more)")))
    sample = F.concat(F.array_join("_names", ", "), F.coalesce(more, F.lit("")))
    return counts.join(shown, "check").select("check", "failures", sample.alias("scrapers")).orderBy(F.desc("failures"), "check").limit(k)


def alert_digest(alerts: DataFrame, k: int = 8) -> DataFrame:
    """Text per scraper: its first alerts, then how many more."""
    order = ["severity", "check", "detail", "file_key"]
    counts = alerts.groupBy("scraper").agg(F.count(F.lit(1)).alias("n"))
    shown = first_rows(alerts, ["scraper"], order, k)
    where = F.coalesce(F.concat(F.lit(" - "), file_name("file_key")), F.lit(""))
    line = F.concat(F.upper("severity"), F.lit(" "), F.col("check"), F.lit(": "), F.col("detail"), where)
    lines = shown.groupBy("scraper").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))), lambda s: s["line"]).alias("_lines")
    )
    more = F.when(F.col("n") > k, F.concat(F.lit("\n+"), (F.col("n") - k).cast("string"), F.lit(" more")))
    text = F.concat(F.lit("["), F.col("scraper"), F.lit("]\n"), F.array_join("_lines", "\n"), F.coalesce(more, F.lit("")))
    return counts.join(lines, "scraper").select("scraper", F.col("n").alias("alerts"), text.alias("digest"))
