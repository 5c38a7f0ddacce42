"""From site reports to stored daily tables, in one application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.operators import hub
from adledger.operators.layout import backfill_window
from adledger.operators.sites import asked_days, fallback_policy, latest_usable_report, report_facts, summarize_site, summarized_reports
from adledger.sources import writers


def documents_of_window(hub_docs: DataFrame, days: int) -> DataFrame:
    """Documents of the last days there are, cut before anything is taken out of them."""
    dated = hub_docs.withColumn("_date", hub.hub_date("doc"))
    wanted = backfill_window(dated.select(F.col("_date").alias("date")).filter("date IS NOT NULL"), days)
    return dated.join(wanted.select(F.col("date").alias("_date")), "_date", "left_semi").drop("_date")


def tables_of_window(
    hub_docs: DataFrame, registry: DataFrame, days: int, folder_defaults: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """The six tables of the last days there are."""
    return hub.flatten_hub(documents_of_window(hub_docs, days), registry, folder_defaults)


def backfill_documents(
    hub_docs: DataFrame, registry: DataFrame, root: str, days: int, folder_defaults: dict[str, str] | None = None
) -> None:
    """Flatten the documents of the window and replace their days in every table."""
    writers.backfill(tables_of_window(hub_docs, registry, days, folder_defaults), root)


def summarize_days(
    registry: DataFrame,
    reports: DataFrame,
    start: str,
    end: str | None = None,
    folder_defaults: dict[str, str] | None = None,
    vehicle_folders: list[str] | None = None,
) -> DataFrame:
    """One summary row per site and hub date, from the report each site may use on that date."""
    asked = asked_days(fallback_policy(registry, folder_defaults), start, end)
    return summarize_site(latest_usable_report(asked, summarized_reports(report_facts(reports), documents=True)), vehicle_folders)
