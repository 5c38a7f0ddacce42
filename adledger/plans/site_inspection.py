"""From sheets to verdicts and alerts of one site's run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.operators import alerts, inspection, trends


@dataclass
class Inspection:
    checks: DataFrame
    file_verdicts: DataFrame
    scraper_verdicts: DataFrame
    failures: DataFrame
    alerts: DataFrame


def inspect(
    sheets: DataFrame,
    rows: DataFrame,
    expected: DataFrame,
    profiles: DataFrame,
    scrapers: DataFrame,
    baseline: DataFrame,
    sheet_baseline: DataFrame,
    floors: DataFrame,
    day: str,
) -> Inspection:
    """Schema, floor and trend checks as one table, and what follows from it.

    The check table is small (a few rows per sheet) and read by every result, so callers that write more than
    one of them should write ``checks`` first and read it back.
    """
    files = inspection.files_of(sheets)
    told = (
        inspection.schema_checks(sheets, expected, profiles, unchecked=True)
        .unionByName(inspection.check_size_floor(files.filter("readable"), floors))
        .unionByName(trends.trend_checks(sheets, baseline, sheet_baseline, profiles))
    )
    checks = told.filter(F.col("check_name").isNotNull())
    per_file = inspection.file_verdict(checks)
    per_scraper = inspection.scraper_verdict(inspection.file_verdict(told), scrapers)
    failures = alerts.flatten_failures(checks, inspection.quality_metrics(rows, day))
    return Inspection(checks, per_file, per_scraper, failures, alerts.collect_alerts(per_scraper, failures))
