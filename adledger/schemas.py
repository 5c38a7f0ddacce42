"""Column contracts of the six daily tables and of the operator inputs."""

from __future__ import annotations

from pyspark.sql import types as T

from adledger import rules

_TYPES = [c for c in rules.STORAGE_CATEGORIES]


def _bytes(prefix: str) -> list[str]:
    return [f"{prefix}{c}_bytes BIGINT" for c in _TYPES]


# --- fixed values: tables, column order, types and keys ---------------------------------------------
TABLES: dict[str, list[str]] = {
    "hub_daily": [
        "hub_partition_date DATE", "inspect_date DATE", "generated_at TIMESTAMP", "sites_total INT", "sites_ok INT",
        "sites_failed INT", "sites_missing INT", "total_alerts INT", "total_unique_ads INT", "total_unique_phones INT",
        "total_valid_phones INT", "total_invalid_phones INT", "total_outside_country_phones INT", "total_r2_files INT",
        "total_r2_size_bytes BIGINT", "total_r2_daily_size BIGINT", *_bytes("total_r2_"), *_bytes("total_r2_daily_"),
        "total_requests INT", "total_requests_failed INT", "avg_error_rate_pct DOUBLE", "avg_requests_per_min DOUBLE",
        "hub_prefix STRING",
    ],
    "site_daily": [
        "hub_partition_date DATE", "site_id STRING", "folder STRING", "display_name STRING", "website STRING",
        "country STRING", "repo STRING", "github_username STRING", "run_place STRING", "workflow_name STRING",
        "workflow_run_number INT", "workflow_run_id STRING", "workflow_status STRING", "workflow_duration_sec INT",
        "schedule STRING", "status STRING", "scrapers_total INT", "scrapers_passed INT", "alert_count INT",
        "unique_ads INT", "unique_phones INT", "valid_phones INT", "invalid_phones INT", "outside_country_phones INT",
        "r2_file_count INT", "r2_size_bytes BIGINT", "r2_daily_size BIGINT", *_bytes("r2_"), *_bytes("r2_daily_"),
        "requests_total INT", "requests_failed INT", "error_rate_pct DOUBLE", "requests_per_min DOUBLE",
        "scrapers_failed INT", "run_date DATE", "inspect_date DATE", "report_fallback BOOLEAN", "uses_proxy BOOLEAN",
    ],
    "scraper_daily": [
        "hub_partition_date DATE", "site_id STRING", "scraper STRING", "files_found INT", "checks_passed INT",
        "checks_total INT", "all_passed BOOLEAN", "files_optional BOOLEAN", "unique_ads INT", "unique_phones INT",
        "valid_phones INT", "invalid_phones INT", "outside_country_phones INT", "total_rows INT", "ads_source STRING",
        "r2_file_count INT", "r2_size_bytes BIGINT", "r2_daily_size BIGINT", *_bytes("r2_"), *_bytes("r2_daily_"),
        "requests_total INT", "requests_failed INT", "error_rate_pct DOUBLE", "requests_per_min DOUBLE",
        "duration_sec DOUBLE", "metrics_source STRING", "failed_items_summary STRING",
    ],
    "scraper_hourly_daily": [
        "hub_partition_date DATE", "site_id STRING", "scraper STRING", "hour INT", "ads_count INT",
    ],
    "scraper_subcategory_daily": [
        "hub_partition_date DATE", "site_id STRING", "scraper STRING", "subcategory STRING", "level_3 STRING",
        "ads_count INT", "sheet_rows INT", "sheets_count INT", "source STRING",
    ],
    "alerts": [
        "hub_partition_date DATE", "site_id STRING", "scraper STRING", "severity STRING", "alert_type STRING",
        "check_name STRING", "detail STRING", "file_key STRING", "alert_id STRING", "solved BOOLEAN",
    ],
}
PRIMARY_KEYS: dict[str, list[str]] = {
    "hub_daily": ["hub_partition_date"],
    "site_daily": ["hub_partition_date", "site_id"],
    "scraper_daily": ["hub_partition_date", "site_id", "scraper"],
    "scraper_hourly_daily": ["hub_partition_date", "site_id", "scraper", "hour"],
    "scraper_subcategory_daily": ["hub_partition_date", "site_id", "scraper", "subcategory", "level_3"],
    "alerts": ["alert_id"],
}
DEFAULTS: dict[str, dict[str, object]] = {
    "site_daily": {"report_fallback": False},
    "scraper_daily": {"files_optional": False},
    "scraper_subcategory_daily": {"level_3": ""},
    "alerts": {"solved": False},
}

INPUTS: dict[str, str] = {
    "pages": "page_id BIGINT, url STRING, html STRING",
    "listings": (
        "id STRING, slug STRING, title STRING, description STRING, price STRING, phone STRING, date_published STRING, "
        "date_created STRING, date_expired STRING, date_sort STRING, images ARRAY<STRING>, images_count INT, "
        "address STRING, full_address STRING, full_address_en STRING, views_no BIGINT, longitude DOUBLE, "
        "latitude DOUBLE, user_name STRING, user_email STRING, user_ads STRING, user_image STRING, user_type STRING, "
        "membership STRING, is_verified BOOLEAN, is_private_message_enabled BOOLEAN, is_hide_my_number BOOLEAN, "
        "status STRING, specification_en STRING, specification_ar STRING"
    ),
    "sheets": (
        "scraper STRING, file_key STRING, size_bytes BIGINT, readable BOOLEAN, sheet STRING, sheet_pos INT, "
        "columns ARRAY<STRING>, row_count BIGINT"
    ),
    "sheet_rows": (
        "scraper STRING, file_key STRING, sheet STRING, sheet_pos INT, row_no BIGINT, cells MAP<STRING,STRING>"
    ),
    "baseline": (
        "scraper STRING, size_min DOUBLE, size_max DOUBLE, size_last DOUBLE, observed_dates ARRAY<STRING>"
    ),
    "sheet_baseline": (
        "scraper STRING, sheet STRING, rows_min BIGINT, rows_max BIGINT, rows_last BIGINT, columns ARRAY<STRING>"
    ),
    "registry_site": (
        "site_id STRING, folder STRING, r2_prefix STRING, display_name STRING, website STRING, country STRING, "
        "repo STRING, github_username STRING, run_place STRING, schedule STRING, workflows ARRAY<STRING>, "
        "workflow_name STRING, scrapers INT, uses_proxy BOOLEAN, report_fallback STRING, report_lookback_days INT"
    ),
    "expected_sheet": (
        "name STRING, required_columns ARRAY<STRING>, optional_columns ARRAY<STRING>, row_count_range ARRAY<BIGINT>"
    ),
    "category": "id BIGINT, slug STRING, name_ar STRING, name_en STRING",
}


def table_ddl(table: str) -> str:
    return ", ".join(TABLES[table])


def table_columns(table: str) -> list[str]:
    return [c.split(" ")[0] for c in TABLES[table]]


def table_types(table: str) -> dict[str, str]:
    return dict(c.split(" ") for c in TABLES[table])


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(table_ddl(table))
