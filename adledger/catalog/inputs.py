"""Operator inputs derived from the given tables.

Each input is one SELECT in the part of SQL that Spark and DuckDB read alike, so a query and its check start
from the same rows. ``@name`` stands for a given table or another input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.session import task_count

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def phone_cell(key: str, seed: str) -> str:
    """SQL for a phone cell in one of sixteen spellings chosen by ``key``."""
    d7 = f"lpad(CAST(({seed}) * 7919 % 10000000 AS STRING), 7, '0')"
    return f"""CASE ({key}) % 16
      WHEN 0 THEN concat('5', {d7})
      WHEN 1 THEN concat('9656', {d7})
      WHEN 2 THEN concat('009659', {d7})
      WHEN 3 THEN concat('96502', {d7})
      WHEN 4 THEN concat('+965 4', substr({d7}, 1, 3), '-', substr({d7}, 4, 4))
      WHEN 5 THEN {d7}
      WHEN 6 THEN concat('1234567', {d7})
      WHEN 7 THEN concat('447', {d7})
      WHEN 8 THEN concat('[''9655', {d7}, ''']')
      WHEN 10 THEN concat('3', {d7})
      WHEN 11 THEN concat('99', {d7})
      WHEN 12 THEN 'nan'
      WHEN 13 THEN concat('["12345", "9656', {d7}, '"]')
      WHEN 14 THEN concat('(965) 9', {d7})
      WHEN 15 THEN ' '
      END"""


INPUTS: dict[str, str] = {}

INPUTS["sheet_wide"] = f"""
SELECT event_type AS scraper,
  concat('data/', event_type, '/year=2024/month=', substr(CAST(ts AS STRING), 6, 2), '/day=', substr(CAST(ts AS STRING), 9, 2),
         '/excel-files/', event_type, CASE WHEN user_id % 2 = 0 THEN '-even' ELSE '_odd' END, '.xlsx') AS file_key,
  CASE user_id % 5 WHEN 0 THEN 'Main' WHEN 1 THEN 'Cars and Trucks with a very long name' WHEN 2 THEN 'Info'
       WHEN 3 THEN 'Sheet1' ELSE ' No Data ' END AS sheet,
  CAST(user_id % 5 AS INT) AS sheet_pos,
  event_id AS row_no,
  substr(CAST(ts AS STRING), 1, 10) AS day,
  CASE event_type WHEN 'click' THEN 'ID' WHEN 'error' THEN 'Listing ID' WHEN 'purchase' THEN 'ad_id'
       WHEN 'view' THEN 'User-Adv-ID' END AS id_col,
  CASE WHEN event_id % 37 = 0 THEN NULL
       WHEN event_id % 41 = 0 THEN 'abc'
       WHEN event_id % 43 = 0 THEN '12'
       WHEN event_id % 47 = 0 THEN concat('cars-', CAST(event_id + 100000 AS STRING), '-7')
       WHEN event_id % 53 = 0 THEN concat('00', CAST(event_id + 100000 AS STRING))
       WHEN event_id % 59 = 0 THEN ' nan '
       WHEN event_id % 61 = 0 THEN concat(CAST(event_id + 100000 AS STRING), '.0')
       ELSE CAST(event_id - event_id % 3 + 100000 AS STRING) END AS id_val,
  CASE event_type WHEN 'click' THEN 'Phone' WHEN 'error' THEN 'Phone Number' WHEN 'purchase' THEN 'contact_no'
       WHEN 'signup' THEN 'user-phone' END AS phone_col,
  {phone_cell('event_id', 'user_id + event_id % 50')} AS phone_val,
  CASE event_type WHEN 'click' THEN 'WhatsApp Phone' WHEN 'purchase' THEN 'Contacts' END AS phone2_col,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE {phone_cell('event_id + 5', 'user_id')} END AS phone2_val,
  CASE event_type WHEN 'click' THEN 'is_hide_my_number' WHEN 'signup' THEN 'Hide My Number' END AS hide_col,
  CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN ' Yes ' WHEN 2 THEN 'no' WHEN 3 THEN '0' END AS hide_val,
  CASE WHEN event_type <> 'error' THEN 'Title' END AS title_col,
  CASE WHEN event_id % 13 <> 0 THEN concat('item ', CAST(user_id AS STRING)) END AS title_val,
  CASE WHEN event_type <> 'view' THEN 'Price' END AS price_col,
  CASE WHEN event_id % 7 <> 0 THEN CAST(user_id * 10 AS STRING) END AS price_val,
  CASE event_type WHEN 'purchase' THEN 'Date Published' WHEN 'signup' THEN NULL ELSE 'date_published' END AS date_col,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'yesterday'
       WHEN event_id % 19 = 0 THEN substr(CAST(ts AS STRING), 1, 10)
       ELSE substr(CAST(ts AS STRING), 1, 19) END AS date_val,
  CASE WHEN event_type = 'error' THEN 'Slug' END AS slug_col
FROM @events
"""

INPUTS["sheets_flat"] = """
SELECT scraper, file_key, sheet, sheet_pos, min(day) AS day, count(*) AS row_count,
  max(id_col) AS id_col, max(phone_col) AS phone_col, max(phone2_col) AS phone2_col, max(hide_col) AS hide_col,
  max(title_col) AS title_col, max(price_col) AS price_col, max(date_col) AS date_col, max(slug_col) AS slug_col
FROM @sheet_wide GROUP BY scraper, file_key, sheet, sheet_pos
"""

INPUTS["files_flat"] = """
SELECT scraper, file_key, min(day) AS day, sum(row_count) * 331 AS size_bytes,
  min(day) NOT LIKE '%-13' AS readable
FROM @sheets_flat GROUP BY scraper, file_key
"""

INPUTS["scrapers_flat"] = """
SELECT DISTINCT event_type AS scraper, event_type = 'absent-ok' AS files_optional FROM @events
UNION ALL
SELECT concat('absent-', CASE WHEN r_regionkey % 2 = 0 THEN 'ok-' ELSE 'bad-' END, lower(r_name)) AS scraper,
  r_regionkey % 2 = 0 AS files_optional FROM @region
"""

INPUTS["phone_cells"] = f"""
SELECT c_custkey, {phone_cell('c_custkey', 'c_custkey * 31')} AS cell,
  CASE c_custkey % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 't' WHEN 2 THEN 'false' WHEN 3 THEN '' END AS hide_cell
FROM @customer
"""

INPUTS["ad_id_cells"] = """
SELECT o_orderkey,
  CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '12' WHEN 3 THEN concat('000', CAST(o_orderkey AS STRING))
    WHEN 4 THEN concat('cars-', CAST(o_orderkey AS STRING), '-x', CAST(o_custkey AS STRING)) WHEN 5 THEN ' None ' WHEN 6 THEN '000'
    WHEN 7 THEN concat(CAST(o_orderkey + 1000 AS STRING), '.0') WHEN 8 THEN '' ELSE CAST(o_orderkey + 5000 AS STRING) END AS cell
FROM @orders
"""

INPUTS["objects"] = """
SELECT concat(CASE WHEN o_orderkey % 89 = 0 THEN 'wrong/' ELSE '' END, 'data/cat', CAST(o_custkey % 7 AS STRING),
    CASE WHEN o_custkey % 14 = 3 THEN '/sub' ELSE '' END,
    CASE WHEN o_orderkey % 23 = 0 THEN concat('/monitor/', substr(CAST(o_orderdate AS STRING), 1, 10), '/')
         ELSE concat('/year=', substr(CAST(o_orderdate AS STRING), 1, 4),
           '/month=', CASE WHEN o_orderkey % 2 = 0 THEN substr(CAST(o_orderdate AS STRING), 6, 2)
                           ELSE CAST(CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) AS STRING) END,
           '/day=', CASE WHEN o_orderkey % 3 = 0 THEN substr(CAST(o_orderdate AS STRING), 9, 2)
                         ELSE CAST(CAST(substr(CAST(o_orderdate AS STRING), 9, 2) AS INT) AS STRING) END, '/') END,
    CASE WHEN o_orderkey % 97 = 0 THEN concat('folder', CAST(o_orderkey AS STRING), '/')
         WHEN o_orderkey % 23 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'report.json' ELSE concat('notes', CAST(o_orderkey AS STRING), '.txt') END
         ELSE concat('file', CAST(o_orderkey AS STRING),
           CASE o_orderkey % 9 WHEN 0 THEN '.jpg' WHEN 1 THEN '.WEBP' WHEN 2 THEN '.json' WHEN 3 THEN '.xlsx' WHEN 4 THEN '.csv'
             WHEN 5 THEN '.parquet' WHEN 6 THEN '' WHEN 7 THEN '.tar.gz' ELSE '.xls' END) END) AS key,
  CAST(o_orderkey % 977 * 1024 + o_custkey AS BIGINT) AS size_bytes
FROM @orders
"""

INPUTS["storage_scrapers"] = """
SELECT concat('cat', CAST(n_nationkey AS STRING)) AS scraper, n_name AS site_id,
  CASE WHEN n_nationkey % 3 = 0 THEN concat('{bucket}/data/cat', CAST(n_nationkey AS STRING), '/')
       WHEN n_nationkey = 10 THEN ' /data/cat3/sub/ '
       ELSE concat('data/cat', CAST(n_nationkey AS STRING)) END AS base_path
FROM @nation
"""


# --- summary documents, one per order, in eight shapes ---------------------------------------------------

_MANY = ", ".join(f'{{"name": "t{i}", "errors": {i % 3 + 1}, "reason": "slow answer of page {i}"}}' for i in range(14))
_K = "CAST(o_orderkey AS STRING)"
_C = "CAST(o_custkey % 40 AS STRING)"

INPUTS["summary_docs"] = f"""
SELECT concat(o_orderpriority, '/', CAST(o_custkey % 30 AS STRING)) AS scraper,
  concat('data/json-files/summary_', {_K}, '.json') AS key, CAST(o_custkey % 2 AS INT) AS prefix_form,
  CASE o_orderkey % 9
  WHEN 0 THEN concat('{{"total_listings": ', {_C}, ', "subcategories": [{{"name_en": "Sedan", "listings_count": ', {_C},
    ', "errors": ["x"]}}, {{"name_en": "", "name": " Van ", "count": 2.9, "error_count": 2}}, 5], "request_metrics": {{"requests_total": ', {_K},
    ', "requests_failed": ', {_C}, ', "duration_sec": 90.5, "requests_per_min": ', {_C}, '}}}}')
  WHEN 1 THEN concat('{{"categories": [{{"name_en": "Cars", "subcategories": [{{"name_en": "SUV", "count": ', {_C},
    '}}, {{"slug": "van", "listings": 4}}, {{"name": " "}}, "text"]}}, {{"slug": "flat", "ads_count": 5, "listings": ', {_C},
    '}}, {{"name_en": "Cars", "brands": [{{"model": "SUV", "total_ads": 1}}]}}]}}')
  WHEN 2 THEN concat('{{"stats": {{"scrape_do_requests": ', {_C}, ', "elapsed_seconds": 12.5, "cache_hits_free": 3}}, "errors": ["timeout", {{"name": "x", "count": ',
    {_C}, ', "message": "bad"}}, {{"scraper": "y"}}, "timeout", 7]}}')
  WHEN 3 THEN concat('{{"total_listings": ', {_K})
  WHEN 4 THEN concat('{{"items": [{{"total_ads": ', {_C}, '}}, {{"listings": 7}}, "text", {{"total_listings": -1, "listings_count": 2}}], "main_categories": [{{"name": " ", "subcategories": ["a", "b"], "listings_count": 9}}, {{"name": "Zed", "subcategories": ["a"], "listings_count": ',
    {_C}, '}}, {{"brands": [{{"brand": "B1"}}]}}], "failed_requests": ', {_C}, '}}')
  WHEN 5 THEN concat('{{"total_ads": ', {_C}, '.7, "failed_items": [{{"name": "n1", "errors": "3", "reason": "r', {_C},
    '"}}, {{"slug": "n2", "error_count": 0}}, {{"errors": "many"}}, {{"category": "c", "errors": [], "detail": ""}}, "skip", {{"name": "neg", "errors": -2}}, {_MANY}], "http_requests": 0}}')
  WHEN 6 THEN concat('[', {_K}, ', 2]')
  WHEN 7 THEN concat('{{"total_listings": "12", "listings_count": null, "requests_total": "5", "request_count": ', {_K},
    ', "http_errors": ', {_C}, ', "runtime_sec": ', {_C}, ', "failed_scrapers": [{{"scraper": "fs", "errors": 0, "message": "m"}}], "errors": []}}')
  ELSE concat('{{"note": "nothing", "listings_count": ', {_C}, ', "request_metrics": {{"requests_failed": ', {_C}, '}}, "requests_total": 100}}') END AS body
FROM @orders
"""

# --- scraper results, one per customer, with hour counts in several shapes -------------------------------

_N = "CAST(c_custkey % 50 AS STRING)"

INPUTS["scraper_result_docs"] = f"""
SELECT c_custkey, CASE c_custkey % 9
  WHEN 0 THEN concat('{{"ads_by_hour": [{{"hour": 3, "ads_count": ', {_N}, '}}, {{"hour": "3", "count": 2}}, {{"hour": 24, "ads_count": 5}}, {{"hour": 7, "ads_count": -4}}], "hourly_ads": [{{"hour": 1, "ads_count": 9}}]}}')
  WHEN 1 THEN concat('{{"ads_by_hour": [], "hourly_ads": [{{"hour": 5, "count": ', {_N}, '}}, {{"hour": "x", "count": 1}}]}}')
  WHEN 2 THEN concat('{{"stats": {{"hourly_ads": [{{"hour": 9, "ads_count": ', {_N}, '}}]}}, "hourly_counts": {{"1": 5}}}}')
  WHEN 3 THEN concat('{{"date_published_hour_counts": {{"0": ', {_N}, ', "23": 4, "24": 6, "x": 1, "5": -3}}}}')
  WHEN 4 THEN concat('{{"date_published_hour_counts": {{}}, "hour_counts": {{"8": "', {_N}, '"}}}}')
  WHEN 5 THEN concat('{{"summary": {{"date_published_hours": {{"11": ', {_N}, '.9}}}}}}')
  WHEN 6 THEN concat('{{"ads_by_hour": [{{"hour": 99, "ads_count": 1}}], "ads_stats": {{"hourly_counts": {{"12": ', {_N}, '}}}}}}')
  WHEN 7 THEN '{{"unique_ads": 4}}'
  ELSE concat('{{"ads_by_hour": "none", "hourly_counts": {{"6": ', {_N}, '}}}}') END AS body
FROM @customer
"""


# --- sites, registry, reports and workflow runs -----------------------------------------------------------

INPUTS["registry_rows"] = """
SELECT n_nationkey AS n, n_nationkey AS seq, 0 AS copy FROM @nation
UNION ALL SELECT n_nationkey, n_nationkey + 1000, 1 FROM @nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT n_nationkey, n_nationkey + 2000, 2 FROM @nation WHERE n_nationkey % 7 = 3
"""

_W = "CAST(n AS STRING)"

INPUTS["registry_flat"] = f"""
SELECT seq, CASE WHEN copy = 2 THEN '' ELSE concat('site-', {_W}) END AS site_id,
  CASE WHEN n % 6 = 5 THEN NULL WHEN copy = 1 THEN concat('other-', {_W}) ELSE concat('folder-', {_W}) END AS folder,
  concat('data/', {_W}) AS r2_prefix, concat('Site ', {_W}) AS display_name, concat('www.site', {_W}, '.example') AS website,
  CASE WHEN n % 3 = 0 THEN 'KW' END AS country, CASE WHEN n % 8 = 7 THEN '' ELSE concat('repo', CAST(copy AS STRING)) END AS repo,
  CASE WHEN n % 9 = 8 THEN NULL ELSE concat('owner', CAST(n % 3 AS STRING)) END AS github_username,
  CASE WHEN n % 4 = 0 THEN 'local' END AS run_place,
  CASE n % 8 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'every 2-days' WHEN 2 THEN 'weekly' WHEN 3 THEN NULL WHEN 4 THEN 'quarterly' WHEN 5 THEN 'daily' WHEN 6 THEN '' ELSE 'hourly' END AS schedule,
  CASE n % 5 WHEN 0 THEN 'Batch A|Batch B -> Batch C' WHEN 1 THEN 'Schema Monitor|Batch B' WHEN 2 THEN 'Monitor Hub daily' END AS workflows,
  CASE n % 4 WHEN 0 THEN 'Old Job' WHEN 1 THEN 'x r2 monitor' WHEN 2 THEN 'Batch A → Batch C, "Batch D"' END AS workflow_name,
  CAST(n % 4 AS INT) AS scrapers, CASE n % 3 WHEN 0 THEN true WHEN 1 THEN false END AS uses_proxy,
  CASE n % 7 WHEN 0 THEN 'latest' WHEN 1 THEN 'false' WHEN 2 THEN 'true' END AS report_fallback,
  CAST(CASE WHEN n % 6 = 0 THEN 3 END AS INT) AS report_lookback_days
FROM @registry_rows
"""

INPUTS["sites_flat"] = """
SELECT CAST(n_nationkey AS INT) AS seq, concat('site-', CAST(n_nationkey AS STRING)) AS site_id, CASE WHEN n_nationkey % 10 <> 9 THEN concat('folder-', CAST(n_nationkey AS STRING)) END AS folder,
  CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'own-user' END AS github_username, CASE n_nationkey % 4 WHEN 0 THEN 'own-repo' WHEN 1 THEN '' END AS repo,
  CASE WHEN n_nationkey % 5 = 0 THEN 'cluster' END AS run_place, CASE n_nationkey % 3 WHEN 0 THEN 'weekly' WHEN 1 THEN '' END AS schedule,
  CASE WHEN n_nationkey % 6 = 0 THEN 'Own Job' END AS workflows, CASE WHEN n_nationkey % 6 = 1 THEN 'Own Name' ELSE '' END AS workflow_name,
  CASE WHEN n_nationkey % 4 = 3 THEN false END AS uses_proxy
FROM @nation
"""

_COUNTS = ["unique_ads", "unique_phones", "valid_phones", "invalid_phones", "outside_country_phones"]
_STORE = ["file_count", "size_bytes"] + [f"{c}_bytes" for c in ("images", "json", "excel", "csv", "parquet", "other")]
_DAILY = ["daily_size"] + [f"daily_{c}_bytes" for c in ("images", "json", "excel", "csv", "parquet", "other")]
SCRAPER_FIELDS = _COUNTS + [f"r2_{c}" for c in _STORE + _DAILY]
_SUMS = ", ".join(f"CAST(sum(o_orderkey % {i + 5}) AS BIGINT) AS {c}" for i, c in enumerate(SCRAPER_FIELDS))

INPUTS["scraper_totals"] = f"""
SELECT concat('site-', CAST(c_nationkey AS STRING)) AS site_id, o_orderpriority AS scraper, count(*) % 3 > 0 AS all_passed, {_SUMS}
FROM @orders JOIN @customer ON o_custkey = c_custkey GROUP BY c_nationkey, o_orderpriority
"""

INPUTS["site_storage"] = """
SELECT concat('site-', CAST(n_nationkey AS STRING)) AS site_id, CAST(n_nationkey * 11 AS BIGINT) AS r2_file_count, CAST(n_nationkey * 1000 AS BIGINT) AS r2_size_bytes,
  CAST(1 AS BIGINT) AS r2_images_bytes, CAST(2 AS BIGINT) AS r2_json_bytes, CAST(3 AS BIGINT) AS r2_excel_bytes, CAST(4 AS BIGINT) AS r2_csv_bytes,
  CAST(5 AS BIGINT) AS r2_parquet_bytes, CAST(6 AS BIGINT) AS r2_other_bytes
FROM @nation WHERE n_nationkey % 2 = 0
"""

INPUTS["report_days"] = """
SELECT c_nationkey AS n, substr(CAST(o_orderdate AS STRING), 1, 10) AS day, count(*) AS orders, sum(o_custkey % 40) AS ads, sum(o_orderkey % 9) AS bytes,
  CAST(min(o_orderkey) % 8 AS INT) AS shape
FROM @orders JOIN @customer ON o_custkey = c_custkey GROUP BY c_nationkey, substr(CAST(o_orderdate AS STRING), 1, 10)
"""

_A, _B, _O = "CAST(ads AS STRING)", "CAST(bytes AS STRING)", "CAST(orders AS STRING)"

INPUTS["reports"] = f"""
SELECT concat('site-', CAST(n AS STRING)) AS site_id, CAST(day AS DATE) AS report_date, CASE shape
  WHEN 0 THEN concat('{{"run_date": "', day, '", "display_name": " Cars ', CAST(n AS STRING), ' ", "website": "w.example", "total_unique_ads": ', {_A}, ', "total_unique_phones": ', {_B},
    ', "total_valid_phones": 3, "total_r2_files": ', {_O}, ', "total_r2_size_bytes": 4096, "total_r2_images_bytes": 17, "total_r2_daily_json_bytes": 5, "r2_daily_size": 0, "alert_count": 2, "inspect_date": "2000-01-01", "requests_total": ',
    {_A}, ', "requests_failed": ', {_O}, ', "scrapers": {{"one": {{"all_passed": true, "unique_ads": 3}}, "two": {{"all_passed": ', CASE WHEN orders % 2 = 0 THEN 'true' ELSE 'false' END, ', "files_found": 1}}}}}}')
  WHEN 1 THEN '{{"total_unique_ads": 0, "scrapers": {{}}, "alerts": []}}'
  WHEN 2 THEN concat('{{"scrapers": [{{"scraper": "a", "all_passed": true, "unique_ads": ', {_A}, ', "unique_phones": 2, "valid_phones": 1, "r2_file_count": 8, "r2_csv_bytes": 9, "requests_total": 50, "requests_failed": ',
    {_O}, ', "requests_per_min": 12.25}}, {{"unique_ads": "7", "all_passed": true, "requests_total": "20", "requests_per_min": 10}}, {{"unique_ads": null, "all_passed": ', CASE WHEN ads % 3 = 0 THEN 'true' ELSE 'null' END, '}}], "alerts": [{{"x": 1}}, {{}}, {{}}]}}')
  WHEN 3 THEN concat('{{"total_unique_ads": ', {_A})
  WHEN 4 THEN concat('{{"total_ads": "', {_A}, '", "request_metrics": {{"requests_total": ', {_A}, '.6, "error_rate_pct": "1.5"}}, "overall_pass": true}}')
  WHEN 5 THEN concat('{{"categories": [{{"total_ads": ', {_A}, '}}, {{"total_ads": null}}, 4, {{"total_ads": "6"}}], "error_summary": {{"http": {{"requests_total": ', {_O}, ', "requests_per_min": 3.5}}}}, "overall_pass": false}}')
  WHEN 6 THEN concat('{{"total_unique_ads": 0, "r2_daily_size": ', {_B}, ', "scrapers": [], "requests_failed": 3}}')
  ELSE '{{"total_unique_ads": null, "total_ads": null, "scrapers": [{{"all_passed": true, "files_found": 0, "unique_ads": 0}}], "alerts": null}}' END AS body
FROM @report_days
"""

INPUTS["runs"] = """
SELECT concat('owner', CAST(o_custkey % 3 AS STRING)) AS owner, 'repo0' AS repo,
  CASE o_orderkey % 5 WHEN 0 THEN 'Batch A' WHEN 1 THEN 'Batch B' WHEN 2 THEN 'Batch C' WHEN 3 THEN 'Batch D' ELSE 'Schema Monitor' END AS name,
  o_orderkey AS run_id, CAST(o_orderkey % 1000 AS INT) AS run_number, CASE WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE 'completed' END AS status,
  CASE o_orderkey % 7 WHEN 0 THEN 'failure' WHEN 1 THEN 'skipped' WHEN 2 THEN 'cancelled' WHEN 3 THEN NULL ELSE 'success' END AS conclusion,
  CAST(o_orderkey % 600 AS INT) AS duration_sec, o_orderdate AS run_started_at
FROM @orders
"""


# --- merged hub documents, one per order day -----------------------------------------------------------------

INPUTS["hub_days"] = """
SELECT substr(CAST(o_orderdate AS STRING), 1, 10) AS day, count(*) AS orders, sum(o_custkey % 40) AS ads, sum(o_orderkey % 9) AS bytes, CAST(min(o_custkey) % 6 AS INT) AS shape
FROM @orders GROUP BY substr(CAST(o_orderdate AS STRING), 1, 10)
"""

_S = "CAST(shape AS STRING)"
_REPORT_A = f"""concat('{{"run_place": "', CASE WHEN shape = 1 THEN 'edge' ELSE 'github' END, '", "uses_proxy": ', CASE WHEN shape = 2 THEN 'true' ELSE 'null' END,
  ', "requests_total": ', {_A}, ', "requests_failed": ', {_O}, ', "requests_per_min": 4.5, "github_run": {{"workflow_name": "',
  CASE shape WHEN 0 THEN 'Batch Z' WHEN 1 THEN 'Schema Monitor' WHEN 2 THEN ' ' WHEN 3 THEN 'N/A' ELSE 'R2 CSV Monitor' END, '", "workflow_run_id": ', {_B}, ', "workflow_run_number": ', {_O},
  CASE WHEN shape = 0 THEN ', "workflow_status": "success"' ELSE '' END, ', "duration_sec": 77, "workflows": [',
  CASE WHEN shape IN (0, 2, 3) THEN concat('{{"name": "Batch A", "conclusion": "success", "duration_sec": ', {_O}, '}}, {{"name": "Schema Monitor", "conclusion": null, "duration_sec": 900}}, {{"name": "Batch B", "conclusion": "',
    CASE WHEN shape = 2 THEN 'failure' ELSE 'cancelled' END, '", "run_started_at": "2001-01-01T10:00:00Z", "updated_at": "2001-01-01T10:02:30Z"}}') ELSE '' END,
  ']}}, "scrapers": {{"alpha": {{"scraper": "', CASE WHEN shape = 3 THEN 'alpha-own' ELSE '' END, '", "all_passed": true, "files_found": 2, "checks_passed": ', {_O}, ', "checks_total": 9, "unique_ads": ', {_A},
  ', "unique_phones": "5", "total_rows": 3.9, "ads_source": "excel_ids", "r2_size_bytes": ', {_B}, ', "r2_daily_images_bytes": 3, "error_rate_pct": 1.25, "duration_sec": "60.5", "metrics_source": "none", "date_published_hour_counts": {{"4": ', {_O},
  ', "25": 1, "17": ', {_B}, '}}, "subcategory_breakdown": [{{"subcategory": " Cars ", "level_3": "SUV", "ads_count": ', {_A}, ', "sheets_count": 2}}, {{"subcategory": "", "ads_count": 4}}, {{"subcategory": "Bikes", "listings_count": "7", "sheet_rows": 3, "source": "own"}}, {{"subcategory": "None"}}, 5]}}, "beta": {{"files_optional": true, "ads_by_hour": [{{"hour": "9", "count": ',
  {_O}, '}}], "file_results": [{{"file_key": "a/b/toyota_land-cruiser.xlsx", "sheets": [{{"name": "Main", "row_count": ', {_O}, '}}, {{"name": " Info ", "row_count": 3}}, {{"name": "Hilux 2020", "row_count": "4"}}, {{"name": "hilux", "row_count": -2}}, {{"name": ""}}]}}, {{"file": "x/o''neil_cars.v2.xlsx", "sheets": [{{"name": "Data", "row_count": 2}}, {{"name": "Data", "row_count": 5}}]}}, {{"sheets": [{{"name": "a > b", "row_count": 1}}, {{"name": "a::b", "row_count": 2}}, {{"name": "a - b - c"}}, {{"name": "solo", "row_count": 8}}]}}]}}}}, "alerts": [{{"scraper": "alpha", "severity": "high", "type": "validation", "check": "rows", "detail": "few", "file": "f.xlsx", "solved": true}}, {{"severity": "critical", "type": "no_files", "check": "files_found", "detail": "none ', {_O}, '"}}]}}')"""
_REPORT_B = f"""concat('{{"request_metrics": {{"requests_total": ', {_A}, '}}, "workflow_name": "Report Job", "scrapers": [{{"scraper": "listed", "all_passed": false, "unique_ads": 3, "requests_total": 7}}, {{"all_passed": true, "stats": {{"hour_counts": {{"8": 2}}}}}}, {{"scraper": "third"}}], "github_run": {{"workflows": [{{"name": "Run X", "conclusion": "timed_out"}}, {{"name": "x r2 monitor"}}]}}}}')"""
_SITE_NUMBERS = f"""', "scrapers_total": 2, "scrapers_passed": 1, "alert_count": ', {_O}, ', "unique_ads": ', {_A}, ', "r2_size_bytes": ', {_B}, ', "r2_json_bytes": 12, "run_date": "', day, '", "inspect_date": null, "status": "',
    CASE shape WHEN 0 THEN 'ok' WHEN 1 THEN 'failed' ELSE 'missing' END, '"'"""

INPUTS["hub_docs"] = f"""
SELECT day, concat('{{"run_date": "', day, '", "inspect_date": "', day, '", "generated_at": "', day, 'T05:06:07Z", "sites_total": 4, "sites_ok": ', {_S}, ', "total_alerts": "', {_O}, '", "total_unique_ads": ', {_A},
  ', "total_r2_size_bytes": ', {_B}, ', "total_r2_daily_csv_bytes": 99, "hub_prefix": "hub", "sites": [',
  '{{"site_id": "site-', {_S}, '", "folder": "folder-', {_S}, '", "display_name": "S", "website": "w", "repo": "", "report_fallback": ', CASE WHEN shape = 1 THEN 'true' ELSE 'null' END, {_SITE_NUMBERS}, ', "report": ', {_REPORT_A}, '}}, ',
  '{{"site_id": "", "folder": "folder-11", "country": "KW", "uses_proxy": false', {_SITE_NUMBERS}, ', "report": ', {_REPORT_B}, '}}, ',
  '{{"site_id": "unknown", "folder": null', {_SITE_NUMBERS}, '}}, {{"site_id": null, "folder": "", "status": "ok"}}]}}') AS body
FROM @hub_days
"""


# --- pages with an embedded document ---------------------------------------------------------------------------

_P = "CAST(p_partkey AS STRING)"
_SZ = "CAST(p_size AS STRING)"


def page_html(key: str, document: str, rest: str = "''") -> str:
    """SQL for a page around a document: one in ten has no script, one in ten a cut-off document."""
    return f"""concat('<!DOCTYPE html><html><head><script>var a=1;</script>', CASE {key} % 10 WHEN 9 THEN '' ELSE concat('<script id="__NEXT_DATA__" type="application/json">',
      CASE {key} % 10 WHEN 8 THEN substr({document}, 1, length({document}) - 3) ELSE {document} END, '</script>') END, '</head><body>', {rest}, '</body></html>')"""


def _node(n: str, name: str, kind: str, extra: str = "") -> str:
    """SQL text of one category node."""
    return f"""'{{"id": {n}', {_P}, ', "slug": "{name}-', {_P}, '", "name_ar": "{name} ar", "name_en": "{name} ', {_SZ}, '", "listings_count": ', {_SZ}, ', "slug_url": "{name}/', {_P}, '", "category_type": "{kind}"{extra}}}'"""


_CATEGORY_DOC = f"""concat('{{"props": {{"pageProps": {{', CASE p_partkey % 4 WHEN 0 THEN concat('"totalPages": ', {_SZ}, ', ') WHEN 1 THEN '"totalPages": 0, ' WHEN 2 THEN '"totalPages": null, ' ELSE '' END,
  '"verticalSubcats": [', {_node('1', 'cars', 'listings_district_filteration')}, ', ', {_node('2', 'vans', 'listings')}, '], "catChilds": [', CASE WHEN p_partkey % 3 = 0 THEN concat({_node('3', 'suv', 'x', ', "category_parent_slug": "cars"')}) ELSE '' END,
  '], "subcategories": [', CASE WHEN p_partkey % 2 = 0 THEN concat({_node('4', 'parts', 'y')}) ELSE '' END, '], "categories": [{{"id": 1, "name": "All", "slug": "all"}}, {{"id": 2, "name": "Kind", "slug": "', lower(p_type), '"',
  CASE WHEN p_partkey % 3 = 1 THEN concat(', "total_pages": ', {_SZ}) ELSE '' END, '}}], "brands": [{{"name_en": "', p_brand, '", "name_ar": "b", "slug_url": "brand/', {_P}, '", "listings_count": ', {_SZ}, ', "types": [{{"name_en": "T1", "name_ar": "t", "slug_url": "t1", "listings_count": ', {_SZ},
  '}}, {{"name_en": "T2"}}]}}, {{"name_en": "Solo', {_SZ}, '"}}], "districts": [{{"id": ', {_P}, ', "name_ar": "d", "name_en": "East", "full_path_ar": "p", "full_path_en": "City East Block ', {_SZ}, '"}}], "category": {{"category_type": "',
  CASE p_partkey % 5 WHEN 0 THEN 'listings_full_filtration' WHEN 1 THEN 'listings_district_filteration' ELSE 'listings' END, '"}}, "businessesData": {{"data": [', CASE WHEN p_partkey % 5 < 2 THEN concat('{{"id": ', {_P}, ', "slug": "biz-', {_P}, '", "name": "Biz", "logo": "l.png"}}') ELSE '' END,
  ']}}, "listings": [{{"id": ', {_P}, ', "title": "', p_name, '", "slug": "s-', {_P}, '", "price": ', {_SZ}, ', "image": "i.jpg", "date_published": "2024-01-05 10:00:00", "cat_id": 5, "user": {{"user_id": ', {_SZ}, ', "name": "U"}}, "phone": "96551234567", "status": "normal", "images_count": 3}}, {{"adBoxId": 7, "id": 1}}, {{"adBoxId": 0, "id": "z', {_P}, '", "district_name": "D"}}]}}}}}}')"""

_LINKS = """concat('<a class="link pageLink_x" href="/c?page=', CAST(p_size % 17 AS STRING), '&s=1">x</a><a class="other" href="/c?page=99">y</a>', CASE WHEN p_partkey % 2 = 0 THEN '<a class="pageLink" data-a="1" href="/c?q=2&page=12">z</a>' ELSE '' END)"""

INPUTS["category_pages"] = f"""
SELECT p_partkey AS page_id, concat('https://site.example/', lower(p_type), '/', {_P}) AS url, lower(p_type) AS slug, {page_html('p_partkey', _CATEGORY_DOC, f"CASE WHEN p_partkey % 6 = 0 THEN '' ELSE {_LINKS} END")} AS html
FROM @part
"""

_E = "CAST(event_id AS STRING)"
_U = "CAST(user_id AS STRING)"
_DETAIL_DOC = f"""concat('{{"props": {{"pageProps": {{"listing": ', CASE WHEN event_id % 11 = 0 THEN '{{}}' ELSE concat('{{"user_adv_id": ', {_E}, ', "slug": "ad-', {_E}, '", "title": "Ad ', {_U}, '", "price": "', {_U}, '", "phone": "965', {_E}, '", "date_published": "', substr(CAST(ts AS STRING), 1, 19),
  '", "date_created": null, "images": [', CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('"https://img.example/', {_E}, '.png", "https://img.example/b.jpg"') END, '], "district": {{"name": "N', {_U}, '", "full_path": "FP", "full_path_en": "FPE"}}, "user_view_count": ', {_U}, ', "lon": 47.5, "lat": "29.25", "user": {{"first_name": "F', {_U},
  '"', CASE WHEN event_id % 2 = 0 THEN concat(', "listings_count": ', {_U}, ', "member_since": "2019-03-04T05:06:07", "is_verified": true') ELSE '' END, '}}, "is_private_message_enabled": ', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'null' END, ', "is_hide_my_number": false, "attrsAndVals": [{{"attrData": {{"name_en": "Color", "name_ar": "c", "type": "list"}}, "valData": {{"name_en": "Red', {_U},
  '", "name_ar": "r"}}}}, {{"attrData": {{"name_en": "Year", "name_ar": "y", "type": "number"}}, "valData": "20', {_U}, '"}}, {{"attrData": {{"name_en": "Used", "type": "flag"}}, "valData": "', CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END, '"}}, {{"attrData": {{"name_en": "Skip"}}, "valData": 5}}]}}') END,
  ', "service": {{', CASE WHEN event_id % 2 = 0 THEN concat('"id": ', {_E}, ', "phone": "1', {_U}, '", "user": {{"name": "", "first_name": "First', {_U}, '", "id": ', {_U}, ', "email": "e"}}, "district": {{"name": "Dn"}}') ELSE concat('"user_adv_id": ', {_E}, ', "phone": "", "contact": "2', {_U}, '", "user": {{"name": "Nm", "user_id": ', {_U}, '}}, "district_name_localize": {{"en": "Loc', {_U}, '"}}') END,
  ', "title": "T", "desc_en": "De', {_U}, '", "price": ', {_U}, ', "images": [', CASE WHEN event_id % 3 = 0 THEN '"a.jpg", "b.jpg"' ELSE '' END, '], "category": {{"name": "Cat"}}, "contacts": ["c1", "', {_U}, '"], "lat": 1.5, "is_private_message_enabled": true, "status": "s"}}, "businessListings": {{"data": {{"listings": {{"normal_items": [{{"id": ', {_E}, ', "title": "Bt", "cat_en_name": "Ce", "cat_ar_name": "Ca", "price": ', {_U}, ', "images_count": 4, "user_type": "u"}}, {{"id": 2, "images_count": null}}]}}}}}}, "commercialAds": [{{"id": ', {_E}, ', "title": "Cm', {_U}, '", "category": {{"id": 3, "slug": "cs"}}, "is_landing": true, "views_count": ', {_U}, '}}, {{"id": 5, "phone": "p"}}], "adDetails": ',
  CASE WHEN event_id % 4 = 0 THEN 'null' ELSE concat('{{"id": ', {_E}, ', "title": "Dt", "whatsapp_phone": "w', {_U}, '", "is_landing": false}}') END, '}}}}}}')"""

INPUTS["detail_pages"] = f"""
SELECT event_id AS page_id, concat('https://site.example/listing/', {_E}) AS url, {page_html('event_id', _DETAIL_DOC)} AS html
FROM @events
"""

_CK = "CAST(c_custkey AS STRING)"
_DIRECTORY_DOC = f"""concat('{{"props": {{"pageProps": {{', CASE c_custkey % 4 WHEN 0 THEN concat('"businesses": [{{"name": "Bn', {_CK}, '", "slug": "bs-', {_CK}, '", "priceRange": "$", "logo": "l.png"}}, {{"slug": "two", "price_range": "$$", "image": "i.png"}}], ') WHEN 1 THEN concat('"businesses": [], "items": [{{"name": "It', {_CK}, '"}}], ') ELSE '' END,
  '"business": ', CASE WHEN c_custkey % 7 = 0 THEN '{{}}' ELSE concat('{{"id": ', {_CK}, ', "name": "', c_name, '", "slug": "b-', {_CK}, '", "category": {{"name": "Food"}}, "logo": "https://x.example/l.png", "cover_image": "', CASE WHEN c_custkey % 2 = 0 THEN 'media' ELSE 'https://LH3.googleusercontent.com/c' END, '", "rating": {{"average": 4.25, "count": ', {_CK},
  '}}, "contact_info": {{"contact_numbers": ["1", "', {_CK}, '"], "website": "w"}}, "social_media": [{{"url": "https://s.example/', {_CK}, '"}}, {{"url": ""}}, {{"x": 1}}, {{"url": "u2"}}], "working_hours": [{{"day_name": "Sun", "open_time": "09:00", "close_time": "17:00"}}, {{"day_name": "Mon", "open_time": "", "close_time": "1"}}, {{"day_name": "Tue", "open_time": "10:00", "close_time": "',
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '20:00' END, '"}}], "attributes": {{"delivery": true, "wi_fi": ', CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'null' END, '}}, "tabs": [{{"slug": "about", "enabled": true}}, {{"slug": "media", "enabled": ', CASE WHEN c_custkey % 3 = 1 THEN 'false' ELSE 'true' END, '}}]}}') END,
  ', "tabs": {{"about": {{"data": {{"branches": [', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('{{"name": "B1", "address": "A1", "phone": "p1", "latitude": 29.5, "is_main": false}}, {{"name": "B2", "address": "A', {_CK}, '", "longitude": 48.0, "is_main": ', CASE WHEN c_custkey % 4 = 1 THEN 'true' ELSE 'false' END, '}}') END,
  ']}}}}, "reviews": {{"summary": {{"total_reviews": ', CAST(c_custkey % 9 AS STRING), ', "average_rating": 3.5}}, "data": {{"reviews": [', CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('{{"rating": 5, "comment": "c', {_CK}, '"}}, {{"rating": 4}}, {{"rating": 3}}, {{"rating": 2}}, {{"rating": 1}}, {{"rating": 0}}') END,
  ']}}}}, "media": {{"data": {{"media": [{{"url": "https://m.example/', {_CK}, '.PNG", "media_category": "gallery"}}, {{"url": "http://m.example/menu.jpeg?x=1", "media_category": "menu"}}, {{"url": "ftp://no", "media_category": "menu"}}, {{"url": "https://a.example/gps-proxy/1", "media_category": "gallery"}}, {{"url": "https://m.example/plain"}}]}}}}}}}}}}}}')"""
_JSONLD = f"""concat('<script type="application/ld+json">{{"@type": "WebSite", "name": "W"}}</script><script type="application/ld+json">', CASE c_custkey % 5 WHEN 0 THEN '{{"@type": "CollectionPage", broken' ELSE concat('{{"@type": "CollectionPage", "name": "Coll', {_CK},
  '", "mainEntity": {{"@type": "ItemList", "itemListElement": [{{"position": 1, "item": {{"name": "J', {_CK}, '", "url": "https://d.example/food/j-', {_CK}, '/", "priceRange": "$", "image": "s.png"}}}}, {{"position": 2, "item": {{}}}}, {{"position": 3, "item": {{"name": "K", "image": {{"url": "o.png"}}}}}}]}}}}') END, '</script>')"""

INPUTS["directory_pages"] = f"""
SELECT c_custkey AS page_id, concat('https://d.example/', lower(c_mktsegment), '/', {_CK}) AS url, lower(c_mktsegment) AS category_slug,
  {page_html('c_custkey', _DIRECTORY_DOC, f"CASE WHEN c_custkey % 6 = 5 THEN '' ELSE {_JSONLD} END")} AS html
FROM @customer
"""


# --- listing cards, attributes and images ------------------------------------------------------------------------

INPUTS["cards"] = """
SELECT concat(o_orderpriority, '/', CAST(o_custkey % 300 AS STRING)) AS category, CAST(1 + o_orderkey % 6 AS INT) AS page, o_orderkey AS id,
  CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('ad-', CAST(o_orderkey AS STRING)) END AS slug,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 4 THEN '2024-01-14 23:59:00' WHEN 5 THEN '2024-01-16 00:00:01' ELSE concat('2024-01-15 0', CAST(o_orderkey % 7 AS STRING), ':30:00') END AS date_published,
  CASE o_orderstatus WHEN 'F' THEN 'pinned' ELSE 'normal' END AS status, CASE o_orderstatus WHEN 'O' THEN 'Pinned' WHEN 'P' THEN '' END AS pin
FROM @orders
"""

INPUTS["card_details"] = """
SELECT concat('ad-', CAST(o_orderkey AS STRING)) AS slug, concat('title ', CAST(o_custkey AS STRING)) AS title, 'detail' AS status FROM @orders WHERE o_orderstatus <> 'P'
"""

_ATTRIBUTES = [
    ("'Brand'", "'علامة'", "'list'", "'object'", "CAST(NULL AS STRING)", "p_brand", "CASE WHEN p_size % 2 = 0 THEN concat('ar ', p_brand) ELSE '' END"),
    ("'Size'", "'حجم'", "'number'", "'string'", "CAST(p_size AS STRING)", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)"),
    ("'New'", "CAST(NULL AS STRING)", "'flag'", "'string'", "CAST(p_size % 2 AS STRING)", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)"),
    ("'Skipped'", "'x'", "'flag'", "'other'", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)"),
    ("CASE WHEN p_size % 3 = 0 THEN 'Size' ELSE '' END", "'نوع'", "CAST(NULL AS STRING)", "'object'", "CAST(NULL AS STRING)", "p_type", "p_name"),
    ("'Empty'", "'فارغ'", "'list'", "'object'", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "''"),
]
ATTRIBUTE_FIELDS = ["name_en", "name_ar", "type", "val_kind", "val", "val_en", "val_ar"]
_ATTR_SQL = ", ".join(f"{v} AS a{i}_{f}" for i, row in enumerate(_ATTRIBUTES) for f, v in zip(ATTRIBUTE_FIELDS, row))
ATTRIBUTE_COUNT = len(_ATTRIBUTES)

INPUTS["attribute_cells"] = f"SELECT p_partkey AS id, p_size, {_ATTR_SQL} FROM @part"

INPUTS["image_rows"] = """
SELECT l_orderkey AS id, CAST(l_linenumber AS INT) AS image_index, concat('https://img.example/', CAST(l_partkey AS STRING), CASE WHEN l_suppkey % 2 = 0 THEN '.jpg' ELSE '.png' END) AS url,
  l_returnflag AS category, CAST(l_shipdate AS DATE) AS save_date
FROM @lineitem
"""

INPUTS["listing_rows"] = """
SELECT event_type AS category, CASE WHEN event_type = 'view' THEN 'Main' ELSE concat('child ', CAST(user_id % 9 AS STRING)) END AS child, event_id AS id,
  CAST(1 + event_id % 12 AS INT) AS page, CAST(ts AS DATE) AS save_date, event_type <> 'error' AND event_id % 3 > 0 AS has_detail, event_type = 'error' AS is_error
FROM @events
"""

INPUTS["request_log"] = """
SELECT event_id AS request_id, concat('run-', substr(CAST(ts AS STRING), 1, 10)) AS run_id, concat('/page/', props) AS url, ts, event_type = 'error' AS failed, user_id * 4 AS session_count FROM @events
"""


def _needed(sql: str) -> list[str]:
    """Inputs a statement reads, directly or not, in the order they must be defined."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"@(\w+)", text):
            if name in INPUTS and name not in order:
                visit(INPUTS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def _resolve(sql: str, table) -> str:
    def name_of(match: re.Match) -> str:
        name = match.group(1)
        if name in INPUTS:
            return name
        return table(name) if name in TABLES else match.group(0)

    return re.sub(r"@(\w+)", name_of, sql)


#: Inputs that make far more of a row than is stored: a whole page, or dozens of cells.
WIDE = ["directory_pages", "attribute_cells", "category_pages", "detail_pages"]


def _with_inputs(sql: str, table, wide_table=None) -> str:
    ctes = [f"{name} AS ({_resolve(INPUTS[name], wide_table if wide_table and name in WIDE else table).strip()})" for name in _needed(sql)]
    body = _resolve(sql, table).strip()
    if not ctes:
        return body
    own = re.match(r"(?is)with\s+(recursive\s+)?(.*)$", body)
    head = ",\n".join(ctes)
    return f"WITH {head},\n{own.group(2)}" if own else f"WITH {head}\n{body}"


def oracle(sql: str) -> str:
    """A check statement complete with its inputs, over the tables' own names."""
    return _with_inputs(sql, lambda name: name)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or an input derived from the given tables.

    What wide inputs are made of is a few row groups, often one, and a task reads at least one. So its rows are dealt out
    evenly while they are small, before pages and cells are made of them.
    """
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stored = lambda t: f"parquet.`{sf_dir}/{t}.parquet`"
    dealt = lambda t: f"(SELECT /*+ REPARTITION({task_count(spark)}) */ * FROM {stored(t)})"
    return spark.sql(_with_inputs(f"SELECT * FROM @{name}", stored, dealt))


# --- inputs with nested columns, built from the flat ones ---------------------------------------------

CELL_COLUMNS = ["id", "phone", "phone2", "hide", "title", "price", "date"]


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = source(spark, sf_dir, "sheet_wide")
    entries = [F.struct(F.col(f"{c}_col").alias("k"), F.col(f"{c}_val").alias("v")) for c in CELL_COLUMNS]
    entries.append(F.struct(F.col("slug_col").alias("k"), F.lit("s").alias("v")))
    cells = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["k"].isNotNull()))
    return flat.select("scraper", "file_key", "sheet", "sheet_pos", "row_no", cells.alias("cells"), "day")


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat, files = source(spark, sf_dir, "sheets_flat"), source(spark, sf_dir, "files_flat")
    headers = F.filter(F.array(*[F.col(f"{c}_col") for c in [*CELL_COLUMNS, "slug"]]), lambda h: h.isNotNull())
    return flat.withColumn("columns", headers).join(files.select("file_key", "size_bytes", "readable"), "file_key").select(
        "scraper", "file_key", "size_bytes", "readable", "sheet", "sheet_pos", "columns", "row_count", "day"
    )


# --- inspection configuration, one row per scraper found in the data -----------------------------------

INPUTS["event_types"] = "SELECT DISTINCT event_type AS scraper FROM @events"

INPUTS["expected_flat"] = """
SELECT scraper, '{child_category or Main}' AS name,
  CASE scraper WHEN 'click' THEN 'ID|Title|Price|Phone|Link|Views No' WHEN 'error' THEN 'id|link|price|whatsapp phone|Membership'
    WHEN 'signup' THEN 'Title|Listing ID|Description (EN)' ELSE 'Ad Kind|Title|Date Published' END AS required,
  'Ad Kind' AS optional, CAST(3 AS BIGINT) AS row_min, CAST(14 AS BIGINT) AS row_max, CAST(3.5 AS DOUBLE) AS min_file_size_kb
FROM @event_types WHERE scraper <> 'purchase'
UNION ALL
SELECT scraper, 'Info', 'Title|Total Listings', 'Total Listings', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(3.5 AS DOUBLE) FROM @event_types
UNION ALL
SELECT scraper, 'Listings', 'ID|Title|Price|Grade', 'Grade', CAST(0 AS BIGINT), CAST(12 AS BIGINT), CAST(3.5 AS DOUBLE)
FROM @event_types WHERE scraper IN ('purchase', 'view')
"""

INPUTS["profiles_flat"] = """
SELECT scraper, scraper = 'view' AS skip_info_sheet, CASE scraper WHEN 'purchase' THEN 'Data|Sheet1|Main' END AS data_sheet_aliases,
  CASE scraper WHEN 'purchase' THEN 'ID|Title|Price' WHEN 'signup' THEN 'Title|Phone|User ID' END AS core_columns,
  CASE scraper WHEN 'click' THEN 'Link' WHEN 'signup' THEN 'User ID' END AS optional_columns,
  CAST(CASE scraper WHEN 'click' THEN 7.5 END AS DOUBLE) AS min_file_size_kb, scraper = 'signup' AS skip_sheet_trend_checks
FROM @event_types WHERE scraper <> 'error'
"""

INPUTS["floors_flat"] = """
SELECT scraper, CAST(CASE scraper WHEN 'click' THEN 8.0 ELSE 5.25 END AS DOUBLE) AS floor_kb FROM @event_types WHERE scraper <> 'view'
"""


def _lists(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.withColumn(name, F.split(name, r"\|"))
    return df


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = source(spark, sf_dir, "expected_flat")
    flat = flat.withColumnRenamed("required", "required_columns").withColumnRenamed("optional", "optional_columns")
    return _lists(flat, "required_columns", "optional_columns")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lists(source(spark, sf_dir, "profiles_flat"), "data_sheet_aliases", "core_columns", "optional_columns")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lists(source(spark, sf_dir, "registry_flat"), "workflows")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lists(source(spark, sf_dir, "sites_flat"), "workflows")


def attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = source(spark, sf_dir, "attribute_cells")
    entry = lambda i: F.struct(*[F.col(f"a{i}_{f}").alias(f) for f in ATTRIBUTE_FIELDS])
    return flat.select("id", F.array(*[entry(i) for i in range(ATTRIBUTE_COUNT)]).alias("attrs"))
