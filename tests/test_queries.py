"""Registered queries against their SQL on the smallest given tables, one or two of each family."""

import duckdb
import pytest

import __spark_entry__ as entry
from adledger.catalog.inputs import TABLES
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
NAMES = [
    "v5_row_contact", "v10_file_validation", "v12_invalid_samples", "v14_validation_gate", "v6_phone_sets", "a2_count_ads", "a4_best_summary",
    "l9_scraper_storage", "q6_match_expected_sheets", "q13_file_verdict", "b4_merge_baseline", "b_trend_checks", "m1_request_metrics",
    "h6_latest_usable_report", "h11_overlay_registry", "h18_pipeline_run_meta", "f1_hub_daily", "f6_scraper_subcategory_daily", "x12_extract_directory_list",
    "p2_cut_pages_first_empty", "p11_attributes_to_maps_standard", "g3_category_totals", "s11_baseline", "w3_dedupe_by_key",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    want, names = rows_of([d[0] for d in result.description], result.fetchall())
    assert columns == names
    assert got == want


def test_registry_is_complete():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def test_entry(spark):
    assert entry.entry(spark).count() > 0
