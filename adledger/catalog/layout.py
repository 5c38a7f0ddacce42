"""Queries over partition layout and object inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger.catalog.inputs import source
from adledger.catalog.registry import query
from adledger.operators import layout
from adledger.rules import STORAGE_CATEGORIES, STORAGE_TYPES

PARTS = r"^(.*?)/?year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})/"


def part_sql(n: int) -> str:
    return f"regexp_extract(key, '{PARTS}', {n})"


def kind_sql() -> str:
    ext = r"lower(regexp_extract(key, '[^/](\.[^./]+)$', 1))"
    cases = " ".join(
        f"WHEN {ext} IN ({', '.join(repr(e) for e in exts)}) THEN '{name}'" for name, exts in STORAGE_TYPES.items()
    )
    return f"CASE {cases} ELSE 'other' END"


OBJ = f"""WITH o AS (SELECT key, size_bytes, {kind_sql()} AS kind, CASE WHEN regexp_matches(key, '{PARTS}') THEN {part_sql(1)} END AS base,
  CASE WHEN regexp_matches(key, '{PARTS}') THEN TRY_CAST({part_sql(2)} || '-' || lpad({part_sql(3)}, 2, '0') || '-' || lpad({part_sql(4)}, 2, '0') AS DATE) END AS save_date
  FROM @objects)
"""
SUMS = "count(*) AS objects, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS size_bytes, " + ", ".join(
    [f"count(*) FILTER (kind = '{c}') AS {c}_objects" for c in STORAGE_CATEGORIES]
    + [f"CAST(coalesce(sum(size_bytes) FILTER (kind = '{c}'), 0) AS BIGINT) AS {c}_bytes" for c in STORAGE_CATEGORIES]
)
BASE, DAY = "data/cat1", "1998-03-07"


def base_days(spark, sf):
    """Asked (base, date) pairs: each order day with the base of its customer group."""
    orders = source(spark, sf, "orders")
    base = F.concat(F.lit("data/cat"), (F.col("o_custkey") % 9).cast("string"))
    return orders.select(base.alias("base"), F.col("o_orderdate").cast("date").alias("date")).distinct()


ASKED = "SELECT DISTINCT 'data/cat' || CAST(o_custkey % 9 AS VARCHAR) AS base, CAST(o_orderdate AS DATE) AS date FROM orders"


@query("l1_partition_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS save_date FROM orders")
def l1(spark, sf):
    return source(spark, sf, "orders").select("o_orderkey", layout.partition_date("o_orderdate").alias("save_date"))


@query(
    "l2_partition_prefixes",
    f"""WITH a AS ({ASKED}), p AS (SELECT base, date, base || '/year=' || strftime(date, '%Y') || '/month=' AS y,
      [strftime(date, '%m'), CAST(month(date) AS VARCHAR)] AS ms, [strftime(date, '%d'), CAST(day(date) AS VARCHAR)] AS ds FROM a),
    m AS (SELECT base, date, y || unnest(ms) || '/day=' AS y, ds FROM p)
    SELECT DISTINCT base, date, y || unnest(ds) || '/' AS prefix FROM m""",
)
def l2(spark, sf):
    return layout.partition_prefixes(base_days(spark, sf))


@query("l3_objects_in_partition", OBJ + f"SELECT key, size_bytes FROM o WHERE base = '{BASE}' AND save_date = DATE '{DAY}'")
def l3(spark, sf):
    return layout.objects_in_partition(source(spark, sf, "objects"), BASE, DAY).select("key", "size_bytes")


@query(
    "l3_objects_by_partition",
    OBJ + "SELECT base, save_date, count(DISTINCT key) AS objects FROM o WHERE save_date IS NOT NULL GROUP BY 1, 2",
)
def l3_all(spark, sf):
    found = layout.with_partition(source(spark, sf, "objects")).filter(F.col("save_date").isNotNull())
    return found.groupBy("base", "save_date").agg(F.count_distinct("key").alias("objects"))


@query(
    "l4_strip_base_placeholder",
    r"SELECT scraper, trim(regexp_replace(trim(base_path), '^\{[^/]*/', ''), '/') AS prefix FROM @storage_scrapers",
)
def l4(spark, sf):
    return source(spark, sf, "storage_scrapers").select("scraper", layout.strip_base_placeholder("base_path").alias("prefix"))


@query("l5_storage_category", OBJ + "SELECT key, kind AS storage_type FROM o")
def l5(spark, sf):
    return source(spark, sf, "objects").select("key", layout.storage_category("key").alias("storage_type"))


@query(
    "l6_inventory",
    OBJ + "SELECT count(*) AS objects, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS size_bytes FROM o WHERE key LIKE 'data/%' AND key NOT LIKE '%/'",
)
def l6(spark, sf):
    return layout.inventory(source(spark, sf, "objects"), "/data/")


@query("l7_inventory_by_type", OBJ + f"SELECT {SUMS} FROM o WHERE key LIKE 'data/cat3/%' AND key NOT LIKE '%/'")
def l7(spark, sf):
    return layout.inventory_by_type(source(spark, sf, "objects"), "data/cat3")


@query(
    "l8_daily_inventory_by_type",
    OBJ + f"SELECT {SUMS} FROM o WHERE base = '{BASE}' AND save_date = DATE '{DAY}' AND key NOT LIKE '%/'",
)
def l8(spark, sf):
    return layout.daily_inventory_by_type(source(spark, sf, "objects"), BASE, DAY)


TOTAL_COLS = ", ".join(
    ["coalesce(t.objects, 0) AS r2_file_count", "coalesce(t.size_bytes, 0) AS r2_size_bytes"]
    + [f"coalesce(t.{c}_bytes, 0) AS r2_{c}_bytes" for c in STORAGE_CATEGORIES]
    + ["coalesce(d.size_bytes, 0) AS r2_daily_size"]
    + [f"coalesce(d.{c}_bytes, 0) AS r2_daily_{c}_bytes" for c in STORAGE_CATEGORIES]
)


@query(
    "l9_scraper_storage",
    OBJ + f""", s AS (SELECT scraper, site_id, trim(regexp_replace(trim(base_path), '^\\{{[^/]*/', ''), '/') AS prefix FROM @storage_scrapers),
    t AS (SELECT prefix, {SUMS} FROM s JOIN o ON starts_with(key, prefix || '/') AND key NOT LIKE '%/' GROUP BY prefix),
    d AS (SELECT prefix, {SUMS} FROM s JOIN o ON base = prefix AND save_date = DATE '{DAY}' AND key NOT LIKE '%/' GROUP BY prefix)
    SELECT s.scraper, s.site_id, s.prefix, {TOTAL_COLS} FROM s LEFT JOIN t USING (prefix) LEFT JOIN d USING (prefix)""",
)
def l9(spark, sf):
    return layout.scraper_storage(source(spark, sf, "objects"), source(spark, sf, "storage_scrapers"), DAY).drop("base_path")


@query(
    "l10_backfill_window",
    "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - 30",
)
def l10(spark, sf):
    dates = source(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return layout.backfill_window(dates, 30)


@query(
    "l11_backfill_dates",
    "SELECT DISTINCT CAST(o_orderdate AS DATE) - 1 AS scrape_date, CAST(o_orderdate AS DATE) AS save_date FROM orders",
)
def l11(spark, sf):
    return layout.backfill_dates(source(spark, sf, "orders").select(F.col("o_orderdate").alias("target_date")).distinct())


@query(
    "l12_rekey_plan",
    "SELECT key AS from_key, 'data/' || substr(key, 12) AS to_key FROM @objects WHERE starts_with(key, 'wrong/data/')",
)
def l12(spark, sf):
    return layout.rekey_plan(source(spark, sf, "objects"), "wrong/data/", "data/")


@query(
    "l13_partition_stats",
    OBJ + f""", a AS ({ASKED}), g AS (SELECT base, save_date AS date, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS b FROM o GROUP BY 1, 2)
    SELECT a.base, a.date, coalesce(n, 0) AS file_count, coalesce(b, 0) AS total_size_bytes, round(coalesce(b, 0) / 1048576.0::DOUBLE, 2) AS total_size_mb
    FROM a LEFT JOIN g USING (base, date)""",
)
def l13(spark, sf):
    return layout.partition_stats(source(spark, sf, "objects"), base_days(spark, sf))


@query(
    "s8_list_partition_dates",
    r"SELECT DISTINCT regexp_extract(key, '/(\d{4}-\d{2}-\d{2})/[^/]*$', 1) AS date FROM @objects WHERE key LIKE '%/report.json'",
)
def s8(spark, sf):
    return layout.list_partition_dates(source(spark, sf, "objects"), "report.json")
