"""Queries over sheet inspection, baselines, trends and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger.catalog.inputs import expected, profiles, sheet_rows, sheets, source
from adledger.catalog.registry import query
from adledger.functions.text import canonical_column
from adledger.operators import alerts as r
from adledger.operators import inspection as q
from adledger.operators import trends as b
from adledger.rules import HEADER_ALIASES, OPTIONAL_HEADERS

SPLIT_DAY = "2024-01-21"
TEST_DAY = "2024-01-15"


def canon_sql(c: str) -> str:
    bare = f"regexp_replace(lower(trim({c})), '[^a-z0-9]', '', 'g')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HEADER_ALIASES.items())
    return f"(CASE {bare} {cases} ELSE {bare} END)"


def canon_list_sql(c: str) -> str:
    return f"list_transform({c}, lambda h: {canon_sql('h')})"


def list_sql(c: str) -> str:
    return f"coalesce(string_split({c}, '|'), [])"


OPTIONAL = ", ".join(f"'{h}'" for h in OPTIONAL_HEADERS)
COLS = "list_filter([id_col, phone_col, phone2_col, hide_col, title_col, price_col, date_col, slug_col], lambda h: h IS NOT NULL)"

MATCHES = f"""WITH s AS (SELECT s.*, {COLS} AS cols, f.size_bytes, f.readable FROM @sheets_flat s JOIN @files_flat f USING (file_key)),
f AS (SELECT * FROM @files_flat),
e AS (SELECT e.scraper, e.name, e.name LIKE '{{%' AS is_template, {list_sql('p.data_sheet_aliases')} AS aliases,
    CASE WHEN p.core_columns IS NOT NULL AND e.name <> 'Info' THEN {list_sql('p.core_columns')} ELSE {list_sql('e.required')} END AS required,
    CASE WHEN e.name LIKE '{{%' THEN {list_sql('p.optional_columns')} ELSE list_concat({list_sql('e.optional')}, {list_sql('p.optional_columns')}) END AS optional,
    coalesce(e.row_min, 0) AS row_min, coalesce(e.row_max, 999999) AS row_max
  FROM @expected_flat e LEFT JOIN @profiles_flat p USING (scraper) WHERE NOT (coalesce(p.skip_info_sheet, false) AND e.name = 'Info')),
wanted AS (SELECT f.scraper, f.file_key, e.* EXCLUDE (scraper) FROM f JOIN e USING (scraper) WHERE f.readable),
cand AS (SELECT w.*, s.sheet, s.sheet_pos, s.row_count, s.cols,
    CASE WHEN w.is_template THEN CASE WHEN (len(aliases) = 0 AND s.sheet NOT IN ('Info', 'No Data')) OR (len(aliases) > 0 AND
        (list_contains(aliases, s.sheet) OR (s.sheet NOT IN ('Info', 'No Data') AND s.row_count > 0))) THEN 0 END
      WHEN s.sheet = w.name THEN 0 WHEN list_contains(aliases, s.sheet) THEN list_position(aliases, s.sheet) END AS place
  FROM wanted w JOIN s USING (file_key)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_key, name ORDER BY place, sheet_pos) AS rn FROM cand WHERE place IS NOT NULL),
hit AS (SELECT * FROM ranked WHERE is_template OR rn = 1),
m AS (SELECT scraper, file_key, name, is_template, required, optional, row_min, row_max, sheet, row_count, cols FROM hit
  UNION ALL SELECT w.scraper, w.file_key, w.name, w.is_template, required, optional, row_min, row_max, NULL, NULL, NULL FROM wanted w
    WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.file_key = w.file_key AND h.name = w.name)),
miss AS (SELECT *, list_filter(required, lambda c: NOT list_contains({canon_list_sql('cols')}, {canon_sql('c')})
    AND NOT ({canon_sql('c')} = 'link' AND list_contains({canon_list_sql('cols')}, 'slug'))) AS missing FROM m WHERE sheet IS NOT NULL),
parts AS (SELECT *, list_filter(missing, lambda c: NOT ({canon_sql('c')} IN ({OPTIONAL}) OR list_contains({canon_list_sql('optional')}, {canon_sql('c')}))) AS core,
    list_filter(missing, lambda c: {canon_sql('c')} IN ({OPTIONAL}) OR list_contains({canon_list_sql('optional')}, {canon_sql('c')})) AS extra FROM miss)
"""

CHECKS = MATCHES + """,
q7 AS (SELECT scraper, file_key, sheet, CASE WHEN row_count > 0 THEN 'columns_in_' ELSE 'rows_in_' END || substr(CASE WHEN is_template THEN sheet ELSE name END, 1, 20) AS check_name,
    row_count = 0 OR len(core) = 0 AS passed, CASE WHEN row_count = 0 THEN '0 rows, skipped' ELSE concat_ws('; ',
      CASE WHEN len(core) > 0 THEN 'Missing core: ' || array_to_string(core, ', ') END,
      CASE WHEN len(extra) > 0 THEN 'optional absent: ' || array_to_string(extra, ', ') END,
      CASE WHEN len(core) > 0 THEN 'actual headers: ' || array_to_string(cols[1:12], ', ') || CASE WHEN len(cols) > 12 THEN '…' ELSE '' END END) END AS detail FROM parts),
q8 AS (SELECT scraper, file_key, sheet, 'rows_in_' || substr(CASE WHEN is_template THEN sheet ELSE name END, 1, 20) AS check_name, row_count BETWEEN row_min AND row_max AS passed,
    row_count || ' rows (expected ' || row_min || '-' || row_max || ')' AS detail FROM m WHERE sheet IS NOT NULL AND (NOT is_template OR row_count > 0)),
q9 AS (SELECT scraper, file_key, NULL::VARCHAR AS sheet, CASE WHEN is_template THEN 'data_sheets_exist' ELSE 'sheet_exists_' || name END AS check_name,
    false AS passed, CASE WHEN is_template THEN 'No data sheets found' ELSE 'Sheet ''' || name || ''' not found' END AS detail FROM m WHERE sheet IS NULL),
q10 AS (SELECT scraper, file_key, NULL::VARCHAR AS sheet, 'file_readable' AS check_name, readable AS passed, '' AS detail FROM f),
mins AS (SELECT f.*, coalesce(p.min_file_size_kb, x.kb, 0.0) AS least, size_bytes / 1024.0::DOUBLE AS kb FROM f
    JOIN (SELECT scraper, max(min_file_size_kb) AS kb FROM @expected_flat GROUP BY 1) x USING (scraper) LEFT JOIN @profiles_flat p USING (scraper) WHERE readable),
q11 AS (SELECT scraper, file_key, NULL::VARCHAR AS sheet, 'file_size_ok' AS check_name, kb >= least AS passed,
    CAST(round(kb, 1) AS VARCHAR) || ' KB (min ' || CAST(least AS VARCHAR) || ' KB)' AS detail FROM mins),
q12 AS (SELECT scraper, file_key, NULL::VARCHAR AS sheet, 'observed_file_size_floor' AS check_name, size_bytes / 1024.0::DOUBLE >= floor_kb AS passed,
    CAST(round(size_bytes / 1024.0::DOUBLE, 1) AS VARCHAR) || ' KB (observed floor ' || CAST(floor_kb AS VARCHAR) || ' KB)' AS detail
  FROM f JOIN @floors_flat USING (scraper)),
checks AS (FROM q7 UNION ALL FROM q8 UNION ALL FROM q9 UNION ALL FROM q10 UNION ALL FROM q11),
verdict AS (SELECT scraper, file_key, bool_and(passed) AS passed, count(*) FILTER (passed) AS checks_passed, count(*) AS checks_total FROM checks GROUP BY 1, 2),
sv AS (SELECT s.scraper, coalesce(x.n, 0) AS files_found, CAST(coalesce(v.p, 0) AS BIGINT) AS checks_passed, CAST(coalesce(v.t, 0) AS BIGINT) AS checks_total,
    CASE WHEN x.n IS NULL THEN files_optional ELSE coalesce(v.ok, true) END AS all_passed, files_optional AND x.n IS NULL AS files_optional
  FROM @scrapers_flat s LEFT JOIN (SELECT scraper, count(*) AS n FROM f GROUP BY 1) x USING (scraper)
  LEFT JOIN (SELECT scraper, bool_and(passed) AS ok, sum(checks_passed) AS p, sum(checks_total) AS t FROM verdict GROUP BY 1) v USING (scraper)),
qual AS (SELECT scraper, file_key, sheet, count(*) AS total_rows,
    CASE WHEN scraper IN ('click', 'error') THEN count(*) - count(DISTINCT id_val) - max(CASE WHEN id_val IS NULL THEN 1 ELSE 0 END) ELSE 0 END AS duplicate_id_count,
    round(count(*) FILTER (scraper IN ('click', 'error') AND id_val IS NULL) * 100.0::DOUBLE / count(*), 1) AS null_id_pct,
    round(count(*) FILTER (title_col IS NOT NULL AND title_val IS NULL) * 100.0::DOUBLE / count(*), 1) AS null_title_pct,
    round(count(*) FILTER (price_col IS NOT NULL AND price_val IS NULL) * 100.0::DOUBLE / count(*), 1) AS null_price_pct,
    round(count(*) FILTER (date_col IS NOT NULL AND NOT coalesce(starts_with(date_val, '""" + TEST_DAY + """'), false)) * 100.0::DOUBLE / count(*), 1) AS stale_date_pct
  FROM @sheet_wide WHERE sheet <> 'Info' GROUP BY 1, 2, 3),
fails AS (SELECT scraper, file_key, check_name AS "check", detail, 'validation' AS kind FROM checks WHERE NOT passed
  UNION ALL SELECT scraper, file_key, 'null_id_pct', 'Sheet ''' || sheet || ''': ' || CAST(null_id_pct AS VARCHAR) || '% null IDs', 'quality' FROM qual WHERE null_id_pct >= 5
  UNION ALL SELECT scraper, file_key, 'stale_date_pct', 'Sheet ''' || sheet || ''': ' || CAST(stale_date_pct AS VARCHAR) || '% stale dates', 'quality' FROM qual WHERE stale_date_pct >= 20),
alerts AS (SELECT scraper, 'critical' AS severity, 'no_files' AS type, 'files_found' AS "check", 'No Excel files found for target date' AS detail, NULL::VARCHAR AS file_key
    FROM sv WHERE files_found = 0 AND NOT files_optional
  UNION ALL SELECT scraper, CASE WHEN kind = 'quality' THEN 'high' WHEN "check" = 'file_readable' OR starts_with("check", 'sheet_exists') THEN 'critical'
      WHEN starts_with("check", 'trend_rows_high') THEN 'medium' ELSE 'high' END, kind, "check", detail, file_key FROM fails)
"""
CHECK_COLS = "scraper, file_key, sheet, check_name, passed, detail"


def matches(spark, sf):
    return q.match_expected_sheets(sheets(spark, sf), expected(spark, sf), profiles(spark, sf))


def checks(spark, sf):
    return q.schema_checks(sheets(spark, sf), expected(spark, sf), profiles(spark, sf))


def quality(spark, sf):
    return q.quality_metrics(sheet_rows(spark, sf), TEST_DAY)


def verdicts(spark, sf):
    told = q.schema_checks(sheets(spark, sf), expected(spark, sf), profiles(spark, sf), unchecked=True)
    return q.scraper_verdict(q.file_verdict(told), source(spark, sf, "scrapers_flat"))


def failures(spark, sf):
    return r.flatten_failures(checks(spark, sf), quality(spark, sf))


def raised(spark, sf):
    return r.collect_alerts(verdicts(spark, sf), failures(spark, sf))


@query("q2_sheet_profile", f"SELECT file_key, sheet, array_to_string({COLS}, ',') AS columns, row_count FROM @sheets_flat")
def q2(spark, sf):
    headers = sheets(spark, sf).select("file_key", "sheet", "columns")
    return q.sheet_profile(sheet_rows(spark, sf), headers).withColumn("columns", F.array_join("columns", ","))


HEADERS = ["listing ID", "Views_No", "Saved to R2 Date", "Description (AR)", "Whatsapp Phone", "Full Address EN", "Price (KD)", "s3-images-paths"]


@query(
    "q3_canonical_column",
    f"SELECT p_partkey, {canon_sql('h')} AS header FROM (SELECT p_partkey, [{', '.join(repr(h) for h in HEADERS)}][1 + p_partkey % {len(HEADERS)}] || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '' END AS h FROM part)",
)
def q3(spark, sf):
    named = F.element_at(F.array(*[F.lit(h) for h in HEADERS]), (F.col("p_partkey") % len(HEADERS) + 1).cast("int"))
    header = F.concat(named, F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(""))
    return source(spark, sf, "part").select("p_partkey", canonical_column(header).alias("header"))


@query(
    "q5_missing_columns",
    MATCHES + "SELECT file_key, name AS expected_name, sheet, array_to_string(core, ',') AS missing_core, array_to_string(extra, ',') AS missing_optional FROM parts",
)
def q5(spark, sf):
    found = q.missing_columns(matches(spark, sf).filter(F.col("sheet").isNotNull()))
    joined = [F.array_join(c, ",").alias(c) for c in ("missing_core", "missing_optional")]
    return found.select("file_key", "expected_name", "sheet", *joined)


@query("q6_match_expected_sheets", MATCHES + "SELECT scraper, file_key, name AS expected_name, is_template, sheet, row_count FROM m")
def q6(spark, sf):
    return matches(spark, sf).select("scraper", "file_key", "expected_name", "is_template", "sheet", "row_count")


@query("q7_check_sheet_columns", CHECKS + f"SELECT {CHECK_COLS} FROM q7")
def q7(spark, sf):
    return q.check_sheet_columns(matches(spark, sf))


@query("q8_check_row_range", CHECKS + f"SELECT {CHECK_COLS} FROM q8")
def q8(spark, sf):
    return q.check_row_range(matches(spark, sf))


@query("q9_check_sheet_exists", CHECKS + f"SELECT {CHECK_COLS} FROM q9")
def q9(spark, sf):
    return q.check_sheet_exists(matches(spark, sf))


@query("q10_check_file_readable", CHECKS + f"SELECT {CHECK_COLS} FROM q10")
def q10(spark, sf):
    return q.check_file_readable(q.files_of(sheets(spark, sf)))


@query("q11_check_file_size", CHECKS + f"SELECT {CHECK_COLS} FROM q11")
def q11(spark, sf):
    return q.check_file_size(q.files_of(sheets(spark, sf)), expected(spark, sf), profiles(spark, sf))


@query("q12_check_size_floor", CHECKS + f"SELECT {CHECK_COLS} FROM q12")
def q12(spark, sf):
    return q.check_size_floor(q.files_of(sheets(spark, sf)), source(spark, sf, "floors_flat"))


@query("q13_file_verdict", CHECKS + "SELECT * FROM verdict")
def q13(spark, sf):
    return q.file_verdict(checks(spark, sf))


@query("q14_scraper_verdict", CHECKS + "SELECT * FROM sv")
def q14(spark, sf):
    return verdicts(spark, sf)


@query("q15_quality_metrics", CHECKS + "SELECT * FROM qual")
def q15(spark, sf):
    return quality(spark, sf)


# --- baselines and trends -----------------------------------------------------------------------------

HISTORY = MATCHES.split("\nf AS")[0] + f"""
h AS (SELECT *, round(size_bytes / 1024.0::DOUBLE, 1) AS kb FROM s WHERE day < '{SPLIT_DAY}'),
base AS (SELECT scraper, min(kb) AS size_min, max(kb) AS size_max, arg_max(kb, (day, file_key)) AS size_last,
    list_sort(list_slice(list_reverse_sort(list_distinct(list(day))), 1, 30)) AS dates FROM h GROUP BY 1),
sbase AS (SELECT scraper, sheet, min(row_count) AS rows_min, max(row_count) AS rows_max, arg_max(row_count, (day, file_key)) AS rows_last,
    any_value(array_to_string(cols, ',')) AS columns FROM h GROUP BY 1, 2)
"""


def all_days(spark, sf):
    return sheets(spark, sf).withColumnRenamed("day", "date")


def history(spark, sf):
    return sheets(spark, sf).filter(F.col("day") < SPLIT_DAY).withColumnRenamed("day", "date")


def today(spark, sf):
    return sheets(spark, sf).filter(F.col("day") >= SPLIT_DAY)


ALL_DAYS = HISTORY.replace(f"day < '{SPLIT_DAY}'", "true")


@query("b1_build_baseline", ALL_DAYS + "SELECT scraper, size_min, size_max, size_last, array_to_string(dates, ',') AS observed_dates FROM base")
def b1(spark, sf):
    return b.build_baseline(all_days(spark, sf)).withColumn("observed_dates", F.array_join("observed_dates", ","))


@query("b2_build_sheet_baseline", ALL_DAYS + "SELECT * FROM sbase")
def b2(spark, sf):
    return b.build_sheet_baseline(all_days(spark, sf)).withColumn("columns", F.array_join("columns", ","))


@query(
    "b3_keep_recent_dates",
    "SELECT event_type AS scraper, array_to_string(list_sort(list_slice(list_reverse_sort(list(DISTINCT substr(CAST(ts AS VARCHAR), 1, 10))), 1, 7)), ',') AS dates FROM events GROUP BY 1",
)
def b3(spark, sf):
    days = source(spark, sf, "events").select(F.col("event_type").alias("scraper"), F.substring(F.col("ts").cast("string"), 1, 10).alias("d"))
    recent = days.groupBy("scraper").agg(b.keep_recent_dates(F.collect_set("d"), 7).alias("dates"))
    return recent.withColumn("dates", F.array_join("dates", ","))


@query(
    "b4_merge_baseline",
    ALL_DAYS + "SELECT scraper, size_min, size_max, size_last, array_to_string(dates, ',') AS observed_dates FROM base",
)
def b4(spark, sf):
    new = b.build_baseline(today(spark, sf).withColumnRenamed("day", "date"))
    merged = b.merge_baseline(b.build_baseline(history(spark, sf)), new)
    return merged.withColumn("observed_dates", F.array_join("observed_dates", ","))


@query("b4_merge_sheet_baseline", HISTORY.replace(f"day < '{SPLIT_DAY}'", "true") + "SELECT * FROM sbase")
def b4_sheets(spark, sf):
    new = b.build_sheet_baseline(today(spark, sf).withColumnRenamed("day", "date"))
    merged = b.merge_sheet_baseline(b.build_sheet_baseline(history(spark, sf)), new)
    return merged.withColumn("columns", F.array_join("columns", ","))


TRENDS = HISTORY + f""",
t AS (SELECT * FROM s WHERE day >= '{SPLIT_DAY}'),
b5 AS (SELECT scraper, file_key, NULL::VARCHAR AS sheet, 'trend_file_size' AS check_name, kb >= least AS passed,
    CAST(round(kb, 1) AS VARCHAR) || ' KB vs ' || CAST(round(least, 1) AS VARCHAR) || ' KB (50% of hist min ' || CAST(size_min AS VARCHAR) || ' KB)' AS detail
  FROM (SELECT DISTINCT t.scraper, file_key, size_bytes / 1024.0::DOUBLE AS kb, size_min * 0.5::DOUBLE AS least, size_min FROM t JOIN base USING (scraper) WHERE readable AND len(dates) >= 3)),
steady AS (SELECT t.* FROM t LEFT JOIN @profiles_flat p USING (scraper) WHERE sheet <> 'Info' AND NOT coalesce(p.skip_sheet_trend_checks, false)),
j AS (SELECT k.*, rows_min, rows_max FROM steady k JOIN sbase USING (scraper, sheet) JOIN base USING (scraper) WHERE readable AND len(dates) >= 3),
lo AS (SELECT *, greatest(1, CAST(trunc(rows_min * 0.3::DOUBLE) AS BIGINT)) AS lim FROM j WHERE rows_min > 0),
hi AS (SELECT *, CAST(trunc(rows_max * 3.0::DOUBLE) AS BIGINT) AS lim FROM j WHERE rows_max > 0),
b6 AS (SELECT scraper, file_key, sheet, 'trend_rows_low_' || substr(sheet, 1, 18) AS check_name, row_count >= lim AS passed,
    row_count || ' rows vs floor ' || lim || ' (30% of hist min ' || rows_min || ')' AS detail FROM lo),
b7 AS (SELECT scraper, file_key, sheet, 'trend_rows_high_' || substr(sheet, 1, 18) AS check_name, row_count <= lim AS passed,
    row_count || ' rows vs ceiling ' || lim || ' (300% of hist max ' || rows_max || ')' AS detail FROM hi)
"""


def baselines(spark, sf):
    return b.build_baseline(history(spark, sf)), b.build_sheet_baseline(history(spark, sf))


@query("b5_check_size_trend", TRENDS + f"SELECT {CHECK_COLS} FROM b5")
def b5(spark, sf):
    return b.check_size_trend(today(spark, sf).filter("readable"), b.build_baseline(history(spark, sf)))


@query("b6_check_rows_low", TRENDS + f"SELECT {CHECK_COLS} FROM b6")
def b6(spark, sf):
    return b.check_rows_low(b.skip_volatile(today(spark, sf), profiles(spark, sf)), *baselines(spark, sf))


@query("b7_check_rows_high", TRENDS + f"SELECT {CHECK_COLS} FROM b7")
def b7(spark, sf):
    return b.check_rows_high(b.skip_volatile(today(spark, sf), profiles(spark, sf)), *baselines(spark, sf))


@query("b8_skip_volatile", TRENDS + "SELECT file_key, sheet, row_count FROM steady")
def b8(spark, sf):
    return b.skip_volatile(today(spark, sf), profiles(spark, sf)).select("file_key", "sheet", "row_count")


@query("b_trend_checks", TRENDS + f"SELECT {CHECK_COLS} FROM (FROM b5 UNION ALL FROM b6 UNION ALL FROM b7)")
def trend(spark, sf):
    return b.trend_checks(today(spark, sf), *baselines(spark, sf), profiles(spark, sf))


# --- alerts -------------------------------------------------------------------------------------------

@query("r1_collect_alerts", CHECKS + "SELECT * FROM alerts")
def r1(spark, sf):
    return raised(spark, sf)


@query(
    "r2_check_severity",
    TRENDS.replace("\nt AS", "\nt AS", 1) + """SELECT check_name, CASE WHEN check_name = 'file_readable' OR starts_with(check_name, 'sheet_exists') THEN 'critical'
    WHEN starts_with(check_name, 'trend_rows_high') THEN 'medium' ELSE 'high' END AS severity, count(*) AS n FROM (FROM b5 UNION ALL FROM b6 UNION ALL FROM b7) GROUP BY 1, 2""",
)
def r2(spark, sf):
    told = trend(spark, sf).select("check_name", r.check_severity(F.col("check_name")).alias("severity"))
    return told.groupBy("check_name", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "r3_alert_gate",
    CHECKS + """, n AS (SELECT count(*) AS alerts, count(DISTINCT scraper) AS failing_scrapers, (SELECT count(*) FROM @scrapers_flat) AS total_scrapers FROM alerts)
    SELECT *, alerts > 0 AND failing_scrapers * 100.0 / total_scrapers >= 90 AS send FROM n""",
)
def r3(spark, sf):
    return r.alert_gate(raised(spark, sf), source(spark, sf, "scrapers_flat"), max_rate_pct=90.0)


@query(
    "r4_failure_breakdown",
    CHECKS + """, p AS (SELECT "check", scraper, count(*) AS n FROM fails GROUP BY 1, 2),
    g AS (SELECT "check", CAST(sum(n) AS BIGINT) AS failures, list_sort(list(scraper)) AS names FROM p GROUP BY 1)
    SELECT "check", failures, array_to_string(list_slice(names, 1, 6), ', ') || CASE WHEN len(names) > 6 THEN ' (+' || (len(names) - 6) || ' more)' ELSE '' END AS scrapers
    FROM g ORDER BY failures DESC, "check" LIMIT 20""",
)
def r4(spark, sf):
    return r.failure_breakdown(failures(spark, sf))


@query("r5_flatten_failures", CHECKS + "SELECT scraper, file_key, \"check\", detail, kind, regexp_extract(file_key, '([^/]*)$', 1) AS file FROM fails")
def r5(spark, sf):
    return failures(spark, sf)


@query(
    "r6_alert_digest",
    CHECKS + """, k AS (SELECT *, row_number() OVER (PARTITION BY scraper ORDER BY severity, "check", detail, file_key NULLS FIRST) AS rn,
      count(*) OVER (PARTITION BY scraper) AS n FROM alerts)
    SELECT scraper, any_value(n) AS alerts, '[' || scraper || ']' || chr(10) || string_agg(upper(severity) || ' ' || "check" || ': ' || detail ||
      coalesce(' - ' || regexp_extract(file_key, '([^/]*)$', 1), ''), chr(10) ORDER BY rn) FILTER (rn <= 8) ||
      CASE WHEN any_value(n) > 8 THEN chr(10) || '+' || (any_value(n) - 8) || ' more' ELSE '' END AS digest
    FROM k GROUP BY scraper""",
)
def r6(spark, sf):
    return r.alert_digest(raised(spark, sf))
