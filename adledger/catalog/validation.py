"""Queries over phones, ad ids and ad counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger.catalog.inputs import sheet_rows, sheets, source
from adledger.catalog.registry import query
from adledger.functions import phones
from adledger.functions.ad_ids import ad_id_facts, normalize_ad_id
from adledger.operators import ads, windows
from adledger.operators import validation as v
from adledger.session import scratch_dir
from adledger.streaming.intake import LANDED, hour_counts, start_hour_counts

EMPTY = "({c} IS NULL OR trim({c}) = '' OR lower(trim({c})) IN ('nan', 'none', 'null'))"


def digits_sql(c: str) -> str:
    """DuckDB: the first longest digit token of a cell."""
    clean = f"list_transform(string_split(trim({c}, '[]'), ','), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))"
    best = f"list_filter({clean}, lambda t: length(t) = list_max(list_transform({clean}, lambda u: length(u))))"
    return f"""CASE WHEN {EMPTY.format(c=c)} THEN '' WHEN {c} LIKE '[%]' THEN ({best})[1]
      ELSE regexp_replace({c}, '[^0-9]', '', 'g') END"""


def normal_sql(d: str) -> str:
    s = f"(CASE WHEN {d} LIKE '00%' AND length({d}) > 2 THEN substr({d}, 3) ELSE {d} END)"
    return f"""CASE WHEN length({s}) = 8 THEN '965' || {s} WHEN length({s}) = 11 AND {s} LIKE '965%' THEN {s}
      WHEN length({s}) = 12 AND {s} LIKE '9650%' THEN '965' || substr({s}, 5) END"""


def status_sql(d: str, n: str, hidden: str) -> str:
    return f"""CASE WHEN {d} = '' THEN CASE WHEN {hidden} THEN 'hidden' ELSE 'missing' END
      WHEN length({d}) < 8 THEN 'too_short' WHEN length({d}) > 13 THEN 'too_long'
      WHEN {n} IS NULL AND length({d}) >= 10 AND {d} NOT LIKE '965%' THEN 'wrong_country_code'
      WHEN {n} IS NULL THEN 'malformed'
      WHEN substr({n}, 4, 1) NOT IN ('2', '4', '5', '6', '9') THEN 'invalid_local_prefix' ELSE 'valid' END"""


def id_sql(c: str) -> str:
    t = f"regexp_replace(trim({c}), '^([0-9]+)\\.0$', '\\1')"
    runs = f"regexp_extract_all({t}, '[0-9]+')"
    best = f"list_filter({runs}, lambda r: length(r) = list_max(list_transform({runs}, lambda q: length(q))))"
    return f"""CASE WHEN {EMPTY.format(c=c)} THEN NULL
      WHEN regexp_full_match({t}, '[0-9]+') THEN CASE WHEN ltrim({t}, '0') = '' THEN '0' ELSE ltrim({t}, '0') END
      ELSE ({best})[1] END"""


def id_status_sql(c: str, n: str) -> str:
    return f"""CASE WHEN {EMPTY.format(c=c)} THEN 'missing' WHEN {n} IS NULL OR length({n}) < 3 THEN 'malformed' ELSE 'valid' END"""


TRUTHY = "coalesce(lower(trim({c})) IN ('1', 'true', 'yes', 'y', 't'), false)"

CELLS = f"""WITH d AS (SELECT *, {digits_sql('cell')} AS digits, {TRUTHY.format(c='hide_cell')} AS hidden FROM @phone_cells),
n AS (SELECT *, {normal_sql('digits')} AS normal FROM d),
s AS (SELECT *, {status_sql('digits', 'normal', 'hidden')} AS status FROM n)
"""

# every data row with contact and id status; the second phone column counts only when the first tells nothing
ROWS = f"""WITH d0 AS (SELECT *, {TRUTHY.format(c='hide_val')} AND hide_col IS NOT NULL AS hidden,
    {digits_sql('phone_val')} AS d1, {digits_sql('phone2_val')} AS d2, {id_sql('id_val')} AS nid
  FROM @sheet_wide WHERE lower(trim(sheet)) NOT IN ('info', 'no data')),
d1 AS (SELECT *, {normal_sql('d1')} AS n1, {normal_sql('d2')} AS n2 FROM d0),
d2 AS (SELECT *, {status_sql('d1', 'n1', 'hidden')} AS s1, {status_sql('d2', 'n2', 'hidden')} AS s2 FROM d1),
d3 AS (SELECT *, CASE WHEN s1 <> 'missing' THEN 1 WHEN phone2_col IS NOT NULL AND s2 <> 'missing' THEN 2 ELSE 0 END AS pick FROM d2),
checked AS (SELECT scraper, file_key, sheet, sheet_pos, row_no, phone_col, phone2_col,
    CASE WHEN phone_col IS NULL THEN NULL WHEN pick = 1 THEN s1 WHEN pick = 2 THEN s2 ELSE 'missing' END AS phone_status,
    CASE WHEN phone_col IS NULL THEN NULL WHEN pick = 1 AND s1 IN ('valid', 'invalid_local_prefix') THEN n1
         WHEN pick = 2 AND s2 IN ('valid', 'invalid_local_prefix') THEN n2 END AS phone,
    CASE WHEN phone_col IS NOT NULL THEN CASE WHEN pick = 2 THEN phone2_col ELSE phone_col END END AS phone_column,
    CASE WHEN phone_col IS NOT NULL THEN CASE pick WHEN 1 THEN phone_val WHEN 2 THEN phone2_val END END AS phone_value,
    id_col AS id_column, CASE WHEN id_col IS NOT NULL THEN id_val END AS id_value,
    CASE WHEN id_col IS NOT NULL THEN {id_status_sql('id_val', 'nid')} END AS ad_status,
    CASE WHEN id_col IS NOT NULL AND {id_status_sql('id_val', 'nid')} = 'valid' THEN nid END AS ad_id
  FROM d3),
flagged AS (SELECT * EXCLUDE (ad_status), CASE WHEN ad_status = 'valid' AND
    row_number() OVER (PARTITION BY file_key, ad_id ORDER BY sheet_pos, row_no) > 1 THEN 'duplicate' ELSE ad_status END AS ad_status
  FROM checked),
files AS (SELECT scraper, file_key, count(*) AS rows_scanned, count(DISTINCT sheet) AS sheets_scanned,
    count(phone_status) AS phones_seen, count(*) FILTER (phone_status = 'valid') AS phones_valid,
    count(*) FILTER (phone_status NOT IN ('valid', 'hidden', 'missing')) AS phones_invalid,
    count(*) FILTER (phone_status = 'missing') AS phones_missing, count(*) FILTER (phone_status = 'hidden') AS phones_hidden,
    count(DISTINCT CASE WHEN phone_status = 'valid' THEN phone END) AS phones_unique_valid,
    count(ad_status) AS ads_seen, count(*) FILTER (ad_status = 'valid') AS ads_valid,
    count(*) FILTER (ad_status <> 'valid') AS ads_invalid, count(*) FILTER (ad_status = 'missing') AS ads_missing,
    count(*) FILTER (ad_status = 'duplicate') AS ads_duplicates, count(DISTINCT ad_id) AS ads_unique_valid,
    max(id_column) AS id_column
  FROM flagged GROUP BY scraper, file_key),
uniq AS (SELECT scraper, count(DISTINCT CASE WHEN phone_status = 'valid' THEN phone END) AS phones_unique_valid,
    count(DISTINCT ad_id) AS ads_unique_valid FROM flagged GROUP BY scraper),
merged AS (SELECT f.scraper, count(*) AS files_found, CAST(sum(rows_scanned) AS BIGINT) AS rows_scanned,
    CAST(sum(sheets_scanned) AS BIGINT) AS sheets_scanned,
    CAST(sum(phones_seen) AS BIGINT) AS phones_seen, CAST(sum(phones_valid) AS BIGINT) AS phones_valid,
    CAST(sum(phones_invalid) AS BIGINT) AS phones_invalid, CAST(sum(phones_missing) AS BIGINT) AS phones_missing,
    CAST(sum(phones_hidden) AS BIGINT) AS phones_hidden, CAST(sum(ads_seen) AS BIGINT) AS ads_seen,
    CAST(sum(ads_valid) AS BIGINT) AS ads_valid, CAST(sum(ads_invalid) AS BIGINT) AS ads_invalid,
    CAST(sum(ads_missing) AS BIGINT) AS ads_missing, CAST(sum(ads_duplicates) AS BIGINT) AS ads_duplicates,
    max(id_column) AS id_column, any_value(u.phones_unique_valid) AS phones_unique_valid,
    any_value(u.ads_unique_valid) AS ads_unique_valid
  FROM files f JOIN uniq u USING (scraper) GROUP BY f.scraper),
pcts AS (SELECT *, CASE WHEN phones_seen > 0 THEN round(phones_valid * 100.0::DOUBLE / phones_seen, 2) ELSE 0.0::DOUBLE END AS phones_valid_pct,
    CASE WHEN phones_seen > 0 THEN round(phones_invalid * 100.0::DOUBLE / phones_seen, 2) ELSE 0.0::DOUBLE END AS phones_invalid_pct,
    CASE WHEN ads_seen > 0 THEN round(ads_valid * 100.0::DOUBLE / ads_seen, 2) ELSE 0.0::DOUBLE END AS ads_valid_pct,
    CASE WHEN ads_seen > 0 THEN round(ads_invalid * 100.0::DOUBLE / ads_seen, 2) ELSE 0.0::DOUBLE END AS ads_invalid_pct FROM merged),
gate AS (SELECT s.scraper, files_optional, p.* EXCLUDE (scraper), list_filter([
    CASE WHEN files_found IS NULL AND NOT files_optional THEN 'no_excel_files' END,
    CASE WHEN files_found IS NOT NULL AND phones_seen = 0 AND ads_seen = 0 THEN 'no_phone_or_id_columns' END,
    CASE WHEN phones_seen > 0 AND phones_invalid_pct > 30 THEN 'phone_invalid_pct=' || CAST(phones_invalid_pct AS VARCHAR) || '>30.0' END,
    CASE WHEN ads_seen > 0 AND ads_invalid_pct > 15 THEN 'ads_invalid_pct=' || CAST(ads_invalid_pct AS VARCHAR) || '>15.0' END],
    lambda r: r IS NOT NULL) AS reasons
  FROM @scrapers_flat s LEFT JOIN pcts p USING (scraper))
"""

FILE_COLUMNS = [
    "rows_scanned", "sheets_scanned", "phones_seen", "phones_valid", "phones_invalid", "phones_missing", "phones_hidden",
    "phones_unique_valid", "ads_seen", "ads_valid", "ads_invalid", "ads_missing", "ads_duplicates", "ads_unique_valid", "id_column",
]
SCRAPER_COLUMNS = ["files_found", *FILE_COLUMNS, "phones_valid_pct", "phones_invalid_pct", "ads_valid_pct", "ads_invalid_pct"]


@query("v1_phone_tokens", f"SELECT c_custkey, digits FROM (SELECT *, {digits_sql('cell')} AS digits FROM @phone_cells)")
def v1(spark, sf):
    cells = source(spark, sf, "phone_cells")
    return cells.select("c_custkey", phones.longest_token(phones.phone_tokens("cell")).alias("digits"))


DOC_TOKEN = r"\+?[0-9][0-9 ()-]{6,}[0-9]"


@query(
    "v1_phone_tokens_in_text",
    f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '{DOC_TOKEN}')) AS cell FROM documents),
    d AS (SELECT *, regexp_replace(cell, '[^0-9]', '', 'g') AS digits FROM t),
    n AS (SELECT *, {normal_sql('digits')} AS normal FROM d)
    SELECT {status_sql('digits', 'normal', 'false')} AS status, count(*) AS n, count(DISTINCT doc_id) AS docs FROM n GROUP BY 1""",
)
def v1_text(spark, sf):
    found = source(spark, sf, "documents").select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(DOC_TOKEN), F.lit(0))).alias("cell")
    )
    status = found.select("doc_id", phones.classify_phone("cell").alias("status"))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("v2_normalize_phone", CELLS + "SELECT c_custkey, normal FROM n")
def v2(spark, sf):
    digits = phones.longest_token(phones.phone_tokens("cell"))
    return source(spark, sf, "phone_cells").select("c_custkey", phones.normalize_phone(digits).alias("normal"))


@query("v3_classify_phone", CELLS + "SELECT c_custkey, status FROM s")
def v3(spark, sf):
    cells = source(spark, sf, "phone_cells")
    return cells.select("c_custkey", phones.classify_phone("cell", phones.truthy_flag("hide_cell")).alias("status"))


@query("v4_truthy_flag", f"SELECT c_custkey, {TRUTHY.format(c='hide_cell')} AS hidden FROM @phone_cells")
def v4(spark, sf):
    return source(spark, sf, "phone_cells").select("c_custkey", phones.truthy_flag("hide_cell").alias("hidden"))


@query("v5_row_contact", ROWS + "SELECT file_key, row_no, phone_status, phone, phone_column, phone_value FROM checked")
def v5(spark, sf):
    rows = v.row_contact(v.data_sheets(sheet_rows(spark, sf)))
    return rows.select("file_key", "row_no", "phone_status", "phone", "phone_column", "phone_value")


RUN = "list_filter({r}, lambda r: length(r) = list_max(list_transform({r}, lambda q: length(q))))[1]"


def identity_sql(c: str, n: str, s: str) -> str:
    runs = f"regexp_extract_all({c}, '[0-9]+')"
    return f"coalesce(CASE WHEN {s} IN ('valid', 'invalid_local_prefix') THEN {n} END, {RUN.format(r=runs)})"


@query(
    "v6_phone_sets",
    f"""WITH c AS (SELECT scraper, phone_val AS cell FROM @sheet_wide WHERE phone_col IS NOT NULL AND sheet NOT IN ('Info', ' No Data ')
      UNION ALL SELECT scraper, phone2_val FROM @sheet_wide WHERE phone2_col IS NOT NULL AND sheet NOT IN ('Info', ' No Data ')),
    d AS (SELECT *, {digits_sql('cell')} AS digits FROM c), n AS (SELECT *, {normal_sql('digits')} AS normal FROM d),
    s AS (SELECT *, {status_sql('digits', 'normal', 'false')} AS status FROM n),
    i AS (SELECT scraper, status, {identity_sql('cell', 'normal', 'status')} AS identity FROM s WHERE status <> 'missing')
    SELECT scraper, count(DISTINCT identity) AS unique_phones,
      count(DISTINCT identity) FILTER (status = 'valid') AS valid_phones,
      count(DISTINCT identity) FILTER (status NOT IN ('valid', 'wrong_country_code')) AS invalid_phones,
      count(DISTINCT identity) FILTER (status = 'wrong_country_code') AS outside_country_phones
    FROM i GROUP BY scraper""",
)
def v6(spark, sf):
    return v.phone_sets(sheet_rows(spark, sf))


@query("v7_normalize_ad_id", f"SELECT o_orderkey, {id_sql('cell')} AS ad_id FROM @ad_id_cells")
def v7(spark, sf):
    return source(spark, sf, "ad_id_cells").select("o_orderkey", normalize_ad_id("cell").alias("ad_id"))


@query(
    "v8_classify_ad_id",
    f"SELECT o_orderkey, {id_status_sql('cell', 'n')} AS status FROM (SELECT *, {id_sql('cell')} AS n FROM @ad_id_cells)",
)
def v8(spark, sf):
    return source(spark, sf, "ad_id_cells").select("o_orderkey", ad_id_facts("cell")["status"].alias("status"))


@query("v9_flag_duplicate_ids", ROWS + "SELECT file_key, row_no, ad_status, ad_id FROM flagged")
def v9(spark, sf):
    return v.flag_duplicate_ids(v.check_rows(sheet_rows(spark, sf))).select("file_key", "row_no", "ad_status", "ad_id")


COLUMNS_FOUND = "CASE scraper WHEN 'click' THEN 'Phone,WhatsApp Phone' WHEN 'error' THEN 'Phone Number' WHEN 'purchase' THEN 'Contacts,contact_no' WHEN 'signup' THEN 'user-phone' ELSE '' END"


@query("v10_file_validation", ROWS + f"SELECT scraper, file_key, {', '.join(FILE_COLUMNS)}, {COLUMNS_FOUND} AS columns_found FROM files")
def v10(spark, sf):
    files = v.file_validation(v.check_rows(sheet_rows(spark, sf)))
    return files.select("scraper", "file_key", *FILE_COLUMNS, F.array_join("columns_found", ",").alias("columns_found"))


@query(
    "v11_reason_histogram",
    ROWS + """SELECT scraper, 'phone' AS kind, phone_status AS reason, count(*) AS n FROM flagged WHERE phone_status IS NOT NULL GROUP BY 1, 2, 3
    UNION ALL SELECT scraper, 'ad_id', ad_status, count(*) FROM flagged WHERE ad_status IS NOT NULL GROUP BY 1, 2, 3""",
)
def v11(spark, sf):
    return v.reason_histogram(v.flag_duplicate_ids(v.check_rows(sheet_rows(spark, sf))))


@query(
    "v12_invalid_samples",
    ROWS + """, bad AS (SELECT scraper, file_key, 'phone' AS kind, sheet, sheet_pos, row_no, phone_column AS "column", substr(phone_value, 1, 80) AS value,
        phone_status AS reason FROM flagged WHERE phone_status NOT IN ('valid', 'hidden', 'missing')
      UNION ALL SELECT scraper, file_key, 'ad_id', sheet, sheet_pos, row_no, id_column,
        CASE WHEN ad_status = 'missing' THEN '' ELSE substr(id_value, 1, 80) END, ad_status FROM flagged WHERE ad_status <> 'valid'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY file_key, kind ORDER BY sheet_pos, row_no) AS rn FROM bad)
    SELECT scraper, file_key, kind, sheet, row_no + 2 AS "row", "column", value, reason FROM ranked WHERE rn <= 25""",
)
def v12(spark, sf):
    return v.invalid_samples(v.flag_duplicate_ids(v.check_rows(sheet_rows(spark, sf))))


@query("v13_scraper_validation", ROWS + f"SELECT scraper, {', '.join(SCRAPER_COLUMNS)} FROM pcts")
def v13(spark, sf):
    return v.scraper_validation(v.check_rows(sheet_rows(spark, sf))).select("scraper", *SCRAPER_COLUMNS)


LISTED = ROWS.replace("FROM @sheet_wide WHERE", "FROM @sheet_wide SEMI JOIN (SELECT file_key FROM @files_flat WHERE readable) USING (file_key) WHERE")
COUNTS = [c for c in FILE_COLUMNS if c != "id_column"]


def listed_files(spark, sf):
    return source(spark, sf, "files_flat").select("scraper", "file_key", "readable")


@query(
    "v10_listed_files",
    LISTED + f"""SELECT scraper, l.file_key, l.readable, {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in COUNTS)}, f.id_column,
      CASE WHEN f.file_key IS NULL THEN '' ELSE {COLUMNS_FOUND} END AS columns_found FROM @files_flat l LEFT JOIN files f USING (scraper, file_key)""",
)
def v10_listed(spark, sf):
    files = v.file_validation(v.check_rows(sheet_rows(spark, sf)), listed_files(spark, sf))
    return files.select("scraper", "file_key", "readable", *FILE_COLUMNS, F.array_join("columns_found", ",").alias("columns_found"))


@query(
    "v12_scraper_samples",
    ROWS + """, bad AS (SELECT scraper, file_key, 'phone' AS kind, sheet, sheet_pos, row_no, phone_column AS "column", substr(phone_value, 1, 80) AS value,
        phone_status AS reason FROM flagged WHERE phone_status NOT IN ('valid', 'hidden', 'missing')
      UNION ALL SELECT scraper, file_key, 'ad_id', sheet, sheet_pos, row_no, id_column,
        CASE WHEN ad_status = 'missing' THEN '' ELSE substr(id_value, 1, 80) END, ad_status FROM flagged WHERE ad_status <> 'valid'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY scraper, kind ORDER BY file_key, sheet_pos, row_no) AS rn FROM bad)
    SELECT scraper, file_key, kind, sheet, row_no + 2 AS "row", "column", value, reason FROM ranked WHERE rn <= 25""",
)
def v12_merged(spark, sf):
    return v.invalid_samples(v.flag_duplicate_ids(v.check_rows(sheet_rows(spark, sf))), merged=True)


@query(
    "v13_listed_files",
    LISTED + f"""SELECT scraper, l.files_found, l.files_readable, {', '.join(f'coalesce(p.{c}, 0) AS {c}' for c in COUNTS)}, p.id_column,
      {', '.join(f'coalesce(p.{c}, 0) AS {c}' for c in ('phones_valid_pct', 'phones_invalid_pct', 'ads_valid_pct', 'ads_invalid_pct'))}
    FROM (SELECT scraper, count(*) AS files_found, count(*) FILTER (readable) AS files_readable FROM @files_flat GROUP BY 1) l LEFT JOIN pcts p USING (scraper)""",
)
def v13_listed(spark, sf):
    merged = v.scraper_validation(v.check_rows(sheet_rows(spark, sf)), listed_files(spark, sf))
    return merged.select("scraper", "files_readable", *SCRAPER_COLUMNS)


LISTED_GATE = LISTED[LISTED.index("gate AS (SELECT"):].replace("gate AS (", "listed_gate AS (", 1).replace("LEFT JOIN pcts p", "LEFT JOIN listed p")
LISTED_PCTS = "listed AS (SELECT l.scraper, l.files_found, " + ", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in (*[t for t in v.TOTALS if t != "files_found"], "phones_unique_valid", "ads_unique_valid", "phones_invalid_pct", "ads_invalid_pct")) + """
    FROM (SELECT scraper, count(*) AS files_found FROM @files_flat GROUP BY 1) l LEFT JOIN pcts p USING (scraper))"""
GATE_ROWS = "SELECT scraper, len(reasons) = 0 AS passed, array_to_string(reasons, ',') AS fail_reasons FROM "


def gated(spark, sf):
    """The gate over all listed files: a scraper whose files hold no data rows has files."""
    merged = v.scraper_validation(v.check_rows(sheet_rows(spark, sf)), listed_files(spark, sf))
    return v.validation_gate(merged, source(spark, sf, "scrapers_flat"), max_phone_pct=30.0)


@query("v14_listed_files", LISTED + f", {LISTED_PCTS}, {LISTED_GATE} {GATE_ROWS} listed_gate")
@query("v14_validation_gate", LISTED + f", {LISTED_PCTS}, {LISTED_GATE} {GATE_ROWS} listed_gate")
def v14(spark, sf):
    return gated(spark, sf).select("scraper", "passed", F.array_join("fail_reasons", ",").alias("fail_reasons"))


@query("v14_gate_of_rows", ROWS + f"{GATE_ROWS} gate")
def v14_rows(spark, sf):
    """The gate where no list of files is at hand: what has no data rows counts as not found."""
    gate = v.validation_gate(v.scraper_validation(v.check_rows(sheet_rows(spark, sf))), source(spark, sf, "scrapers_flat"), max_phone_pct=30.0)
    return gate.select("scraper", "passed", F.array_join("fail_reasons", ",").alias("fail_reasons"))


@query(
    "v15_validation_totals",
    LISTED + f""", {LISTED_PCTS}, {LISTED_GATE}, t AS (SELECT count(*) AS scrapers_total, count(*) FILTER (len(reasons) = 0) AS scrapers_passed,
      {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in v.TOTALS)},
      CAST(sum(phones_unique_valid) AS BIGINT) AS phones_unique_valid_sum, CAST(sum(ads_unique_valid) AS BIGINT) AS ads_unique_valid_sum FROM listed_gate)
    SELECT *, round(phones_valid * 100.0::DOUBLE / phones_seen, 2) AS phones_valid_pct, round(phones_invalid * 100.0::DOUBLE / phones_seen, 2) AS phones_invalid_pct,
      round(ads_valid * 100.0::DOUBLE / ads_seen, 2) AS ads_valid_pct, round(ads_invalid * 100.0::DOUBLE / ads_seen, 2) AS ads_invalid_pct FROM t""",
)
def v15(spark, sf):
    return v.validation_totals(gated(spark, sf))


@query(
    "q1_data_sheets",
    "SELECT scraper, sheet, count(*) AS n FROM @sheet_wide WHERE lower(trim(sheet)) NOT IN ('info', 'no data') GROUP BY 1, 2",
)
def q1(spark, sf):
    return v.data_sheets(sheet_rows(spark, sf)).groupBy("scraper", "sheet").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q4_find_columns",
    f"""SELECT file_key, sheet, CASE scraper WHEN 'click' THEN 'Phone,WhatsApp Phone' WHEN 'error' THEN 'Phone Number'
      WHEN 'purchase' THEN 'contact_no,Contacts' WHEN 'signup' THEN 'user-phone' ELSE '' END AS phone_columns,
      hide_col AS hide_column, CASE WHEN scraper <> 'view' THEN id_col END AS id_column_raw, id_col AS id_column, date_col AS date_column
    FROM @sheets_flat""",
)
def q4(spark, sf):
    return v.find_columns(sheets(spark, sf)).withColumn("phone_columns", F.array_join("phone_columns", ","))


DATA = "FROM @sheet_wide WHERE sheet NOT IN ('Info', ' No Data ')"
RAW_ID = "CASE WHEN scraper <> 'view' AND trim(id_val) <> '' AND lower(trim(id_val)) NOT IN ('nan', 'none') THEN trim(id_val) END"


@query(
    "a1_unique_ads",
    f"""SELECT scraper, CASE WHEN scraper IN ('click', 'error', 'purchase') THEN count(DISTINCT {RAW_ID}) END AS unique_ads
    {DATA} GROUP BY scraper""",
)
def a1(spark, sf):
    return ads.unique_ads(sheet_rows(spark, sf))


A2 = f"""WITH c AS (SELECT scraper, count(DISTINCT {RAW_ID}) AS ids, count(*) AS n {DATA} GROUP BY scraper),
a2 AS (SELECT s.scraper, CASE WHEN s.scraper IN ('click', 'error', 'purchase') THEN ids ELSE coalesce(n, 0) END AS unique_ads,
  coalesce(n, 0) AS total_rows, CASE WHEN s.scraper IN ('click', 'error', 'purchase') THEN 'excel_ids' WHEN n > 0 THEN 'excel_rows' ELSE 'none' END AS ads_source
FROM @scrapers_flat s LEFT JOIN c USING (scraper))
"""


@query("a2_count_ads", A2 + "SELECT * FROM a2")
def a2(spark, sf):
    return ads.count_ads(sheet_rows(spark, sf), source(spark, sf, "scrapers_flat"))


@query(
    "a7_hour_histogram",
    f"""SELECT scraper, CAST(hour(TRY_CAST(date_val AS TIMESTAMP)) AS INT) AS hour, count(*) AS ads_count {DATA}
    AND date_col IS NOT NULL AND TRY_CAST(date_val AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2""",
)
def a7(spark, sf):
    return ads.hour_histogram(sheet_rows(spark, sf))


# --- kept up to date: sets by day, counts by batch ------------------------------------------------------

def windows_sql(values: str) -> str:
    """All windows of 7 days over ``values`` (scraper, kind, day, value), each counted from its rows."""
    return f"""WITH v AS (SELECT scraper, kind, CAST(day AS DATE) AS day, value FROM ({values}) WHERE value IS NOT NULL),
    ends AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM v), (SELECT max(day) FROM v), INTERVAL 1 DAY)) AS DATE) AS day_to)
    SELECT scraper, kind, CAST(day_to AS VARCHAR) AS day_to, count(DISTINCT value) AS distinct_count
    FROM v JOIN ends ON day BETWEEN day_to - 6 AND day_to GROUP BY ALL"""


def window_query(spark, values):
    root = scratch_dir(spark, "day-sets")
    windows.write_day_sets(windows.day_sets(values), root)
    return windows.window_counts(windows.read_day_sets(spark, root)).withColumn("day_to", F.col("day_to").cast("string"))


@query("a1_unique_ads_windows", windows_sql(f"SELECT scraper, 'ad_id' AS kind, day, {RAW_ID} AS value {DATA} AND id_col IS NOT NULL"))
def a1_windows(spark, sf):
    return window_query(spark, windows.ad_id_values(sheet_rows(spark, sf)))


PHONE_VALUES = f"""WITH c AS (SELECT scraper, day, phone_val AS cell {DATA} AND phone_col IS NOT NULL
      UNION ALL SELECT scraper, day, phone2_val {DATA} AND phone2_col IS NOT NULL),
    d AS (SELECT *, {digits_sql('cell')} AS digits FROM c), n AS (SELECT *, {normal_sql('digits')} AS normal FROM d),
    s AS (SELECT *, {status_sql('digits', 'normal', 'false')} AS status FROM n),
    i AS (SELECT scraper, day, status, {identity_sql('cell', 'normal', 'status')} AS value FROM s WHERE status <> 'missing')
    SELECT scraper, 'phone' AS kind, day, value FROM i UNION ALL
    SELECT scraper, CASE status WHEN 'valid' THEN 'valid' WHEN 'wrong_country_code' THEN 'outside' ELSE 'invalid' END, day, value FROM i"""


@query("v6_phone_windows", windows_sql(PHONE_VALUES))
def v6_windows(spark, sf):
    return window_query(spark, windows.phone_values(sheet_rows(spark, sf)))


LATE_FROM = "2024-01-21"


@query(
    "a7_hours_by_batch",
    f"""WITH c AS (SELECT scraper, CAST(day AS DATE) AS day, CAST(hour(TRY_CAST(date_val AS TIMESTAMP)) AS INT) AS hour,
      CASE WHEN day >= '{LATE_FROM}' THEN 2 WHEN row_no % 5 = 0 THEN 3 ELSE 1 END AS batch {DATA}
      AND date_col IS NOT NULL AND TRY_CAST(date_val AS TIMESTAMP) IS NOT NULL),
    l AS (SELECT *, batch = 3 AND coalesce(day < (SELECT max(day) FROM c WHERE batch < 3) - 7, false) AS late FROM c)
    SELECT scraper, CAST(day AS VARCHAR) AS day, hour, count(*) FILTER (NOT late) AS ads_count, count(*) FILTER (late) AS late_count FROM l GROUP BY ALL""",
)
def a7_batches(spark, sf):
    """The rows land in three parts, the last of them late; each run of the stream counts its own part."""
    landing, store, checkpoint = (scratch_dir(spark, n) for n in ("landing", "hour-counts", "intake"))
    rows = sheet_rows(spark, sf).withColumns({"site_id": F.lit("site"), "hub_partition_date": F.col("day").cast("date")})
    landed = spark.createDataFrame([], LANDED).schema
    late = (F.col("day") < LATE_FROM) & (F.col("row_no") % 5 == 0)
    for part in ((F.col("day") < LATE_FROM) & ~late, F.col("day") >= LATE_FROM, late):
        rows.filter(part).to(landed).write.mode("append").parquet(landing)
        start_hour_counts(spark, landing, store, checkpoint).awaitTermination()
    return hour_counts(spark, store).select("scraper", F.col("hub_partition_date").cast("string").alias("day"), "hour", "ads_count", "late_count")
