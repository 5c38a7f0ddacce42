"""Queries over merged documents, daily tables and their upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger import rules
from adledger.catalog.documents import HOUR_SHAPES, elements, txt, whole
from adledger.catalog.inputs import registry, source
from adledger.catalog.registry import query
from adledger.catalog.sites import BY_FOLDER, CONFIGURED, FOLDER_DEFAULTS, LOOKUP, RESULTS, SCHEDULE, monitor, real, requests
from adledger.functions import variants as V
from adledger.operators import hub as f
from adledger.operators import workflows as k
from adledger.schemas import table_types

DOCS = f"""WITH hd AS (SELECT CAST(day AS DATE) AS hub_partition_date, body FROM @hub_docs),
sd0 AS (SELECT hub_partition_date, unnest(json_extract(body, '$.sites[*]')) AS site FROM hd),
sd AS (SELECT hub_partition_date, coalesce(nullif({txt('site', '$.site_id')}, ''), nullif({txt('site', '$.folder')}, '')) AS site_id, nullif({txt('site', '$.folder')}, '') AS folder,
    site, CASE WHEN json_type(site, '$.report') = 'OBJECT' THEN json_extract(site, '$.report') END AS doc FROM sd0
  WHERE coalesce(nullif({txt('site', '$.site_id')}, ''), nullif({txt('site', '$.folder')}, '')) IS NOT NULL),
sc0 AS (SELECT hub_partition_date, site_id, unnest(CASE WHEN json_type(doc, '$.scrapers') = 'OBJECT' THEN json_keys(doc, '$.scrapers') ELSE
      list_transform(range(len({RESULTS})), lambda i: coalesce({RESULTS}[i + 1] ->> '$.scraper', 'scraper_' || i)) END) AS name, unnest({RESULTS}) AS body FROM sd),
sc AS (SELECT hub_partition_date, site_id, coalesce(nullif({txt('body', '$.scraper')}, ''), name) AS scraper, body FROM sc0)
"""


def typed(doc: str, c: str, kind: str) -> str:
    path = f"$.{c}"
    if kind in ("INT", "BIGINT"):
        return f"CAST({whole(doc, path)} AS {kind}) AS {c}"
    if kind == "DOUBLE":
        return f"{real(doc, path)} AS {c}"
    if kind == "DATE":
        return f"TRY_CAST(substr({txt(doc, path)}, 1, 10) AS DATE) AS {c}"
    if kind == "TIMESTAMP":
        return f"TRY_CAST(rtrim({txt(doc, path)}, 'Z') AS TIMESTAMP) AS {c}"
    return f"TRY_CAST({txt(doc, path)} AS {kind}) AS {c}"


def hub_docs(spark, sf):
    return source(spark, sf, "hub_docs").select(V.parse("body").alias("doc"))


def docs(spark, sf):
    return f.site_docs(hub_docs(spark, sf))


def entries(spark, sf):
    return f.scraper_entries(docs(spark, sf))


REQ = ["total_requests", "total_requests_failed", "avg_error_rate_pct", "avg_requests_per_min"]
HUB_PLAIN = ", ".join(typed("body", c, t) for c, t in table_types("hub_daily").items() if c not in ("hub_partition_date", *REQ))
RUNS = "(list_filter(json_extract(doc, '$.github_run.workflows[*]'), lambda w: json_type(w) = 'OBJECT'))"
STORED = txt("doc", "$.github_run.workflow_name")
SPENT = "date_diff('second', TRY_CAST(w ->> '$.run_started_at' AS TIMESTAMPTZ), TRY_CAST(w ->> '$.updated_at' AS TIMESTAMPTZ))"
SECONDS = f"""list_filter(list_transform(list_filter({RUNS}, lambda w: NOT {monitor("(w ->> '$.name')")}),
  lambda w: coalesce({whole('w', '$.duration_sec')}, CASE WHEN {SPENT} IS NOT NULL THEN greatest(0, {SPENT}) END)), lambda s: s IS NOT NULL)"""
DURATION = f"CASE WHEN NOT {monitor(f'({STORED})')} THEN coalesce(CASE WHEN len({SECONDS}) > 0 THEN CAST(list_sum({SECONDS}) AS BIGINT) END, {whole('doc', '$.github_run.duration_sec')}) END"
SITE_STATUS = f"CASE {txt('site', '$.status')} WHEN 'ok' THEN 'success' WHEN 'failed' THEN 'failure' END"
STATUS = f"""coalesce(CASE WHEN NOT {monitor(f'({STORED})')} THEN {txt('doc', '$.github_run.workflow_status')} END,
  CASE WHEN len({RUNS}) > 0 THEN CASE WHEN len(list_filter({RUNS}, lambda w: coalesce(w ->> '$.conclusion', 'success') NOT IN ('success', 'skipped', 'cancelled'))) > 0 THEN 'failure' ELSE 'success' END END,
  {SITE_STATUS})"""
RUN_NAMES = f"list_filter(list_transform({RUNS}, lambda w: w ->> '$.name'), lambda n: n <> '' AND NOT {monitor('n')})"
LEGACY = f"coalesce(nullif(r.workflow_name, ''), nullif({txt('doc', '$.workflow_name')}, ''))"
LABEL = f"""coalesce(CASE WHEN trim({STORED}) <> '' AND trim({STORED}) NOT IN ('—', '-', 'None', 'null', 'N/A', 'n/a') AND NOT {monitor(f'({STORED})')} THEN {STORED} END,
  CASE WHEN len(r.names) > 0 THEN array_to_string(r.names, ' → ') END, CASE WHEN len({RUN_NAMES}) > 0 THEN array_to_string({RUN_NAMES}, ' → ') END,
  CASE WHEN NOT {monitor(f'({LEGACY})')} THEN {LEGACY} END, '—')"""
SCHEDULE_SQL = f"""CASE WHEN r.seq IS NOT NULL THEN r.schedule_name WHEN s.folder IS NOT NULL THEN coalesce({BY_FOLDER.replace('folder', 's.folder', 1).replace('site_id', 's.site_id', 1)}, 'daily') END"""

SPECIAL = {
    "hub_partition_date": "hub_partition_date", "site_id": "s.site_id", "folder": "s.folder",
    "repo": f"coalesce(nullif({txt('site', '$.repo')}, ''), r.repo)", "github_username": "r.github_username",
    "run_place": f"coalesce(nullif(r.run_place, ''), {txt('doc', '$.run_place')}, {txt('doc', '$.github_run.run_place')}, 'github')",
    "workflow_name": LABEL,
    "workflow_run_number": f"CASE WHEN NOT {monitor(f'({STORED})')} THEN CAST({txt('doc', '$.github_run.workflow_run_number')} AS INT) END",
    "workflow_run_id": f"CASE WHEN NOT {monitor(f'({STORED})')} THEN {txt('doc', '$.github_run.workflow_run_id')} END",
    "workflow_status": STATUS, "workflow_duration_sec": f"CAST({DURATION} AS INT)", "schedule": SCHEDULE_SQL,
    "requests_total": "CAST(requests_total AS INT)", "requests_failed": "CAST(requests_failed AS INT)", "error_rate_pct": "error_rate_pct", "requests_per_min": "requests_per_min",
    "scrapers_failed": f"CAST(len(list_filter({RESULTS}, lambda x: coalesce(x ->> '$.all_passed', 'false') <> 'true')) AS INT)",
    "report_fallback": f"coalesce(TRY_CAST({txt('site', '$.report_fallback')} AS BOOLEAN), false)",
    "uses_proxy": f"coalesce(TRY_CAST({txt('site', '$.uses_proxy')} AS BOOLEAN), TRY_CAST({txt('doc', '$.uses_proxy')} AS BOOLEAN), r.uses_proxy)",
}
SITE_COLS = ", ".join(f"{SPECIAL[c]} AS {c}" if c in SPECIAL else typed("site", c, t) for c, t in table_types("site_daily").items())
SITES = DOCS + f""", {LOOKUP},
reg AS (SELECT *, {CONFIGURED} AS names, coalesce({SCHEDULE}, {BY_FOLDER}, 'daily') AS schedule_name FROM @registry_flat),
{requests('sd')},
site_daily AS (SELECT {SITE_COLS} FROM req s LEFT JOIN lastkey a ON a.key = s.site_id LEFT JOIN lastkey b ON b.key = s.folder LEFT JOIN reg r ON r.seq = coalesce(a.seq, b.seq)),
hub_daily AS (SELECT hub_partition_date, {HUB_PLAIN}, CAST(total_requests AS INT) AS total_requests, CAST(total_requests_failed AS INT) AS total_requests_failed, avg_error_rate_pct, avg_requests_per_min
  FROM hd LEFT JOIN (SELECT hub_partition_date, sum(requests_total) AS total_requests, sum(requests_failed) FILTER (requests_total IS NOT NULL) AS total_requests_failed,
    CASE WHEN sum(requests_total) > 0 THEN round(sum(requests_failed) FILTER (requests_total IS NOT NULL) * 100.0::DOUBLE / sum(requests_total), 2)
      ELSE round(avg(error_rate_pct) FILTER (requests_total IS NOT NULL), 2) END AS avg_error_rate_pct,
    round(avg(requests_per_min) FILTER (requests_total IS NOT NULL), 2) AS avg_requests_per_min FROM site_daily GROUP BY 1) USING (hub_partition_date))
"""
SCRAPER_SPECIAL = {
    "hub_partition_date": "hub_partition_date", "site_id": "site_id", "scraper": "scraper",
    "files_optional": f"coalesce(TRY_CAST({txt('body', '$.files_optional')} AS BOOLEAN), false)",
}
SCRAPER_COLS = ", ".join(f"{SCRAPER_SPECIAL[c]} AS {c}" if c in SCRAPER_SPECIAL else typed("body", c, t) for c, t in table_types("scraper_daily").items())


def sites_of(spark, sf):
    return f.site_daily(docs(spark, sf), registry(spark, sf), FOLDER_DEFAULTS)


def in_utc(df):
    """Timestamps as plain text, so a session zone does not matter to the check."""
    return df.withColumn("generated_at", F.date_format(F.col("generated_at"), "yyyy-MM-dd HH:mm:ss"))


@query("f1_hub_daily", SITES + "SELECT * REPLACE (strftime(generated_at, '%Y-%m-%d %H:%M:%S') AS generated_at) FROM hub_daily")
def f1(spark, sf):
    return in_utc(f.hub_daily(hub_docs(spark, sf), sites_of(spark, sf)))


@query("f2_site_daily", SITES + "SELECT * FROM site_daily")
def f2(spark, sf):
    return sites_of(spark, sf)


@query("f3_scraper_entries", DOCS + f"SELECT hub_partition_date, site_id, scraper, {txt('body', '$.unique_ads')} AS unique_ads FROM sc")
def f3(spark, sf):
    return entries(spark, sf).select("hub_partition_date", "site_id", "scraper", V.text("result", "$.unique_ads").alias("unique_ads"))


@query("f4_scraper_daily", DOCS + f"SELECT {SCRAPER_COLS} FROM sc")
def f4(spark, sf):
    return f.scraper_daily(entries(spark, sf))


@query(
    "f5_scraper_hourly_daily",
    DOCS + f""", h0 AS (SELECT hub_partition_date, site_id, scraper, list_filter([{HOUR_SHAPES}], lambda s: len(s) > 0)[1] AS pairs FROM sc),
    h1 AS (SELECT * EXCLUDE (pairs), unnest(pairs) AS p FROM h0)
    SELECT hub_partition_date, site_id, scraper, CAST(p.h AS INT) AS hour, CAST(sum(p.n) AS INT) AS ads_count FROM h1 GROUP BY 1, 2, 3, 4""",
)
def f5(spark, sf):
    return f.scraper_hourly_daily(entries(spark, sf))


def count_text(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS BIGINT) END"


def title(c: str) -> str:
    pieces = f"regexp_extract_all({c}, '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string(list_transform({pieces}, lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), '')"


RAW_COUNT = "coalesce(i ->> '$.ads_count', i ->> '$.listings_count', i ->> '$.count')"
STEM = "regexp_replace(regexp_extract(fk, '([^/]*)$', 1), '\\.[^.]*$', '')"
PARTS = "list_filter(list_transform(string_split(replace(replace(replace(nm, ' > ', '/'), '::', '/'), ' - ', '/'), '/'), lambda p: trim(p)), lambda p: p <> '')"

SUBCATEGORY = DOCS + f""", told0 AS (SELECT hub_partition_date, site_id, scraper, unnest({elements('body', '$.subcategory_breakdown')}) AS i FROM sc),
told AS (SELECT hub_partition_date, site_id, scraper, trim(coalesce(i ->> '$.subcategory', '')) AS subcategory, trim(coalesce(i ->> '$.level_3', '')) AS level_3,
    coalesce({count_text(RAW_COUNT)}, 0) AS ads_count, coalesce({count_text("(i ->> '$.sheet_rows')")}, {count_text(RAW_COUNT)}, 0) AS sheet_rows,
    coalesce({count_text("(i ->> '$.sheets_count')")}, 1) AS sheets_count, coalesce(nullif(i ->> '$.source', ''), 'json_summary') AS source
  FROM told0 WHERE json_type(i) = 'OBJECT' AND trim(coalesce(i ->> '$.subcategory', '')) <> ''),
files0 AS (SELECT hub_partition_date, site_id, scraper, unnest({elements('body', '$.file_results')}) AS file FROM sc),
files1 AS (SELECT f.hub_partition_date, f.site_id, f.scraper, coalesce(nullif(file ->> '$.file_key', ''), file ->> '$.file', '') AS fk, unnest(json_extract(file, '$.sheets[*]')) AS sheet FROM files0 f),
files2 AS (SELECT *, trim(coalesce(sheet ->> '$.name', '')) AS nm, greatest(coalesce({whole('sheet', '$.row_count')}, 0), 0) AS n, {title(f"trim(replace(replace({STEM}, '_', ' '), '-', ' '))")} AS grp FROM files1),
grouped AS (SELECT hub_partition_date, site_id, scraper, CASE WHEN grp <> '' THEN grp ELSE coalesce({PARTS}[1], nm) END AS subcategory,
    CASE WHEN grp <> '' THEN CASE WHEN lower(nm) IN ({', '.join(f"'{g}'" for g in rules.GENERIC_SHEETS)}) THEN '' ELSE nm END ELSE coalesce({PARTS}[2], '') END AS level_3, n
  FROM files2 WHERE nm <> '' AND lower(nm) NOT IN ('info', 'no data')),
sheets AS (SELECT hub_partition_date, site_id, scraper, subcategory, level_3, sum(n) AS ads_count, sum(n) AS sheet_rows, count(*) AS sheets_count, 'sheet_rows' AS source
  FROM grouped g WHERE NOT EXISTS (SELECT 1 FROM told t WHERE t.hub_partition_date = g.hub_partition_date AND t.site_id = g.site_id AND t.scraper = g.scraper) GROUP BY 1, 2, 3, 4, 5)
"""


@query(
    "f6_scraper_subcategory_daily",
    SUBCATEGORY + """SELECT * REPLACE (CAST(ads_count AS INT) AS ads_count, CAST(sheet_rows AS INT) AS sheet_rows, CAST(sheets_count AS INT) AS sheets_count) FROM (FROM told UNION ALL BY NAME FROM sheets)""",
)
def f6(spark, sf):
    return f.scraper_subcategory_daily(entries(spark, sf))


ALERTS = DOCS + """, al AS (SELECT hub_partition_date, site_id, unnest(json_extract(doc, '$.alerts[*]')) AS a, generate_subscripts(json_extract(doc, '$.alerts[*]'), 1) - 1 AS i FROM sd),
alerts AS (SELECT hub_partition_date, site_id, coalesce(a ->> '$.scraper', '') AS scraper, a ->> '$.severity' AS severity, a ->> '$.type' AS alert_type, a ->> '$.check' AS check_name,
    a ->> '$.detail' AS detail, a ->> '$.file' AS file_key, CAST(hub_partition_date AS VARCHAR) || ':' || site_id || ':' || coalesce(a ->> '$.scraper', '') || ':' || i AS alert_id,
    coalesce(CAST(a ->> '$.solved' AS BOOLEAN), false) AS solved FROM al)
"""


@query("f7_alerts_flat", ALERTS + "SELECT * FROM alerts")
def f7(spark, sf):
    return f.alerts_flat(docs(spark, sf))


@query(
    "f8_uses_proxy",
    DOCS + f", {LOOKUP} SELECT hub_partition_date, s.site_id, {SPECIAL['uses_proxy']} AS uses_proxy FROM sd s LEFT JOIN lastkey a ON a.key = s.site_id LEFT JOIN lastkey b ON b.key = s.folder LEFT JOIN @registry_flat r ON r.seq = coalesce(a.seq, b.seq)",
)
def f8(spark, sf):
    found = f.registry_lookup(docs(spark, sf), registry(spark, sf))
    flag = f.uses_proxy(F.col("site"), F.col("report"), F.col("reg.uses_proxy"))
    return found.select("hub_partition_date", "site_id", flag.alias("uses_proxy"))


CAST_CELL = "CASE o_orderkey % 7 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN '-5' WHEN 2 THEN '3.75' WHEN 3 THEN 'x' WHEN 4 THEN ' 12 ' WHEN 5 THEN '' END"


@query(
    "f9_safe_casts",
    f"""SELECT o_orderkey, {count_text('c')} AS as_int, TRY_CAST(trim(c) AS DOUBLE) AS as_float, CASE WHEN {count_text('c')} >= 0 THEN {count_text('c')} ELSE 9 END AS as_count
    FROM (SELECT o_orderkey, {CAST_CELL} AS c FROM orders)""",
)
def f9(spark, sf):
    cells = source(spark, sf, "orders").selectExpr("o_orderkey", f"{CAST_CELL} AS c")
    return cells.select("o_orderkey", V.safe_int("c").alias("as_int"), V.safe_float("c").alias("as_float"), V.non_negative_int("c", 9).alias("as_count"))


@query("h14_workflow_status", DOCS + f"SELECT hub_partition_date, site_id, {STATUS} AS workflow_status FROM sd")
def h14(spark, sf):
    status = k.workflow_status(F.col("report"), V.text("site", "$.status"))
    return docs(spark, sf).select("hub_partition_date", "site_id", status.alias("workflow_status"))


@query("h15_workflow_duration", DOCS + f"SELECT hub_partition_date, site_id, {DURATION} AS duration_sec FROM sd")
def h15(spark, sf):
    return docs(spark, sf).select("hub_partition_date", "site_id", k.workflow_duration(F.col("report")).alias("duration_sec"))


@query("h17_workflow_label", SITES + "SELECT hub_partition_date, site_id, workflow_name, workflow_run_id FROM site_daily")
def h17(spark, sf):
    found = f.registry_lookup(docs(spark, sf), registry(spark, sf))
    label = k.workflow_label(F.col("report"), k.configured_names("reg."), F.col("reg.workflow_name"))
    return found.select(
        "hub_partition_date", "site_id", label.alias("workflow_name"), k.run_reference(F.col("report"), "workflow_run_id").alias("workflow_run_id")
    )
