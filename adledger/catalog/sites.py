"""Queries over sites, reports, registry and workflow runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger import rules
from adledger.catalog.documents import elements, txt, whole
from adledger.catalog.inputs import SCRAPER_FIELDS, registry, sites, source
from adledger.catalog.registry import query
from adledger.functions import variants as V
from adledger.operators import sites as h
from adledger.operators import workflows as k
from adledger.operators.metrics import result_list, with_report_requests

RUN_DAY = "2001-06-01"
FOLDER_DEFAULTS = {"folder-3": "monthly", "folder-11": "quarterly", "folder-19": "every_2_days"}
VEHICLES = ["folder-2", "folder-5", "folder-8", "folder-24"]

RESULTS = "(CASE json_type(doc, '$.scrapers') WHEN 'ARRAY' THEN json_extract(doc, '$.scrapers[*]') WHEN 'OBJECT' THEN json_extract(doc, '$.scrapers.*') ELSE [] END)"


def over(lst: str, field: str) -> str:
    return f"coalesce(CAST(list_sum(list_transform({lst}, lambda r: coalesce({whole('r', f'$.{field}')}, 0))) AS BIGINT), 0)"


def real(doc: str, path: str) -> str:
    return f"TRY_CAST({txt(doc, path)} AS DOUBLE)"


ADS = f"""coalesce({whole('doc', '$.total_unique_ads')}, {whole('doc', '$.total_ads')},
  CASE WHEN json_type(doc, '$.categories') = 'ARRAY' THEN {over(elements('doc', '$.categories'), 'total_ads')} END, {over(RESULTS, 'unique_ads')})"""
EMPTY = f"""(coalesce({ADS}, 0) = 0 AND coalesce({whole('doc', '$.total_unique_phones')}, {over(RESULTS, 'unique_phones')}) = 0
  AND len(list_filter({RESULTS}, lambda r: coalesce({whole('r', '$.files_found')}, 0) > 0 OR coalesce({whole('r', '$.unique_ads')}, 0) > 0)) = 0
  AND coalesce({whole('doc', '$.r2_daily_size')}, {over(RESULTS, 'r2_daily_size')}) = 0)"""

FACTS = f"""WITH facts0 AS (SELECT site_id, report_date, CASE WHEN json_valid(body) THEN body END AS doc FROM @reports),
facts AS MATERIALIZED (SELECT *, {ADS} AS ads, {EMPTY} AS is_empty FROM facts0 WHERE doc IS NOT NULL)
"""

BLOCKS = ["$", "$.request_metrics", "$.error_summary.http"]


def picked(field: str, kind) -> str:
    cases = " ".join(f"WHEN {whole('doc', f'{b}.requests_total')} IS NOT NULL THEN {kind('doc', f'{b}.{field}')}" for b in BLOCKS)
    return cases


COUNTED = f"list_filter({RESULTS}, lambda r: {whole('r', '$.requests_total')} IS NOT NULL)"
RATES = f"list_filter(list_transform({COUNTED}, lambda r: {real('r', '$.requests_per_min')}), lambda x: x IS NOT NULL)"
LAST = f"""CASE WHEN json_type(doc, '$.error_summary.http') = 'OBJECT' THEN '$.error_summary.http' WHEN json_type(doc, '$.request_metrics') = 'OBJECT' THEN '$.request_metrics' ELSE '$' END"""


def last(field: str, kind) -> str:
    cases = " ".join(f"WHEN json_type(doc, '{b}') = 'OBJECT' THEN {kind('doc', f'{b}.{field}')}" for b in reversed(BLOCKS))
    return f"CASE {cases} END"


def requests(src: str) -> str:
    return f"""req0 AS (SELECT *, {COUNTED} AS counted FROM {src}),
req1 AS (SELECT *, CASE {picked('requests_total', whole)} WHEN len(counted) > 0 THEN {over('counted', 'requests_total')} END AS requests_total,
    CASE {picked('requests_failed', whole)} WHEN len(counted) > 0 THEN {over('counted', 'requests_failed')} ELSE {last('requests_failed', whole)} END AS failed0,
    CASE {picked('error_rate_pct', real)} WHEN len(counted) > 0 THEN CASE WHEN {over('counted', 'requests_total')} > 0
      THEN round({over('counted', 'requests_failed')} * 100.0::DOUBLE / {over('counted', 'requests_total')}, 2) END ELSE {last('error_rate_pct', real)} END AS err0,
    CASE {picked('requests_per_min', real)} WHEN len(counted) > 0 THEN round(list_avg({RATES}), 2) ELSE {last('requests_per_min', real)} END AS requests_per_min FROM req0),
req AS (SELECT * EXCLUDE (failed0, err0, counted), coalesce(failed0, CASE WHEN requests_total IS NOT NULL THEN 0 END) AS requests_failed,
    coalesce(err0, CASE WHEN requests_total > 0 THEN round(coalesce(failed0, 0) * 100.0::DOUBLE / requests_total, 2) END) AS error_rate_pct FROM req1)"""


SCHEDULE = "regexp_replace(lower(nullif(schedule, '')), '[ -]', '_', 'g')"
BY_FOLDER = "CASE lower(coalesce(nullif(folder, ''), site_id)) " + " ".join(f"WHEN '{f}' THEN '{s}'" for f, s in FOLDER_DEFAULTS.items()) + " END"
LOOKBACK = "CASE schedule_name " + " ".join(f"WHEN '{s}' THEN {d}" for s, d in rules.REPORT_LOOKBACK_DAYS.items()) + f" ELSE {rules.REPORT_LOOKBACK_DEFAULT} END"
NON_DAILY = ", ".join(f"'{s}'" for s in rules.NON_DAILY_SCHEDULES)

POLICY = f"""pol0 AS (SELECT *, coalesce({SCHEDULE}, {BY_FOLDER}, 'daily') AS schedule_name FROM @registry_flat),
pol AS (SELECT *, CASE WHEN report_fallback IN ('true', 'latest') THEN true WHEN report_fallback = 'false' THEN false ELSE schedule_name IN ({NON_DAILY}) END AS allows_fallback,
    CAST(coalesce(report_lookback_days, {LOOKBACK}) AS INT) AS lookback_days FROM pol0)"""

DAYS = "range((SELECT min(report_date) FROM facts), (SELECT max(report_date) FROM facts) + 1, INTERVAL 1 DAY)"
CHOSEN = FACTS + f""", narrow AS MATERIALIZED (SELECT site_id, report_date, is_empty FROM facts), {POLICY},
policy AS MATERIALIZED (SELECT * FROM pol),
days AS MATERIALIZED (SELECT DISTINCT site_id, allows_fallback, lookback_days, CAST(d AS DATE) AS hub_date FROM policy, {DAYS} t(d)),
older AS MATERIALIZED (SELECT a.site_id, a.lookback_days, a.hub_date, max(f.report_date) AS last FROM days a JOIN narrow f ON f.site_id = a.site_id AND f.report_date < a.hub_date
    AND f.report_date >= a.hub_date - a.lookback_days AND NOT f.is_empty WHERE a.allows_fallback GROUP BY 1, 2, 3),
asked AS (SELECT policy.*, CAST(d AS DATE) AS hub_date FROM policy, {DAYS} t(d)),
chosen AS (SELECT a.*, t.site_id IS NOT NULL AS has_today, coalesce(t.is_empty, true) AND a.allows_fallback AND o.last IS NOT NULL AS report_fallback_used,
    CASE WHEN coalesce(t.is_empty, true) AND a.allows_fallback AND o.last IS NOT NULL THEN o.last WHEN t.site_id IS NOT NULL THEN a.hub_date END AS report_date
  FROM asked a LEFT JOIN narrow t ON t.site_id = a.site_id AND t.report_date = a.hub_date
    LEFT JOIN older o ON o.site_id = a.site_id AND o.hub_date = a.hub_date AND o.lookback_days = a.lookback_days)
"""

PASSED = f"len(list_filter({RESULTS}, lambda r: {txt('r', '$.all_passed')} = 'true'))"


def told(field: str, report_field: str) -> str:
    return f"coalesce({whole('doc', f'$.{report_field}')}, {over(RESULTS, field)}) AS {field}"


TOLD = [(c, f"total_{c}") for c in h.PHONE_COUNTS]
TOLD += [("r2_file_count", "total_r2_files"), ("r2_size_bytes", "total_r2_size_bytes"), ("r2_daily_size", "r2_daily_size")]
TOLD += [(f"r2_{c}_bytes", f"total_r2_{c}_bytes") for c in rules.STORAGE_CATEGORIES]
TOLD += [(f"r2_daily_{c}_bytes", f"total_r2_daily_{c}_bytes") for c in rules.STORAGE_CATEGORIES]
NAME = "trim(coalesce(d_display_name, nullif(c.display_name, ''), nullif(c.folder, '')))"
VEHICLE_LIST = ", ".join(f"'{v}'" for v in VEHICLES)

SUMMARY = CHOSEN + f""", {requests('facts')},
rf AS MATERIALIZED (SELECT site_id, report_date, {', '.join(f"nullif({txt('doc', f'$.{c}')}, '') AS d_{c}" for c in ('display_name', 'website', 'country', 'repo'))},
    {txt('doc', '$.run_date')} AS d_run_date, {txt('doc', '$.inspect_date')} AS d_inspect_date, len({RESULTS}) AS reported, {PASSED} AS passed, {txt('doc', '$.overall_pass')} AS overall,
    json_exists(doc, '$.total_ads') AS has_total, coalesce({whole('doc', '$.alert_count')}, CASE WHEN json_type(doc, '$.alerts') = 'ARRAY' THEN json_array_length(doc, '$.alerts') END, 0) AS alerts,
    ads, {', '.join(told(*p) for p in TOLD)}, requests_total, requests_failed, error_rate_pct, requests_per_min FROM req),
tot AS (SELECT c.hub_date, c.site_id, c.folder, c.seq, CASE WHEN trim(c.folder) IN ({VEHICLE_LIST}) THEN CASE WHEN lower({NAME}) LIKE '%(automotive)' THEN {NAME} ELSE lower({NAME}) || ' (automotive)' END ELSE {NAME} END AS display_name,
    coalesce(d_website, c.website) AS website, coalesce(d_country, c.country) AS country, coalesce(d_repo, c.repo) AS repo, c.uses_proxy, report_fallback_used AS report_fallback,
    coalesce(d_run_date, CAST(coalesce(c.report_date, c.hub_date) AS VARCHAR)) AS run_date, d_inspect_date AS inspect_date, f.site_id IS NULL AS none, reported, passed, overall, has_total,
    CASE WHEN reported > 0 THEN reported ELSE coalesce(c.scrapers, 0) END AS total0, coalesce(alerts, 0) AS alert_count, coalesce(ads, 0) AS unique_ads,
    {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c, _ in TOLD)}, requests_total, requests_failed, error_rate_pct, requests_per_min
  FROM chosen c LEFT JOIN rf f ON f.site_id = c.site_id AND f.report_date = c.report_date),
sm AS (SELECT *, CASE WHEN none THEN 0 ELSE total0 END AS scrapers_total,
    CASE WHEN none THEN 0 WHEN reported = 0 AND total0 > 0 AND overall = 'false' THEN 0
      WHEN reported = 0 AND total0 > 0 AND (requests_total IS NOT NULL OR has_total) THEN total0 ELSE passed END AS scrapers_passed FROM tot),
summary AS (SELECT *, CASE WHEN none THEN 'missing' WHEN scrapers_passed = scrapers_total AND scrapers_total > 0 THEN 'ok' ELSE 'failed' END AS status,
    CASE WHEN NOT none THEN greatest(scrapers_total - scrapers_passed, 0) END AS scrapers_failed FROM sm)
"""
SUMMARY_COLS = (
    ["seq", "hub_date", "site_id", "folder", "display_name", "website", "country", "repo", "uses_proxy", "report_fallback", "run_date", "inspect_date", "scrapers_total",
     "scrapers_passed", "alert_count", "unique_ads"] + [c for c, _ in TOLD]
    + ["requests_total", "requests_failed", "error_rate_pct", "requests_per_min", "status", "scrapers_failed"]
)


def policy(spark, sf):
    return h.fallback_policy(registry(spark, sf), FOLDER_DEFAULTS)


def facts(spark, sf):
    return h.report_facts(source(spark, sf, "reports"))


def summarized(spark, sf, documents: bool = False):
    return h.summarized_reports(facts(spark, sf), documents)


def chosen(spark, sf, reports=None):
    """Every registry row on every day from the first report to the last."""
    start, end = source(spark, sf, "reports").agg(F.min("report_date").cast("string"), F.max("report_date").cast("string")).first()
    return h.latest_usable_report(h.asked_days(policy(spark, sf), start, end), summarized(spark, sf) if reports is None else reports)


def summary(spark, sf, documents: bool = False):
    return h.summarize_site(chosen(spark, sf, summarized(spark, sf, documents)), VEHICLES)


@query("m7_report_request_metrics", FACTS + f", {requests('facts')} SELECT site_id, report_date, requests_total, requests_failed, error_rate_pct, requests_per_min FROM req")
def m7(spark, sf):
    found = with_report_requests(facts(spark, sf), "doc")
    return found.select("site_id", "report_date", "requests_total", "requests_failed", "error_rate_pct", "requests_per_min")


H1_STORE = ["r2_file_count", "r2_size_bytes"] + [f"r2_{c}_bytes" for c in rules.STORAGE_CATEGORIES]


@query(
    "h1_site_report",
    f"""WITH g AS (SELECT site_id, count(*) AS scrapers_total, count(*) FILTER (all_passed) AS scrapers_passed,
      {', '.join(f'CAST(sum({c}) AS BIGINT) AS total_{c}' for c in SCRAPER_FIELDS)} FROM @scraper_totals GROUP BY 1)
    SELECT g.* REPLACE ({', '.join(f'coalesce(s.{c}, total_{c}) AS total_{c}' for c in H1_STORE)}) FROM g LEFT JOIN @site_storage s USING (site_id)""",
)
def h1(spark, sf):
    return h.site_report(source(spark, sf, "scraper_totals"), source(spark, sf, "site_storage"))


@query("h2_normalize_schedule", f"WITH {POLICY} SELECT site_id, schedule_name FROM pol")
def h2(spark, sf):
    folder = F.coalesce(F.nullif("folder", F.lit("")), F.col("site_id"))
    named = h.normalize_schedule(F.col("schedule"), folder, FOLDER_DEFAULTS)
    return source(spark, sf, "registry_flat").select("site_id", named.alias("schedule_name"))


@query("h3_fallback_policy", f"WITH {POLICY} SELECT site_id, allows_fallback, lookback_days FROM pol")
def h3(spark, sf):
    return policy(spark, sf).select("site_id", "allows_fallback", "lookback_days")


@query("h4_report_is_empty", FACTS + "SELECT site_id, report_date, is_empty FROM facts")
def h4(spark, sf):
    return facts(spark, sf).select("site_id", "report_date", "is_empty")


@query("h5_unique_ads_of_report", FACTS + "SELECT site_id, report_date, ads FROM facts")
def h5(spark, sf):
    return facts(spark, sf).select("site_id", "report_date", h.unique_ads_of_report(F.col("doc"), result_list(F.col("doc"))).alias("ads"))


@query("h6_latest_usable_report", CHOSEN + "SELECT seq, site_id, hub_date, report_date, report_fallback_used AS report_fallback, CASE WHEN report_date IS NOT NULL THEN true END AS found FROM chosen")
def h6(spark, sf):
    reports = facts(spark, sf).select("site_id", "report_date", "is_empty", F.lit(True).alias("found"))
    return chosen(spark, sf, reports).select("seq", "site_id", "hub_date", "report_date", "report_fallback", "found")


@query("h7_summarize_site", SUMMARY + f"SELECT {', '.join(SUMMARY_COLS)} FROM summary")
def h7(spark, sf):
    return summary(spark, sf).select(*SUMMARY_COLS)


@query(
    "h8_display_label",
    f"""SELECT site_id, seq, CASE WHEN folder IN ({VEHICLE_LIST}) THEN CASE WHEN lower(trim(nm)) LIKE '%(automotive)' THEN trim(nm) ELSE lower(trim(nm)) || ' (automotive)' END ELSE trim(nm) END AS label
    FROM (SELECT *, display_name || CASE WHEN seq % 2 = 0 THEN ' (Automotive)' ELSE ' ' END AS nm FROM @registry_flat)""",
)
def h8(spark, sf):
    name = F.concat("display_name", F.when(F.col("seq") % 2 == 0, " (Automotive)").otherwise(" "))
    label = h.display_label(name, F.col("folder"), VEHICLES)
    return source(spark, sf, "registry_flat").select("site_id", "seq", label.alias("label"))


SUMMED = [c for c, _ in TOLD]
TOTAL_NAMES = {"r2_file_count": "total_r2_files"}


@query(
    "h9_hub_rollup",
    SUMMARY + f"""SELECT hub_date, count(*) AS sites_total, count(*) FILTER (status = 'ok') AS sites_ok, count(*) FILTER (status = 'failed') AS sites_failed,
      count(*) FILTER (status = 'missing') AS sites_missing, CAST(sum(alert_count) AS BIGINT) AS total_alerts, CAST(sum(unique_ads) AS BIGINT) AS total_unique_ads,
      {', '.join(f"CAST(sum({c}) AS BIGINT) AS {TOTAL_NAMES.get(c, f'total_{c}')}" for c in SUMMED)},
      nullif(CAST(sum(requests_total) AS BIGINT), 0) AS total_requests, nullif(CAST(sum(requests_failed) FILTER (requests_total <> 0) AS BIGINT), 0) AS total_requests_failed,
      CASE WHEN sum(requests_total) > 0 THEN round(coalesce(sum(requests_failed) FILTER (requests_total <> 0), 0) * 100.0::DOUBLE / sum(requests_total), 2) END AS avg_error_rate_pct,
      ((2 * sum(CAST(round(requests_per_min * 1000000) AS BIGINT)) + count(requests_per_min) * 10000) // (2 * nullif(count(requests_per_min), 0) * 10000)) / 100.0::DOUBLE AS avg_requests_per_min
    FROM summary GROUP BY 1""",
)
def h9(spark, sf):
    return h.hub_rollup(summary(spark, sf))


@query(
    "h10_hub_request_totals",
    FACTS + f""", {requests('facts')} SELECT report_date, CAST(sum(requests_total) AS BIGINT) AS total_requests,
      CASE WHEN count(requests_total) > 0 THEN CAST(sum(requests_failed) FILTER (requests_total IS NOT NULL) AS BIGINT) END AS total_requests_failed,
      CASE WHEN sum(requests_total) > 0 THEN round(sum(requests_failed) FILTER (requests_total IS NOT NULL) * 100.0::DOUBLE / sum(requests_total), 2)
        ELSE round(avg(error_rate_pct) FILTER (requests_total IS NOT NULL), 2) END AS avg_error_rate_pct,
      round(avg(requests_per_min) FILTER (requests_total IS NOT NULL), 2) AS avg_requests_per_min FROM req GROUP BY 1""",
)
def h10(spark, sf):
    return h.hub_request_totals(with_report_requests(facts(spark, sf), "doc"), "report_date")


FILL = {"workflows": "workflows", "uses_proxy": "uses_proxy"}


def filled(c: str) -> str:
    own = f"s.{c}" if c == "uses_proxy" else f"nullif(s.{c}, '')"
    return f"coalesce({own}, r.{c}, s.{c}) AS {c}"


@query(
    "h11_overlay_registry",
    f"""WITH hit AS (SELECT s.site_id, r.seq, row_number() OVER (PARTITION BY s.site_id ORDER BY r.seq) AS rn FROM @sites_flat s JOIN @registry_flat r
      ON (s.folder = r.folder AND s.folder <> '') OR (s.site_id = r.site_id AND s.site_id <> ''))
    SELECT s.site_id, {', '.join(filled(c) for c in h.REGISTRY_FILL)} FROM @sites_flat s LEFT JOIN hit ON hit.site_id = s.site_id AND rn = 1 LEFT JOIN @registry_flat r ON r.seq = hit.seq""",
)
def h11(spark, sf):
    filled_in = h.overlay_registry(sites(spark, sf), registry(spark, sf))
    return filled_in.select("site_id", *h.REGISTRY_FILL).withColumn("workflows", F.array_join("workflows", "|"))


LOOKUP = """keyed AS (SELECT site_id AS key, seq FROM @registry_flat WHERE site_id <> '' UNION ALL SELECT folder, seq FROM @registry_flat WHERE folder <> ''),
lastkey AS (SELECT key, max(seq) AS seq FROM keyed GROUP BY 1)"""


@query(
    "h12_registry_lookup",
    f"""WITH {LOOKUP} SELECT s.site_id, r.seq, r.repo, r.schedule FROM @sites_flat s LEFT JOIN lastkey a ON a.key = s.site_id LEFT JOIN lastkey b ON b.key = s.folder
    LEFT JOIN @registry_flat r ON r.seq = coalesce(a.seq, b.seq)""",
)
def h12(spark, sf):
    found = h.registry_lookup(source(spark, sf, "sites_flat").select("site_id", "folder"), source(spark, sf, "registry_flat"))
    return found.select("site_id", "reg.seq", "reg.repo", "reg.schedule")


def monitor(c: str) -> str:
    return f"""coalesce({c} <> '' AND ({c} IN ('R2 CSV Monitor', 'Monitor Categories', 'monitor') OR {c} LIKE 'Monitor Hub%' OR lower({c}) LIKE '%schema monitor%' OR lower({c}) LIKE '% r2 monitor'), false)"""


def split_names(c: str) -> str:
    parts = f"string_split(replace(replace({c}, '→', ','), '->', ','), ',')"
    return f"list_filter(list_transform({parts}, lambda p: trim(trim(trim(p), '\"'), '''')), lambda n: n <> '' AND NOT {monitor('n')})"


CONFIGURED = f"""CASE WHEN coalesce(trim(github_username), '') = '' OR coalesce(trim(repo), '') = '' THEN []
  WHEN workflows IS NOT NULL THEN flatten(list_transform(string_split(workflows, '|'), lambda w: {split_names('w')}))
  WHEN workflow_name IS NOT NULL AND NOT {monitor('workflow_name')} THEN {split_names('workflow_name')} ELSE [] END"""


@query("h13_is_monitor_workflow", f"SELECT name, {monitor('name')} AS is_monitor, count(*) AS n FROM @runs GROUP BY 1, 2")
def h13(spark, sf):
    runs = source(spark, sf, "runs").select("name", k.is_monitor_workflow("name").alias("is_monitor"))
    return runs.groupBy("name", "is_monitor").agg(F.count(F.lit(1)).alias("n"))


@query("h13_workflow_names", f"SELECT seq, CASE WHEN len(c) > 0 THEN array_to_string(c, ' → ') END AS names FROM (SELECT seq, {CONFIGURED} AS c FROM @registry_flat)")
def h13_names(spark, sf):
    return registry(spark, sf).select("seq", k.join_names(k.configured_names()).alias("names"))


RUN_LOOKBACK = "CASE regexp_replace(lower(coalesce(schedule, 'daily')), '[ -]', '_', 'g') " + " ".join(
    f"WHEN '{s}' THEN {d}" for s, d in rules.RUN_LOOKBACK_DAYS.items()
) + f" ELSE {rules.RUN_LOOKBACK_DEFAULT} END"
RUNS = f"""WITH conf AS (SELECT *, {CONFIGURED} AS names FROM @registry_flat),
wanted AS (SELECT site_id, trim(github_username) AS owner, trim(repo) AS repo, DATE '{RUN_DAY}' - CAST({RUN_LOOKBACK} AS INT) AS not_before,
    unnest(names) AS name, generate_subscripts(names, 1) - 1 AS pos FROM conf),
fit AS (SELECT w.site_id, w.pos, r.*, row_number() OVER (PARTITION BY w.site_id, w.pos ORDER BY run_started_at DESC, run_id DESC) AS rn
  FROM wanted w JOIN @runs r ON r.owner = w.owner AND r.repo = w.repo AND r.name = w.name AND r.status = 'completed' AND r.run_started_at >= w.not_before),
found AS (SELECT * FROM fit WHERE rn = 1)
"""


@query("h16_latest_run", RUNS + "SELECT site_id, CAST(pos AS INT) AS pos, owner, repo, name, run_id, run_number, conclusion, duration_sec, CAST(run_started_at AS VARCHAR) AS run_started_at FROM found")
def h16(spark, sf):
    wanted = k.wanted_runs(registry(spark, sf), RUN_DAY)
    found = k.latest_run(source(spark, sf, "runs"), wanted)
    return found.withColumn("run_started_at", F.col("run_started_at").cast("string"))


@query(
    "h18_pipeline_run_meta",
    RUNS + f""", g AS (SELECT site_id, list(name ORDER BY pos) AS names, bool_or(conclusion NOT IN ('success', 'skipped', 'cancelled')) AS bad,
      CAST(sum(duration_sec) AS BIGINT) AS duration_sec, arg_max(run_id, pos) AS run_id, arg_max(run_number, pos) AS run_number FROM found GROUP BY 1)
    SELECT c.site_id, CASE WHEN g.site_id IS NOT NULL THEN array_to_string(CASE WHEN len(g.names) = len(c.names) THEN g.names ELSE c.names END, ' → ')
        WHEN len(c.names) > 0 THEN array_to_string(c.names, ' → ') WHEN workflow_name <> '' AND NOT {monitor('workflow_name')} THEN workflow_name ELSE '—' END AS workflow_name,
      CASE WHEN g.site_id IS NOT NULL THEN CASE WHEN coalesce(bad, false) THEN 'failure' ELSE 'success' END END AS workflow_status, duration_sec, CAST(run_id AS VARCHAR) AS workflow_run_id,
      run_number AS workflow_run_number, CASE WHEN g.site_id IS NOT NULL THEN 'run_table' ELSE 'registry_fallback' END AS source FROM conf c LEFT JOIN g USING (site_id)""",
)
def h18(spark, sf):
    return k.pipeline_run_meta(source(spark, sf, "runs"), registry(spark, sf), RUN_DAY)
