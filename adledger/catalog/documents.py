"""Queries over summary and scraper documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger import rules
from adledger.catalog.inputs import sheet_rows, source
from adledger.catalog.registry import query
from adledger.catalog.validation import A2
from adledger.functions import variants as V
from adledger.operators import ads
from adledger.operators import metrics as m
from adledger.operators.ordering import keep_rows


def num(doc: str, path: str) -> str:
    return f"CASE WHEN json_type({doc}, '{path}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(json_extract_string({doc}, '{path}') AS DOUBLE) END"


def cnt(doc: str, path: str) -> str:
    return f"CASE WHEN {num(doc, path)} >= 0 THEN CAST(trunc({num(doc, path)}) AS BIGINT) END"


def measure(doc: str, path: str) -> str:
    return f"CASE WHEN {num(doc, path)} >= 0 THEN {num(doc, path)} END"


def txt(doc: str, path: str) -> str:
    return f"json_extract_string({doc}, '{path}')"


def first(fn, doc: str, keys: list[str], prefixes: tuple[str, ...] = ("$",)) -> str:
    return "coalesce(" + ", ".join(fn(doc, f"{p}.{k}") for p in prefixes for k in keys) + ")"


def first_text(doc: str, keys: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(trim({txt(doc, f'$.{k}')}), '')" for k in keys) + ")"


def elements(doc: str, path: str) -> str:
    """List elements as rows; nothing when the path holds no list."""
    return f"CASE WHEN json_type({doc}, '{path}') = 'ARRAY' THEN json_extract({doc}, '{path}[*]') ELSE [] END"


def all_elements(doc: str, keys: list[str]) -> str:
    return "flatten([" + ", ".join(elements(doc, f"$.{k}") for k in keys) + "])"


DOCS = "docs AS (SELECT scraper, key, prefix_form, CASE WHEN json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT' THEN body END AS doc FROM @summary_docs)"

SUMMARY = f"""WITH {DOCS},
it AS (SELECT key, unnest({all_elements('doc', rules.TOTAL_LISTS)}) AS i FROM docs WHERE doc IS NOT NULL),
itn AS (SELECT key, {first(cnt, 'i', rules.TOTAL_KEYS)} AS t, CAST(trunc({num('i', '$.listings')}) AS BIGINT) AS l FROM it WHERE json_type(i) = 'OBJECT'),
nested AS (SELECT key, CAST(sum(coalesce(t, 0) + coalesce(l, 0)) AS BIGINT) AS nested FROM itn WHERE t IS NOT NULL OR l IS NOT NULL GROUP BY 1),
totals AS (SELECT scraper, d.key, prefix_form, coalesce({first(cnt, 'doc', rules.TOTAL_KEYS)}, nested) AS total FROM docs d LEFT JOIN nested n ON n.key = d.key),
bi AS (SELECT scraper, key, unnest({all_elements('doc', rules.BREAKDOWN_LISTS)}) AS i FROM docs WHERE doc IS NOT NULL),
bc AS (SELECT scraper, key, i, {first_text('i', rules.CATEGORY_NAME_KEYS)} AS name, {first(cnt, 'i', rules.BREAKDOWN_COUNT_KEYS)} AS n,
    CASE WHEN len({elements('i', '$.subcategories')}) > 0 THEN {elements('i', '$.subcategories')}
      WHEN len({elements('i', '$.brands')}) > 0 THEN {elements('i', '$.brands')} ELSE {elements('i', '$.models')} END AS ch
  FROM bi WHERE json_type(i) = 'OBJECT'),
br AS (SELECT scraper, key, coalesce(name, '(unknown)') AS subcategory, {first_text('c', rules.CHILD_NAME_KEYS)} AS level_3,
    coalesce({first(cnt, 'c', rules.BREAKDOWN_COUNT_KEYS)}, 0) AS n FROM (SELECT *, unnest(ch) AS c FROM bc) WHERE json_type(c) = 'OBJECT'
  UNION ALL SELECT scraper, key, name, '', n FROM bc
    WHERE len(list_filter(ch, lambda c: json_type(c) = 'OBJECT')) = 0 AND name IS NOT NULL AND n IS NOT NULL),
breakdown AS (SELECT scraper, key, subcategory, level_3, CAST(sum(n) AS BIGINT) AS ads_count, CAST(sum(n) AS BIGINT) AS sheet_rows, count(*) AS sheets_count,
    'json_summary' AS source FROM br WHERE level_3 IS NOT NULL GROUP BY 1, 2, 3, 4),
best AS (SELECT t.scraper, max(total) AS json_total, arg_min(t.key, (-total, prefix_form, t.key)) FILTER (total IS NOT NULL) AS json_key,
    arg_min(t.key, (prefix_form, t.key)) FILTER (total IS NULL AND b.key IS NOT NULL) AS rows_key
  FROM totals t LEFT JOIN (SELECT DISTINCT key FROM breakdown) b ON b.key = t.key GROUP BY 1)
"""


@query("a3_summary_total", SUMMARY + "SELECT key, total FROM totals")
def a3(spark, sf):
    docs = source(spark, sf, "summary_docs").select("key", V.parse("body").alias("doc"))
    return docs.select("key", ads.summary_total(F.col("doc")).alias("total"))


@query("a4_best_summary", SUMMARY + "SELECT scraper, json_total, json_key, coalesce(json_key, rows_key) AS breakdown_key FROM best")
def a4(spark, sf):
    return ads.best_summary(source(spark, sf, "summary_docs"))


@query("a5_subcategory_breakdown", SUMMARY + "SELECT * FROM breakdown")
def a5(spark, sf):
    return ads.subcategory_breakdown(source(spark, sf, "summary_docs"))


def by_event_type(spark, sf):
    """Summaries given to the scrapers of the sheet rows, so both counts meet."""
    names = F.array(*[F.lit(n) for n in ("click", "error", "signup", "absent-ok-africa", "absent-bad-america")])
    pick = F.element_at(names, (F.pmod(F.length("scraper") + F.length("body"), F.lit(5)) + 1).cast("int"))
    return source(spark, sf, "summary_docs").withColumn("scraper", pick)


A6_DOCS = SUMMARY.replace(
    "FROM @summary_docs", "FROM (SELECT * EXCLUDE (scraper), ['click', 'error', 'signup', 'absent-ok-africa', 'absent-bad-america'][CAST((length(scraper) + length(body)) % 5 + 1 AS INT)] AS scraper FROM @summary_docs)"
)


@query(
    "a6_resolve_ad_count",
    A2 + ", " + A6_DOCS[len("WITH "):] + """SELECT scraper, CASE WHEN ads_source <> 'excel_ids' AND json_total IS NOT NULL THEN json_total ELSE unique_ads END AS unique_ads,
      CASE WHEN ads_source <> 'excel_ids' AND json_total IS NOT NULL AND total_rows = 0 THEN json_total ELSE total_rows END AS total_rows,
      CASE WHEN ads_source <> 'excel_ids' AND json_total IS NOT NULL THEN 'json_summary' ELSE ads_source END AS ads_source, json_key AS json_summary_key
    FROM a2 LEFT JOIN best USING (scraper)""",
)
def a6(spark, sf):
    counted = ads.count_ads(sheet_rows(spark, sf), source(spark, sf, "scrapers_flat"))
    return ads.resolve_ad_count(counted, ads.best_summary(by_event_type(spark, sf)))


def whole(doc: str, path: str) -> str:
    return f"CASE WHEN json_type({doc}, '{path}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(trunc(CAST({txt(doc, path)} AS DOUBLE)) AS BIGINT) WHEN regexp_full_match(trim({txt(doc, path)}), '[+-]?[0-9]+') THEN TRY_CAST(trim({txt(doc, path)}) AS BIGINT) END"


def hour_list(path: str) -> str:
    pair = f"{{'h': {whole('x', '$.hour')}, 'n': greatest(0, coalesce(CASE WHEN json_exists(x, '$.ads_count') THEN {whole('x', '$.ads_count')} ELSE {whole('x', '$.count')} END, 0))}}"
    return f"list_filter(list_transform(list_filter({elements('body', path)}, lambda o: json_type(o) = 'OBJECT'), lambda x: {pair}), lambda p: p.h BETWEEN 0 AND 23)"


def hour_map(path: str) -> str:
    hour = "CASE WHEN regexp_full_match(k, '[+-]?[0-9]+') THEN CAST(k AS BIGINT) END"
    value = f"json_extract(body, '{path}.\"' || k || '\"')"
    n = f"CASE WHEN json_type({value}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(trunc(CAST({value} AS DOUBLE)) AS BIGINT) ELSE TRY_CAST(json_extract_string({value}, '$') AS BIGINT) END"
    keys = f"CASE WHEN json_type(body, '{path}') = 'OBJECT' THEN json_keys(body, '{path}') ELSE [] END"
    return f"list_filter(list_transform({keys}, lambda k: {{'h': {hour}, 'n': greatest(0, coalesce({n}, 0))}}), lambda p: p.h BETWEEN 0 AND 23)"


HOUR_PATHS = [f"$.{k}" for k in rules.HOUR_LIST_KEYS] + [f"$.{c}.{k}" for c in rules.HOUR_CONTAINERS for k in rules.HOUR_LIST_KEYS]
MAP_PATHS = [f"$.{k}" for k in rules.HOUR_MAP_KEYS] + [f"$.{c}.{k}" for c in rules.HOUR_CONTAINERS for k in rules.HOUR_MAP_KEYS]
HOUR_SHAPES = ", ".join([hour_list(p) for p in HOUR_PATHS] + [hour_map(p) for p in MAP_PATHS])


@query(
    "a8_hour_counts_from_report",
    f"""WITH s AS (SELECT c_custkey, list_filter([{HOUR_SHAPES}], lambda s: len(s) > 0)[1] AS pairs FROM @scraper_result_docs),
    p AS (SELECT c_custkey, unnest(pairs) AS p FROM s)
    SELECT c_custkey, CAST(p.h AS INT) AS hour, CAST(sum(p.n) AS BIGINT) AS ads_count FROM p GROUP BY 1, 2""",
)
def a8(spark, sf):
    results = source(spark, sf, "scraper_result_docs").select("c_custkey", V.parse("body").alias("result"))
    return ads.hour_counts_from_report(results)


# --- request metrics ------------------------------------------------------------------------------------

LAYERS = ("$.request_metrics", "$", "$.stats")


def error_count(doc: str, keys: list[str]) -> str:
    parts = []
    for k in keys:
        p = f"$.{k}"
        parts.append(
            f"CASE WHEN json_type({doc}, '{p}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN nullif(CAST(trunc({num(doc, p)}) AS BIGINT), 0) "
            f"WHEN json_type({doc}, '{p}') = 'VARCHAR' AND {txt(doc, p)} <> '' THEN coalesce(TRY_CAST({txt(doc, p)} AS BIGINT), 1) "
            f"WHEN json_type({doc}, '{p}') = 'ARRAY' AND json_array_length({doc}, '{p}') > 0 THEN 1 END"
        )
    return "coalesce(" + ", ".join(parts) + ")"


def named(doc: str, keys: list[str], default: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({txt(doc, f'$.{k}')}, '')" for k in keys) + f", '{default}')"


def detail(doc: str, keys: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif({txt(doc, f'$.{k}')}, '')" for k in keys) + ")"


def failed_layer(place: int, layer: str) -> str:
    own = elements("doc", f"{layer}.failed_items")
    items = f"CASE WHEN len({own}) > 0 THEN {own} ELSE {elements('doc', f'{layer}.failed_scrapers')} END"
    return f"""SELECT key, {place}0 AS part, i, generate_subscripts AS pos, {named('i', ['name', 'scraper', 'slug', 'category'], 'unknown')} AS name,
        coalesce({error_count('i', ['errors', 'error_count'])}, 1) AS errors, {detail('i', ['detail', 'reason', 'message'])} AS detail
      FROM (SELECT key, unnest({items}) AS i, generate_subscripts({items}, 1) AS generate_subscripts FROM docs) WHERE json_type(i) = 'OBJECT'
      UNION ALL SELECT key, {place}1, i, pos, CASE WHEN json_type(i) = 'VARCHAR' THEN json_extract_string(i, '$') ELSE {named('i', ['name', 'scraper', 'slug'], 'error')} END,
        CASE WHEN json_type(i) = 'VARCHAR' THEN 1 ELSE coalesce({error_count('i', ['count'])}, 1) END,
        CASE WHEN json_type(i) = 'OBJECT' THEN {detail('i', ['detail', 'message', 'reason'])} END
      FROM (SELECT key, unnest({elements('doc', f'{layer}.errors')}) AS i, generate_subscripts({elements('doc', f'{layer}.errors')}, 1) AS pos FROM docs)
      WHERE json_type(i) IN ('VARCHAR', 'OBJECT')"""


GROUPS = f"CASE WHEN len({elements('doc', '$.subcategories')}) > 0 THEN {elements('doc', '$.subcategories')} ELSE {elements('doc', '$.categories')} END"
METRICS = f"""WITH {DOCS},
raw AS ({' UNION ALL '.join(failed_layer(i + 1, layer) for i, layer in enumerate(LAYERS))}
  UNION ALL SELECT key, 90, i, pos, {named('i', ['name_en', 'name_ar', 'name', 'slug'], 'subcategory')}, {error_count('i', ['errors', 'error_count'])}, NULL
    FROM (SELECT key, unnest({GROUPS}) AS i, generate_subscripts({GROUPS}, 1) AS pos FROM docs) WHERE json_type(i) = 'OBJECT' AND {error_count('i', ['errors', 'error_count'])} IS NOT NULL),
items AS (SELECT key, name, errors, detail, min(part * 1000 + pos) AS place FROM raw WHERE name <> '' AND (errors > 0 OR detail IS NOT NULL) GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY place) AS rn FROM items),
lines AS (SELECT key, count(*) AS n, CAST(sum(errors) AS BIGINT) AS errors,
    string_agg(name || ': ' || errors || ' error(s)' || coalesce(' (' || detail || ')', ''), '; ' ORDER BY rn) FILTER (rn <= 12) AS head FROM ranked GROUP BY 1),
texts AS (SELECT key, n, errors, substr(head || CASE WHEN n > 12 THEN '; +' || (n - 12) || ' more' ELSE '' END, 1, 400) AS summary FROM lines),
base AS (SELECT scraper, d.key, prefix_form, {first(cnt, 'doc', rules.REQUEST_TOTAL_KEYS, LAYERS)} AS total, {first(cnt, 'doc', rules.REQUEST_FAILED_KEYS, LAYERS)} AS failed,
    {first(measure, 'doc', rules.DURATION_KEYS, LAYERS)} AS duration_sec, {first(measure, 'doc', rules.RPM_KEYS, LAYERS)} AS rpm,
    {first(cnt, 'doc', rules.CACHE_KEYS, LAYERS)} AS cache_hits, coalesce(n, 0) AS items, coalesce(errors, 0) AS errors, summary AS failed_items_summary
  FROM docs d LEFT JOIN texts t ON t.key = d.key WHERE doc IS NOT NULL),
f AS (SELECT *, coalesce(failed, errors) AS requests_failed FROM base WHERE total IS NOT NULL OR failed IS NOT NULL OR items > 0),
t AS (SELECT *, coalesce(total, CASE WHEN requests_failed <> 0 THEN requests_failed END) AS requests_total FROM f),
metrics AS (SELECT scraper, key, prefix_form, requests_total, requests_failed, duration_sec, cache_hits, items, failed_items_summary,
    CASE WHEN requests_total > 0 THEN round(requests_failed * 100.0::DOUBLE / requests_total, 2) END AS error_rate_pct,
    coalesce(rpm, CASE WHEN requests_total > 0 AND duration_sec > 0 THEN round(requests_total / (duration_sec / 60.0::DOUBLE), 2) END) AS requests_per_min FROM t),
scored AS (SELECT *, row_number() OVER (PARTITION BY scraper ORDER BY CASE WHEN coalesce(requests_total, 0) <> 0 THEN -4 ELSE 0 END
    - CASE WHEN requests_per_min IS NOT NULL THEN 2 ELSE 0 END - CASE WHEN error_rate_pct IS NOT NULL THEN 1 ELSE 0 END - CASE WHEN items > 0 THEN 1 ELSE 0 END,
    prefix_form, key) AS rn FROM metrics),
best AS (SELECT * FROM scored WHERE rn = 1)
"""
METRIC_COLS = ["requests_total", "requests_failed", "error_rate_pct", "requests_per_min", "duration_sec", "cache_hits", "failed_items_summary"]


def metrics(spark, sf):
    return m.request_metrics(source(spark, sf, "summary_docs"))


@query("m1_request_metrics", METRICS + f"SELECT scraper, key, {', '.join(METRIC_COLS)} FROM metrics")
def m1(spark, sf):
    return metrics(spark, sf).select("scraper", "key", *METRIC_COLS)


@query("m2_failed_items", METRICS + "SELECT key, name, errors, detail FROM items")
def m2(spark, sf):
    docs = source(spark, sf, "summary_docs").select("key", V.parse("body").alias("doc"))
    return keep_rows(docs, V.is_object("doc")).select("key", F.inline(m.failed_items(F.col("doc"))))


@query("m3_failed_items_text", METRICS + "SELECT d.key, summary FROM docs d LEFT JOIN texts t ON t.key = d.key WHERE doc IS NOT NULL")
def m3(spark, sf):
    docs = source(spark, sf, "summary_docs").select("key", V.parse("body").alias("doc"))
    return keep_rows(docs, V.is_object("doc")).withColumn("items", m.failed_items(F.col("doc"))).select("key", m.failed_items_text(F.col("items")).alias("summary"))


@query("m4_best_metrics", METRICS + f"SELECT scraper, key AS json_summary_key, {', '.join(METRIC_COLS)} FROM best")
def m4(spark, sf):
    return m.best_metrics(metrics(spark, sf)).select("scraper", "json_summary_key", *METRIC_COLS)


SITE = "split_part(scraper, '/', 1)"
ROLLUP = f"""SELECT site_id, CAST(sum(requests_total) AS BIGINT) AS requests_total,
      CASE WHEN count(requests_total) > 0 THEN CAST(sum(requests_failed) FILTER (requests_total IS NOT NULL) AS BIGINT) END AS requests_failed,
      CASE WHEN sum(requests_total) > 0 THEN round(sum(requests_failed) FILTER (requests_total IS NOT NULL) * 100.0::DOUBLE / sum(requests_total), 2) END AS error_rate_pct,
      round(coalesce(avg(requests_per_min) FILTER (requests_total IS NOT NULL), CASE WHEN sum(duration_sec) FILTER (requests_total IS NOT NULL) > 0
        THEN sum(requests_total) / (sum(duration_sec) FILTER (requests_total IS NOT NULL) / 60.0::DOUBLE) END), 2) AS requests_per_min, count(requests_total) AS scrapers_with_metrics
    FROM (SELECT *, {SITE} AS site_id FROM best) GROUP BY 1"""


@query("m5_site_request_rollup", METRICS + ROLLUP)
def m5(spark, sf):
    best = m.best_metrics(metrics(spark, sf)).withColumn("site_id", F.split("scraper", "/")[0])
    return m.site_request_rollup(best, ["site_id"])


M6 = METRICS + """,
res AS (SELECT *, requests_failed = 0 AND length(scraper) % 2 = 0 AS all_passed, CASE WHEN scraper LIKE '%7' THEN 0 ELSE 2 END AS files_found FROM best),
chk AS (SELECT scraper, 'check_' || CAST(length(key) % 3 AS VARCHAR) || right(key, 6) AS check_name FROM docs WHERE length(key) % 2 = 0),
names AS (SELECT scraper, array_to_string(list_slice(list_sort(list(DISTINCT check_name)), 1, 5), ', ') AS names FROM chk GROUP BY 1),
bad AS (SELECT r.scraper, requests_failed, error_rate_pct, concat_ws('; ', CASE WHEN files_found = 0 THEN 'no Excel files' END, 'validation: ' || names,
    CASE WHEN requests_failed > 0 THEN requests_failed || ' HTTP error(s)' END, failed_items_summary) AS reason FROM res r LEFT JOIN names n ON n.scraper = r.scraper WHERE NOT all_passed)
"""


def results_and_checks(spark, sf):
    best = m.best_metrics(metrics(spark, sf))
    clean = (F.col("requests_failed") == 0) & (F.length("scraper") % 2 == 0)
    results = best.withColumn("all_passed", clean).withColumn(
        "files_found", F.when(F.col("scraper").endswith("7"), 0).otherwise(2)
    ).withColumn("files_optional", F.lit(False))
    name = F.concat(F.lit("check_"), (F.length("key") % 3).cast("string"), F.expr("right(key, 6)"))
    checks = source(spark, sf, "summary_docs").select("scraper", name.alias("check_name"), (F.length("key") % 2 == 1).alias("passed"))
    return results, checks


@query("m6_failed_scrapers", M6 + "SELECT scraper, CASE WHEN reason = '' THEN 'validation failed' ELSE reason END AS reason, requests_failed, error_rate_pct FROM bad")
def m6(spark, sf):
    return m.failed_scrapers(*results_and_checks(spark, sf))


@query(
    "m6_run_error_summary",
    M6 + """SELECT count(*) AS scrapers_total, count(*) FILTER (NOT all_passed) AS scrapers_failed, count(*) FILTER (all_passed) AS scrapers_passed,
      round(count(*) FILTER (NOT all_passed) * 100.0::DOUBLE / count(*), 1) AS validation_fail_rate_pct FROM res""",
)
def m6_totals(spark, sf):
    return m.run_error_summary(results_and_checks(spark, sf)[0])


@query(
    "m6_run_error_summary_http",
    M6 + """SELECT count(*) AS scrapers_total, (SELECT count(*) FROM chk) AS alert_count, CAST(sum(requests_total) AS BIGINT) AS requests_total,
      CASE WHEN count(requests_total) > 0 THEN CAST(sum(requests_failed) FILTER (requests_total IS NOT NULL) AS BIGINT) END AS requests_failed,
      count(requests_total) AS scrapers_reporting FROM res""",
)
def m6_http(spark, sf):
    results, checks = results_and_checks(spark, sf)
    whole = m.run_error_summary(results, checks.filter("NOT passed"))
    return whole.select("scrapers_total", "alert_count", "http.requests_total", "http.requests_failed", "http.scrapers_reporting")
