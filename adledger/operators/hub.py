"""Hub documents flattened to the daily tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.text import file_name, title_words
from adledger.operators import workflows as K
from adledger.operators.ads import hour_counts_from_report
from adledger.operators.metrics import result_list, scraper_results, with_report_requests
from adledger.operators.sites import hub_request_totals, normalize_schedule, registry_lookup
from adledger.schemas import table_columns, table_types


def typed(doc: Column, path: str, kind: str) -> Column:
    """a field by the type of its table column; null when it does not fit."""
    if kind in ("INT", "BIGINT"):
        return V.whole(doc, path).try_cast(kind)
    if kind == "DOUBLE":
        return V.real(doc, path)
    if kind == "DATE":
        return F.substring(V.text(doc, path), 1, 10).try_cast("date")
    return V.text(doc, path).try_cast(kind)


def with_typed(df: DataFrame, doc: str, types: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """F9 for many fields of one document, read once: ``df`` with what was read, and ``typed`` of each field."""
    counts = [c for c, k in types.items() if k in ("INT", "BIGINT")]
    others = [c for c in types if c not in counts]
    read = {f"_{doc}_wholes": V.wholes(doc, counts)} if counts else {}
    if others:
        read[f"_{doc}_texts"] = V.get(doc, "$", "struct<" + ", ".join(f"`{c}`: string" for c in others) + ">")
    columns = {c: F.col(f"_{doc}_wholes")[i].try_cast(types[c]) for i, c in enumerate(counts)}
    for c in others:
        told, kind = F.col(f"_{doc}_texts")[c], types[c]
        columns[c] = F.substring(told, 1, 10).try_cast("date") if kind == "DATE" else told.try_cast("double" if kind == "DOUBLE" else kind)
    return df.withColumns(read), columns


def uses_proxy(site: Column, report: Column, registry: Column) -> Column:
    """F8: the first flag that is set, of site, report and registry."""
    return F.coalesce(V.get(site, "$.uses_proxy", "boolean"), V.get(report, "$.uses_proxy", "boolean"), registry)


def hub_date(doc: Column | str) -> Column:
    """The date a hub document is for; null when it tells none that is a date."""
    return F.substring(V.text(doc, "$.run_date"), 1, 10).try_cast("date")


def _place(site: Column, told: Column) -> Column:
    """Where an entry stands: by the time its document was made, then by its places in it, as text in order."""
    return F.concat_ws("/", F.coalesce(told, F.lit("")), _number(site)).alias("seq")


def _number(place: Column) -> Column:
    return F.lpad(place.cast("string"), 9, "0")


def _carried(df: DataFrame) -> list[str]:
    return ["seq"] if "seq" in df.columns else []


def site_docs(hub_docs: DataFrame, sequence: bool = False) -> DataFrame:
    """Sites of hub documents ``(doc VARIANT)``; those without id and folder, or of a document without a date, drop out.

    With ``sequence`` each row says where it stands, and so do the rows made of it.
    """
    sites = hub_docs.select(
        hub_date("doc").alias("hub_partition_date"), V.text("doc", "$.generated_at").alias("_told"),
        F.posexplode(V.items("doc", "$.sites")).alias("_site", "site"),
    ).filter(F.col("hub_partition_date").isNotNull())
    folder = F.nullif(V.text("site", "$.folder"), F.lit(""))
    site_id = F.coalesce(F.nullif(V.text("site", "$.site_id"), F.lit("")), folder)
    return sites.select(
        "hub_partition_date", site_id.alias("site_id"), folder.alias("folder"), "site",
        V.get("site", "$.report", "variant").alias("report"), *([_place(F.col("_site"), F.col("_told"))] if sequence else []),
    ).filter(F.col("site_id").isNotNull())


def site_docs_of_summary(summary: DataFrame) -> DataFrame:
    """The same rows straight from summarized sites, without writing the merged document first."""
    fields = [c for c in summary.columns if c not in ("doc", "hub_date", "seq")]
    site = F.parse_json(F.to_json(F.struct(*fields)))
    return summary.select(
        F.col("hub_date").alias("hub_partition_date"), "site_id", "folder", site.alias("site"), F.col("doc").alias("report")
    )


def hub_daily(hub_docs: DataFrame, site_rows: DataFrame, sequence: bool = False) -> DataFrame:
    """one row per hub document; request figures come from the flat site rows."""
    types = table_types("hub_daily")
    doc = F.col("doc")
    requests = ["total_requests", "total_requests_failed", "avg_error_rate_pct", "avg_requests_per_min"]
    hub_docs, told = with_typed(hub_docs, "doc", {c: k for c, k in types.items() if c not in ("hub_partition_date", *requests)})
    plain = [c.alias(name) for name, c in told.items()]
    seq = [_place(F.lit(0), V.text(doc, "$.generated_at"))] if sequence else []
    rows = hub_docs.select(hub_date(doc).alias("hub_partition_date"), *plain, *seq).filter(F.col("hub_partition_date").isNotNull())
    totals = hub_request_totals(site_rows)
    joined = rows.join(totals, "hub_partition_date", "left")
    return joined.select(*[F.col(c).try_cast(k).alias(c) for c, k in types.items()], *_carried(joined))


def site_daily(docs: DataFrame, registry: DataFrame, folder_defaults: dict[str, str] | None = None) -> DataFrame:
    """one row per site and date, with registry and workflow fields."""
    types = table_types("site_daily")
    found = with_report_requests(registry_lookup(docs, registry), "report")
    site, report = F.col("site"), F.col("report")
    results = result_list(report)
    failed = F.filter(results, lambda r: ~F.coalesce(V.get(r, "$.all_passed", "boolean"), F.lit(False)))
    from_registry = normalize_schedule(F.col("reg.schedule"), F.coalesce(F.nullif("reg.folder", F.lit("")), F.col("reg.site_id")), folder_defaults)
    schedule = F.when(F.col("reg").isNotNull(), from_registry).when(
        F.col("folder").isNotNull(), normalize_schedule(F.lit(None).cast("string"), F.col("folder"), folder_defaults)
    )
    place = F.coalesce(
        F.nullif("reg.run_place", F.lit("")), V.text(report, "$.run_place"), V.text(report, "$.github_run.run_place"), F.lit("github")
    )
    special = {
        "hub_partition_date": F.col("hub_partition_date"),
        "site_id": F.col("site_id"),
        "folder": F.col("folder"),
        "repo": F.coalesce(F.nullif(V.text(site, "$.repo"), F.lit("")), F.col("reg.repo")),
        "github_username": F.col("reg.github_username"),
        "run_place": place,
        "workflow_name": K.workflow_label(report, K.configured_names("reg."), F.col("reg.workflow_name")),
        "workflow_run_number": V.safe_int(K.run_reference(report, "workflow_run_number")),
        "workflow_run_id": K.run_reference(report, "workflow_run_id"),
        "workflow_status": K.workflow_status(report, V.text(site, "$.status")),
        "workflow_duration_sec": K.workflow_duration(report),
        "schedule": schedule,
        "requests_total": F.col("requests_total"),
        "requests_failed": F.col("requests_failed"),
        "error_rate_pct": F.col("error_rate_pct"),
        "requests_per_min": F.col("requests_per_min"),
        "scrapers_failed": F.size(failed),
        "report_fallback": F.coalesce(V.get(site, "$.report_fallback", "boolean"), F.lit(False)),
        "uses_proxy": uses_proxy(site, report, F.col("reg.uses_proxy")),
    }
    found, told = with_typed(found, "site", {c: k for c, k in types.items() if c not in special})
    return found.select(*[(special[c].try_cast(k) if c in special else told[c]).alias(c) for c, k in types.items()], *_carried(docs))


def scraper_entries(docs: DataFrame) -> DataFrame:
    """one row per scraper of each site's report, named by itself, its key or its place."""
    rows = docs.select("hub_partition_date", "site_id", *_carried(docs), F.posexplode(scraper_results(F.col("report"))).alias("_n", "_s"))
    label = F.coalesce(F.nullif(V.text("_s.result", "$.scraper"), F.lit("")), F.col("_s.name"))
    seq = [F.concat_ws("/", "seq", _number(F.col("_n"))).alias("seq")] if _carried(docs) else []
    return rows.select("hub_partition_date", "site_id", label.alias("scraper"), F.col("_s.result").alias("result"), *seq)


def scraper_daily(entries: DataFrame) -> DataFrame:
    """one row per scraper."""
    own = {
        "hub_partition_date": F.col("hub_partition_date"),
        "site_id": F.col("site_id"),
        "scraper": F.col("scraper"),
        "files_optional": F.coalesce(V.get("result", "$.files_optional", "boolean"), F.lit(False)),
    }
    return entries.select(
        *[(own[c] if c in own else typed(F.col("result"), f"$.{c}", k)).alias(c) for c, k in table_types("scraper_daily").items()],
        *_carried(entries),
    )


def scraper_hourly_daily(entries: DataFrame) -> DataFrame:
    """ads per hour of each scraper."""
    counted = hour_counts_from_report(entries.select("hub_partition_date", "site_id", "scraper", *_carried(entries), "result"))
    return counted.withColumn("ads_count", F.col("ads_count").try_cast("int"))


def _told_breakdown(result: Column) -> Column:
    """Breakdown rows a report tells itself."""

    def row(raw: Column) -> Column:
        keys = F.map_keys(V.members(raw, "$"))
        has = lambda k: F.array_contains(keys, k)
        # the first key there is decides, also when its value is null
        count = F.when(has("ads_count"), V.text(raw, "$.ads_count")).when(has("listings_count"), V.text(raw, "$.listings_count")).otherwise(V.text(raw, "$.count"))
        n = V.non_negative_int(F.regexp_replace(count, r"^(-?\d+)\.\d+$", "$1"))
        return F.struct(
            F.trim(F.coalesce(V.text(raw, "$.subcategory"), F.lit(""))).alias("subcategory"),
            F.trim(F.coalesce(V.text(raw, "$.level_3"), F.lit(""))).alias("level_3"),
            n.alias("ads_count"),
            F.coalesce(F.nullif(V.non_negative_int(V.text(raw, "$.sheet_rows"), -1), F.lit(-1).cast("bigint")), n).alias("sheet_rows"),
            V.non_negative_int(V.text(raw, "$.sheets_count"), 1).alias("sheets_count"),
            F.coalesce(F.nullif(V.text(raw, "$.source"), F.lit("")), F.lit("json_summary")).alias("source"),
        )

    objects = F.filter(V.items(result, "$.subcategory_breakdown"), lambda r: V.is_object(r))
    return F.filter(F.transform(objects, row), lambda r: r["subcategory"] != "")


def file_subcategory(key: Column) -> Column:
    """Group name from a file: its stem with blanks, in title case."""
    stem = F.regexp_replace(file_name(key), r"(?<=.)\.[^.]*$", "")
    return title_words(F.trim(F.translate(stem, "_-", "  ")))


def _sheet_breakdown(result: Column) -> Column:
    """(subcategory, level_3, rows) of each data sheet of each file of a scraper."""

    def sheet_row(key: Column, sheet: Column) -> Column:
        name = F.trim(F.coalesce(V.text(sheet, "$.name"), F.lit("")))
        parts = F.filter(
            F.transform(F.split(F.regexp_replace(name, " > |::| - ", "/"), "/"), F.trim), lambda p: p != ""
        )
        group = file_subcategory(key)
        by_file = group != ""
        generic = F.lower(name).isin(*rules.GENERIC_SHEETS)
        return F.struct(
            name.alias("name"),
            F.when(by_file, group).otherwise(F.coalesce(F.try_element_at(parts, F.lit(1)), name)).alias("subcategory"),
            F.when(by_file, F.when(generic, "").otherwise(name)).otherwise(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("level_3"),
            F.greatest(F.coalesce(V.whole(sheet, "$.row_count"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint")).alias("n"),
        )

    def file_rows(file: Column) -> Column:
        key = F.coalesce(F.nullif(V.text(file, "$.file_key"), F.lit("")), V.text(file, "$.file"), F.lit(""))
        sheets = F.coalesce(V.items(file, "$.sheets"), F.array().cast("array<variant>"))
        return F.transform(sheets, lambda s: sheet_row(key, s))

    rows = F.flatten(F.transform(V.items(result, "$.file_results"), file_rows))
    return F.filter(rows, lambda r: (r["name"] != "") & ~F.lower(r["name"]).isin(*rules.SKIP_SHEETS))


def scraper_subcategory_daily(entries: DataFrame) -> DataFrame:
    """the breakdown a scraper tells, else its sheet rows grouped by file and sheet names.

    The choice is made inside each scraper's row, so no second read and no anti join is needed.
    """
    keys = ["hub_partition_date", "site_id", "scraper", *_carried(entries)]
    both = entries.select(*keys, _told_breakdown(F.col("result")).alias("_told"), _sheet_breakdown(F.col("result")).alias("_sheets"))
    has_told = F.coalesce(F.size("_told") > 0, F.lit(False))
    told = both.filter(has_told).select(*keys, F.posexplode("_told").alias("_row", "_t")).select(*keys, "_row", "_t.*")
    if _carried(entries):
        told = told.withColumn("seq", F.concat_ws("/", "seq", _number(F.col("_row"))))
    told = told.drop("_row")
    grouped = (
        both.filter(~has_told)
        .select(*keys, F.inline("_sheets"))
        .groupBy(*keys, "subcategory", "level_3")
        .agg(F.sum("n").alias("ads_count"), F.sum("n").alias("sheet_rows"), F.count(F.lit(1)).alias("sheets_count"))
        .withColumn("source", F.lit("sheet_rows"))
    )
    types = table_types("scraper_subcategory_daily")
    rows = told.unionByName(grouped)
    return rows.select(*[F.col(c).try_cast(k).alias(c) for c, k in types.items()], *_carried(rows))


def alerts_flat(docs: DataFrame) -> DataFrame:
    """one row per alert of each site's report; its id is made of date, site, scraper and place."""
    raised = docs.select("hub_partition_date", "site_id", *_carried(docs), F.posexplode(V.items("report", "$.alerts")).alias("i", "alert"))
    scraper = F.coalesce(V.text("alert", "$.scraper"), F.lit(""))
    alert_id = F.concat_ws(":", F.col("hub_partition_date").cast("string"), "site_id", scraper, F.col("i").cast("string"))
    return raised.select(
        "hub_partition_date", "site_id", scraper.alias("scraper"),
        V.text("alert", "$.severity").alias("severity"),
        V.text("alert", "$.type").alias("alert_type"),
        V.text("alert", "$.check").alias("check_name"),
        V.text("alert", "$.detail").alias("detail"),
        V.text("alert", "$.file").alias("file_key"),
        alert_id.alias("alert_id"),
        F.coalesce(V.get("alert", "$.solved", "boolean"), F.lit(False)).alias("solved"), *_carried(docs),
    )


def flatten_hub(hub_docs: DataFrame, registry: DataFrame, folder_defaults: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """F1-F7 over any number of hub documents at once.

    The tables carry ``seq``, by which the writers keep the last row of each primary key.
    """
    docs = site_docs(hub_docs, sequence=True)
    entries = scraper_entries(docs)
    sites = site_daily(docs, registry, folder_defaults)
    tables = {
        "hub_daily": hub_daily(hub_docs, sites, sequence=True),
        "site_daily": sites,
        "scraper_daily": scraper_daily(entries),
        "scraper_hourly_daily": scraper_hourly_daily(entries),
        "scraper_subcategory_daily": scraper_subcategory_daily(entries),
        "alerts": alerts_flat(docs),
    }
    return {name: df.select(*table_columns(name), "seq") for name, df in tables.items()}
