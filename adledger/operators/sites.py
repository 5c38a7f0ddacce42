"""Site and hub rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.text import let, pct_or_null
from adledger.operators.metrics import result_list, with_report_requests
from adledger.operators.ordering import first_rows, keep_rows

PHONE_COUNTS = ["unique_phones", "valid_phones", "invalid_phones", "outside_country_phones"]
STORAGE_TOTALS = ["r2_file_count", "r2_size_bytes", *[f"r2_{c}_bytes" for c in rules.STORAGE_CATEGORIES]]
STORAGE_DAILY = ["r2_daily_size", *[f"r2_daily_{c}_bytes" for c in rules.STORAGE_CATEGORIES]]


def site_report(scrapers: DataFrame, site_storage: DataFrame | None = None) -> DataFrame:
    """H1: totals of a site over its scrapers. A site-wide inventory, where given, replaces summed storage."""
    columns = ["unique_ads", *PHONE_COUNTS, *STORAGE_TOTALS, *STORAGE_DAILY]
    summed = scrapers.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("scrapers_total"),
        F.count_if(F.coalesce("all_passed", F.lit(False))).alias("scrapers_passed"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in columns],
    )
    if site_storage is None:
        return summed
    own = site_storage.select("site_id", *[F.col(c).alias(f"_{c}") for c in STORAGE_TOTALS])
    joined = summed.join(own, "site_id", "left")
    for name in STORAGE_TOTALS:
        joined = joined.withColumn(f"total_{name}", F.coalesce(f"_{name}", f"total_{name}")).drop(f"_{name}")
    return joined


def normalize_schedule(schedule: Column, folder: Column, folder_defaults: dict[str, str] | None = None) -> Column:
    """H2: schedule name with underscores; by folder when none is given, else daily."""
    plain = F.regexp_replace(F.lower(F.nullif(schedule, F.lit(""))), "[ -]", "_")
    if not folder_defaults:
        return F.coalesce(plain, F.lit("daily"))
    table = F.create_map(*[F.lit(x) for pair in folder_defaults.items() for x in pair])
    return F.coalesce(plain, F.try_element_at(table, F.lower(folder)), F.lit("daily"))


def fallback_policy(sites: DataFrame, folder_defaults: dict[str, str] | None = None) -> DataFrame:
    """H3: whether a site may reuse an older report, and how many days back."""
    folder = F.coalesce(F.nullif("folder", F.lit("")), F.col("site_id"))
    named = sites.withColumn("schedule_name", normalize_schedule(F.col("schedule"), folder, folder_defaults))
    flag = F.lower("report_fallback")
    days = F.create_map(*[F.lit(x) for pair in rules.REPORT_LOOKBACK_DAYS.items() for x in pair])
    return named.withColumn(
        "allows_fallback",
        F.when(flag.isin("true", "latest"), True)
        .when(flag == "false", False)
        .otherwise(F.col("schedule_name").isin(*rules.NON_DAILY_SCHEDULES)),
    ).withColumn(
        "lookback_days",
        F.coalesce("report_lookback_days", F.try_element_at(days, F.col("schedule_name")), F.lit(rules.REPORT_LOOKBACK_DEFAULT)),
    )


def _sums_over(items: Column, names: list[str]) -> Column:
    """Sums of the named members over some objects, each read once, as an array in the order of the names."""
    zero = F.lit(0).cast("bigint")

    def add(sums: Column, item: Column) -> Column:
        return F.zip_with(sums, V.wholes(item, names), lambda a, n: a + F.coalesce(n, zero))

    return F.aggregate(items, F.array(*[zero] * len(names)), add)


def unique_ads_of_report(doc: Column, results: Column) -> Column:
    """H5: unique ads of a report from the first place that tells."""
    categories = V.items(doc, "$.categories")
    return F.coalesce(
        let(V.wholes(doc, ["total_unique_ads", "total_ads"]), lambda w: F.coalesce(w[0], w[1])),
        F.when(categories.isNotNull(), _sums_over(categories, ["total_ads"])[0]),
        _sums_over(results, ["unique_ads"])[0],
    )


def report_is_empty(doc: Column, results: Column) -> Column:
    """H4: true when a report tells of no ads, phones, files or bytes of the day."""

    def filled(told: Column, sums: Column) -> Column:
        return (F.coalesce(told[0], sums[0]) != 0) | (F.coalesce(told[1], sums[1]) != 0)

    told, sums = V.wholes(doc, ["total_unique_phones", "r2_daily_size"]), _sums_over(results, ["unique_phones", "r2_daily_size"])
    any_files = F.exists(results, lambda r: let(V.wholes(r, ["files_found", "unique_ads"]), lambda w: (w[0] > 0) | (w[1] > 0)))
    some = (unique_ads_of_report(doc, results) != 0) | let(told, lambda t: let(sums, lambda s: filled(t, s))) | any_files
    return doc.isNull() | ~F.coalesce(some, F.lit(False))


def report_facts(reports: DataFrame) -> DataFrame:
    """Reports parsed once: ``site_id, report_date, doc, is_empty``. Unreadable ones count as not there."""
    parsed = keep_rows(reports.select("site_id", "report_date", V.parse("body").alias("doc")), F.col("doc").isNotNull())
    with_results = parsed.withColumn("_r", result_list(F.col("doc")))
    return with_results.withColumn("is_empty", report_is_empty(F.col("doc"), F.col("_r"))).drop("_r")


def asked_days(sites: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Each site on each asked hub date."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end or start).cast("date"))
    return sites.withColumn("hub_date", F.explode(days))


def latest_usable_report(asked: DataFrame, facts: DataFrame) -> DataFrame:
    """H6: as-of join of asked ``(site, hub_date)`` rows with reports.

    The report of the day when usable; else, for sites that may fall back, the newest usable one within the
    lookback; else the day's empty one; else none. The search runs over narrow (site, date) rows: one ordered
    pass per site carries the last usable date forward, so no report meets every asked day. A site that is asked
    for twice, as by two registry rows, gets its answer twice. ``facts`` has one row per site and date, and
    whatever else it holds comes along; see ``summarized_reports``.
    """
    probes = asked.select(
        "site_id", F.col("hub_date").alias("day"), F.lit(0).alias("kind"), F.lit(None).cast("boolean").alias("is_empty")
    ).distinct()
    points = facts.select("site_id", F.col("report_date").alias("day"), F.lit(1).alias("kind"), "is_empty")
    order = W.partitionBy("site_id").orderBy("day", "kind")
    usable = F.when(~F.col("is_empty"), F.col("day"))
    # an asked day sorts right before the report of that day, so the report is the next row if there is one
    same_day = (F.lead("day").over(order) == F.col("day")) & (F.lead("kind").over(order) == 1)
    carried = (
        probes.unionByName(points)
        .withColumn("_last", F.last(usable, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("_empty", F.when(same_day, F.lead("is_empty").over(order)))
        .filter(F.col("kind") == 0)
        .select("site_id", F.col("day").alias("hub_date"), "_last", "_empty")
    )
    joined = asked.join(carried, ["site_id", "hub_date"], "left")
    in_reach = F.col("_last") >= F.date_sub("hub_date", F.col("lookback_days"))
    use_older = F.coalesce(F.col("_empty"), F.lit(True)) & F.col("allows_fallback") & F.coalesce(in_reach, F.lit(False))
    chosen = joined.withColumn(
        "report_date", F.when(use_older, F.col("_last")).when(F.col("_empty").isNotNull(), F.col("hub_date"))
    ).withColumn("report_fallback", use_older).drop("_last", "_empty")
    bodies = facts.drop("is_empty")
    return chosen.join(bodies, ["site_id", "report_date"], "left")


def display_label(name: Column, folder: Column, vehicle_folders: list[str]) -> Column:
    """H8: chosen folders get a lower-case name marked as automotive, once."""
    label = F.trim(name)
    marked = F.when(F.lower(label).endswith("(automotive)"), label).otherwise(F.concat(F.lower(label), F.lit(" (automotive)")))
    return F.when(F.trim(folder).isin(*vehicle_folders), marked).otherwise(label) if vehicle_folders else label


def with_told(df: DataFrame) -> DataFrame:
    """Add ``told``: all that a summary takes from the report in ``doc``, typed; null where there is no report."""
    doc, results = F.col("doc"), F.col("_results")
    by_report = {c: f"total_{c}" for c in PHONE_COUNTS} | {"r2_file_count": "total_r2_files", "r2_size_bytes": "total_r2_size_bytes"}
    by_report |= {"r2_daily_size": "r2_daily_size"} | {f"r2_{c}_bytes": f"total_r2_{c}_bytes" for c in rules.STORAGE_CATEGORIES}
    by_report |= {f"r2_daily_{c}_bytes": f"total_r2_daily_{c}_bytes" for c in rules.STORAGE_CATEGORIES}
    texts = ("display_name", "website", "country", "repo")
    plain = ", ".join(f"{c}: string" for c in (*texts, "run_date", "inspect_date"))
    kind = f"struct<{plain}, overall_pass: boolean, total_ads: variant, alerts: array<variant>, alert_count: variant>"
    base = with_report_requests(df, "doc").withColumn("_results", result_list(doc)).withColumns({
        "_doc": V.get(doc, "$", kind),
        "_counts": F.zip_with(V.wholes(doc, list(by_report.values())), _sums_over(results, list(by_report)), lambda r, n: F.coalesce(r, n)),
    })
    d = F.col("_doc")
    told = F.struct(
        *[F.nullif(d[c], F.lit("")).alias(c) for c in texts],
        d["run_date"].alias("run_date"),
        d["inspect_date"].alias("inspect_date"),
        F.size(results).alias("reported"),
        F.size(F.filter(results, lambda r: F.coalesce(V.get(r, "$.all_passed", "boolean"), F.lit(False)))).alias("passed"),
        d["overall_pass"].alias("overall_pass"),
        d["total_ads"].isNotNull().alias("has_total"),
        F.coalesce(V.told_whole(d["alert_count"]), F.size(d["alerts"]).cast("bigint"), F.lit(0).cast("bigint")).alias("alert_count"),
        unique_ads_of_report(doc, results).cast("bigint").alias("unique_ads"),
        *[F.col("_counts")[i].alias(c) for i, c in enumerate(by_report)],
        "requests_total", "requests_failed", "error_rate_pct", "requests_per_min",
    )
    return base.select(*df.columns, F.when(doc.isNotNull(), told).alias("told"))


def summarized_reports(facts: DataFrame, documents: bool = False) -> DataFrame:
    """One row per site and report date with ``is_empty`` and ``told``, and with ``doc`` only where it is asked for.

    Each report is read once here, however many days fall back on it, and what is shuffled after is narrow. Of two
    reports of a site for one day a usable one counts first, then the one that tells more.
    """
    kept = ["site_id", "report_date", "is_empty", "told", *(["doc"] if documents else [])]
    rows = with_told(facts).select(*kept)
    return first_rows(rows, ["site_id", "report_date"], ["is_empty", F.desc("told")])


def summarize_site(chosen: DataFrame, vehicle_folders: list[str] | None = None) -> DataFrame:
    """H7: one row per asked site and hub date from the report chosen for it."""
    rows = chosen if "told" in chosen.columns else with_told(chosen)
    t = F.col("told")
    none, zero = t.isNull(), F.lit(0).cast("bigint")
    total = F.when(t["reported"] > 0, t["reported"]).otherwise(F.coalesce(F.nullif("scrapers", F.lit(0)), F.lit(0)))
    summary_only = (t["reported"] == 0) & (total > 0)
    passed = (
        F.when(summary_only & ~F.coalesce(t["overall_pass"], F.lit(True)), 0)
        .when(summary_only & (t["requests_total"].isNotNull() | t["has_total"]), total)
        .otherwise(t["passed"])
    )
    name = F.coalesce(t["display_name"], F.nullif("display_name", F.lit("")), F.nullif("folder", F.lit("")))
    told = lambda c: F.when(none, zero).otherwise(t[c]).alias(c)
    daily = ["r2_daily_size", *(f"r2_{c}_bytes" for c in rules.STORAGE_CATEGORIES), *(f"r2_daily_{c}_bytes" for c in rules.STORAGE_CATEGORIES)]
    summed = rows.select(
        "hub_date", "site_id", "folder", "seq",
        display_label(name, F.col("folder"), vehicle_folders or []).alias("display_name"),
        *[F.coalesce(t[c], F.col(c)).alias(c) for c in ("website", "country", "repo")],
        "uses_proxy", "report_fallback",
        F.coalesce(t["run_date"], F.coalesce("report_date", "hub_date").cast("string")).alias("run_date"),
        t["inspect_date"].alias("inspect_date"),
        F.when(none, 0).otherwise(total).cast("bigint").alias("scrapers_total"),
        F.when(none, 0).otherwise(passed).cast("bigint").alias("scrapers_passed"),
        *[told(c) for c in ("alert_count", "unique_ads", *PHONE_COUNTS, "r2_file_count", "r2_size_bytes", *daily)],
        *[t[c].alias(c) for c in ("requests_total", "requests_failed", "error_rate_pct", "requests_per_min")],
        none.alias("_none"), *(["doc"] if "doc" in rows.columns else []),
    )
    whole = (F.col("scrapers_passed") == F.col("scrapers_total")) & (F.col("scrapers_total") > 0)
    return summed.withColumn("status", F.when(F.col("_none"), "missing").when(whole, "ok").otherwise("failed")).withColumn(
        "scrapers_failed", F.when(~F.col("_none"), F.greatest(F.col("scrapers_total") - F.col("scrapers_passed"), zero))
    ).drop("_none")


def hub_rollup(sites: DataFrame) -> DataFrame:
    """H9: one row per hub date over its sites. Request totals of zero become null."""
    told = F.coalesce("requests_total", F.lit(0)) != 0
    status = F.col("status")
    totals = sites.groupBy("hub_date").agg(
        F.count(F.lit(1)).alias("sites_total"),
        F.count_if(status == "ok").alias("sites_ok"),
        F.count_if(status == "failed").alias("sites_failed"),
        F.count_if(status == "missing").alias("sites_missing"),
        F.sum("alert_count").alias("total_alerts"),
        F.sum(F.coalesce("unique_ads", F.lit(0))).alias("total_unique_ads"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(f"total_{c}") for c in PHONE_COUNTS],
        F.sum("r2_file_count").alias("total_r2_files"),
        F.sum("r2_size_bytes").alias("total_r2_size_bytes"),
        F.sum("r2_daily_size").alias("total_r2_daily_size"),
        *[F.sum(c).alias(f"total_{c}") for c in [*STORAGE_TOTALS[2:], *STORAGE_DAILY[1:]]],
        F.nullif(F.sum("requests_total"), F.lit(0).cast("bigint")).alias("total_requests"),
        F.nullif(F.sum(F.when(told, F.coalesce("requests_failed", F.lit(0)))), F.lit(0).cast("bigint")).alias("total_requests_failed"),
        # in decimals, so the mean does not depend on the order in which rows are added up
        F.round(F.avg(F.col("requests_per_min").cast("decimal(28,6)")), 2).cast("double").alias("avg_requests_per_min"),
    )
    return totals.withColumn(
        "avg_error_rate_pct", pct_or_null(F.coalesce("total_requests_failed", F.lit(0)), F.col("total_requests"))
    )


def hub_request_totals(site_rows: DataFrame, by: str = "hub_partition_date") -> DataFrame:
    """Request totals of the flat table. Zero totals stay zero; then the error rate is a plain mean."""
    has = F.col("requests_total").isNotNull()
    sums = site_rows.groupBy(by).agg(
        F.sum("requests_total").alias("total_requests"),
        F.when(F.count_if(has) > 0, F.sum(F.when(has, F.coalesce("requests_failed", F.lit(0))))).alias("total_requests_failed"),
        F.avg(F.when(has, F.col("error_rate_pct"))).alias("_err"),
        F.round(F.avg(F.when(has, F.col("requests_per_min"))), 2).alias("avg_requests_per_min"),
    )
    weighted = pct_or_null(F.col("total_requests_failed"), F.col("total_requests"))
    return sums.withColumn("avg_error_rate_pct", F.coalesce(weighted, F.round("_err", 2))).drop("_err")


REGISTRY_FILL = ["github_username", "repo", "run_place", "schedule", "workflows", "workflow_name", "uses_proxy"]


def overlay_registry(sites: DataFrame, registry: DataFrame) -> DataFrame:
    """Empty site fields filled from the first registry row with the same folder or the same site id.

    Two equality joins, each against one row per key, and the earlier of the two rows wins.
    """
    packed = F.struct("seq", *REGISTRY_FILL)

    def first_by(key: str, name: str) -> DataFrame:
        keyed = registry.filter(F.coalesce(F.col(key), F.lit("")) != "")
        return keyed.groupBy(F.col(key).alias(f"_{key}")).agg(F.min_by(packed, "seq").alias(name))

    joined = sites.join(first_by("folder", "_f"), F.col("folder") == F.col("_folder"), "left").join(
        first_by("site_id", "_s"), F.col("site_id") == F.col("_site_id"), "left"
    )
    pick = F.when(F.col("_s").isNull() | (F.col("_f.seq") <= F.col("_s.seq")), F.col("_f")).otherwise(F.col("_s"))
    with_row = joined.withColumn("_row", pick)
    for name in REGISTRY_FILL:
        own = F.col(name)
        if name == "workflows":
            own = F.when(F.size(own) > 0, own)
        elif name != "uses_proxy":
            own = F.when(own != "", own)
        with_row = with_row.withColumn(name, F.coalesce(own, F.col(f"_row.{name}"), F.col(name)))
    return with_row.drop("_row", "_f", "_s", "_folder", "_site_id")


def registry_lookup(sites: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry row of each site by its id, then by its folder. The last row of a key wins.

    Adds the registry row as the struct ``reg``.
    """
    fields = [c for c in registry.columns]
    packed = registry.select(F.struct(*fields).alias("reg"), "seq", "site_id", "folder")
    keyed = packed.select("reg", "seq", F.explode(F.array("site_id", "folder")).alias("key")).filter(F.coalesce("key", F.lit("")) != "")
    last = keyed.groupBy("key").agg(F.max_by("reg", "seq").alias("reg"))
    by_id = last.select(F.col("key").alias("_id"), F.col("reg").alias("_by_id"))
    by_folder = last.select(F.col("key").alias("_folder"), F.col("reg").alias("_by_folder"))
    return (
        sites.join(by_id, F.col("site_id") == F.col("_id"), "left")
        .join(by_folder, F.col("folder") == F.col("_folder"), "left")
        .withColumn("reg", F.coalesce("_by_id", "_by_folder"))
        .drop("_id", "_by_id", "_folder", "_by_folder")
    )
