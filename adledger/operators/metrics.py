"""Request metrics (M1-M7) from summary and report documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.text import let, pct_or_null
from adledger.operators.ordering import first_rows, keep_rows

ITEM = "array<struct<name:string,errors:bigint,detail:string>>"
LISTED = 12
TEXT_LIMIT = 400


def metric_layers(doc: Column) -> list[Column]:
    """The places that may hold counters, in order: nested block, root, stats."""
    nested = F.when(V.is_object(doc, "$.request_metrics"), V.get(doc, "$.request_metrics", "variant"))
    stats = F.when(V.is_object(doc, "$.stats"), V.get(doc, "$.stats", "variant"))
    return [nested, doc, stats]


def _filled(value: Column, path: str = "$") -> Column:
    """The list at ``path`` when it has elements."""
    return let(V.items(value, path), lambda found: F.when(F.size(found) > 0, found))


def _error_count(value: Column) -> Column:
    """A set counter: numbers are cut, digits in text count, anything else that is set counts as one."""
    one = F.lit(1).cast("bigint")

    def read(kind: Column, as_text: Column) -> Column:
        return (
            F.when(V.number_kind(kind), F.nullif(V.get(value, "$", "double").cast("bigint"), F.lit(0).cast("bigint")))
            .when((kind == "STRING") & (as_text != ""), F.coalesce(V.safe_int(as_text), one))
            .when((F.size(V.items(value, "$")) > 0) | (F.size(V.members(value, "$")) > 0) | (as_text == "true"), one)
        )

    return let(F.schema_of_variant(value), lambda kind: let(V.text(value, "$"), lambda as_text: read(kind, as_text)))


def _first_name(values: list[Column]) -> Column:
    return V.told_first(values, lambda v: F.nullif(V.text(v, "$"), F.lit("")))


def _item(name: Column, errors: Column, detail: Column) -> Column:
    return F.struct(name.alias("name"), errors.cast("bigint").alias("errors"), detail.cast("string").alias("detail"))


def _told_item(raw: Column, names: list[str], default: str, counters: list[str], details: list[str], need_count: bool = False) -> Column:
    """An item of an object, whose members are read once; null of anything else, and without a counter if one is needed."""

    def of(m: Column) -> Column:
        pick = lambda keys: [m[k] for k in keys]
        name = F.coalesce(_first_name(pick(names)), F.lit(default))
        detail = _first_name(pick(details)) if details else F.lit(None)
        errors = V.told_first(pick(counters), _error_count)
        if need_count:
            return let(errors, lambda n: F.when(n.isNotNull(), _item(name, n, detail)))
        return F.when(m.isNotNull(), _item(name, F.coalesce(errors, F.lit(1).cast("bigint")), detail))

    return let(V.fields(raw, [*names, *counters, *details]), of)


ITEM_LISTS = ["failed_items", "failed_scrapers", "errors"]


def failed_items(doc: Column, layers: list[Column] | None = None) -> Column:
    """M2: failed targets of four shapes, distinct, in document order.

    ``layers`` are structs that have at least the members ``ITEM_LISTS``; those of the document by default.
    """
    none = F.array().cast(ITEM)
    layers = layers or [V.fields(layer, ITEM_LISTS) for layer in metric_layers(doc)]

    def target(raw: Column) -> Column:
        return _told_item(raw, ["name", "scraper", "slug", "category"], "unknown", ["errors", "error_count"], ["detail", "reason", "message"])

    def error(raw: Column) -> Column:
        told = _told_item(raw, ["name", "scraper", "slug"], "error", ["count"], ["detail", "message", "reason"])
        return F.coalesce(told, F.when(F.schema_of_variant(raw) == "STRING", _item(V.text(raw, "$"), F.lit(1), F.lit(None))))

    def category(raw: Column) -> Column:
        return _told_item(raw, ["name_en", "name_ar", "name", "slug"], "subcategory", ["errors", "error_count"], [], need_count=True)

    def of_layer(layer: Column) -> Column:
        raw = F.coalesce(_filled(layer["failed_items"]), _filled(layer["failed_scrapers"]))
        targets = F.filter(F.transform(raw, target), lambda i: i.isNotNull())
        return F.concat(F.coalesce(targets, none), F.coalesce(F.transform(V.items(layer["errors"], "$"), error), none))

    told = [F.when(F.coalesce(*(layer[n] for n in ITEM_LISTS)).isNotNull(), F.struct(*(layer[n].alias(n) for n in ITEM_LISTS))) for layer in layers]
    lists = F.filter(F.array(*told), lambda layer: layer.isNotNull())
    groups = F.coalesce(_filled(doc, "$.subcategories"), _filled(doc, "$.categories"))
    # most categories count no errors, and of those nothing else is read
    counted = F.filter(groups, lambda g: F.coalesce(*(V.get(g, f"$.{k}", "variant") for k in ("errors", "error_count"))).isNotNull())
    found = F.concat(F.flatten(F.transform(lists, of_layer)), F.coalesce(F.transform(counted, category), none))
    kept = F.filter(
        found,
        lambda i: i.isNotNull() & (i["name"] != "") & ((i["errors"] > 0) | i["detail"].isNotNull()),
    )
    return F.array_distinct(kept)


def failed_items_text(items: Column) -> Column:
    """M3: the first items as one line of text, cut to its limit; null when there are none."""

    def line(item: Column) -> Column:
        head = F.concat(item["name"], F.lit(": "), item["errors"].cast("string"), F.lit(" error(s)"))
        return F.concat(head, F.coalesce(F.concat(F.lit(" ("), item["detail"], F.lit(")")), F.lit("")))

    listed = F.array_join(F.transform(F.slice(items, 1, LISTED), line), "; ")
    more = F.when(F.size(items) > LISTED, F.concat(F.lit("; +"), (F.size(items) - LISTED).cast("string"), F.lit(" more")))
    return F.when(F.size(items) > 0, F.substring(F.concat(listed, F.coalesce(more, F.lit(""))), 1, TEXT_LIMIT))


def request_metrics(docs: DataFrame) -> DataFrame:
    """M1: request counters of each document ``(scraper, key, prefix_form, body)``; documents without any drop out."""
    parsed = keep_rows(docs.withColumn("_doc", V.parse("body")), V.is_object("_doc"))
    keys = [*rules.REQUEST_TOTAL_KEYS, *rules.REQUEST_FAILED_KEYS, *rules.DURATION_KEYS, *rules.RPM_KEYS, *rules.CACHE_KEYS, *ITEM_LISTS]
    # each place that may hold counters is read once, all its members together
    names = ["_nested", "_root", "_stats"]
    layered = parsed.withColumns({n: V.fields(layer, keys) for n, layer in zip(names, metric_layers(F.col("_doc")), strict=True)})
    layers = [F.col(n) for n in names]
    first = lambda of, read: V.told_first([layer[k] for layer in layers for k in of], read)
    told = layered.select(
        *[c for c in docs.columns if c != "body"],
        first(rules.REQUEST_TOTAL_KEYS, V.told_count).alias("_total"),
        first(rules.REQUEST_FAILED_KEYS, V.told_count).alias("_failed"),
        first(rules.DURATION_KEYS, V.told_measure).alias("duration_sec"),
        first(rules.RPM_KEYS, V.told_measure).alias("_rpm"),
        first(rules.CACHE_KEYS, V.told_count).alias("cache_hits"),
        failed_items(F.col("_doc"), layers).alias("failed_items"),
    )
    raw = keep_rows(told, F.col("_total").isNotNull() | F.col("_failed").isNotNull() | (F.size("failed_items") > 0))
    counted = F.aggregate("failed_items", F.lit(0).cast("bigint"), lambda a, i: a + i["errors"])
    with_failed = raw.withColumn("requests_failed", F.coalesce("_failed", counted))
    with_total = with_failed.withColumn(
        "requests_total", F.coalesce("_total", F.when(F.col("requests_failed") != 0, F.col("requests_failed")))
    )
    rate = F.when(
        (F.col("requests_total") > 0) & (F.col("duration_sec") > 0),
        F.round(F.col("requests_total") / (F.col("duration_sec") / 60.0), 2),
    )
    return (
        with_total.withColumn("error_rate_pct", pct_or_null(F.col("requests_failed"), F.col("requests_total")))
        .withColumn("requests_per_min", F.coalesce("_rpm", rate))
        .withColumn("failed_items_summary", failed_items_text(F.col("failed_items")))
        .withColumn("metrics_source", F.lit("json_summary"))
        .drop("_total", "_failed", "_rpm")
    )


def best_metrics(metrics: DataFrame) -> DataFrame:
    """M4: per scraper the most complete metrics; the first by path form and key on a tie."""
    score = (
        F.when(F.coalesce("requests_total", F.lit(0)) != 0, 4).otherwise(0)
        + F.when(F.col("requests_per_min").isNotNull(), 2).otherwise(0)
        + F.when(F.col("error_rate_pct").isNotNull(), 1).otherwise(0)
        + F.when(F.size("failed_items") > 0, 1).otherwise(0)
    )
    values = [c for c in metrics.columns if c not in ("scraper", "prefix_form")]
    ranked = F.struct((-score).alias("minus"), "prefix_form", "key")
    best = metrics.groupBy("scraper").agg(F.min_by(F.struct(*values), ranked).alias("_m"))
    return best.select("scraper", *[F.col(f"_m.{c}").alias("json_summary_key" if c == "key" else c) for c in values])


def site_request_rollup(scrapers: DataFrame, by: list[str]) -> DataFrame:
    """M5: requests of a site over its scrapers that report any; nulls when none does."""
    has = F.col("requests_total").isNotNull()
    sums = scrapers.groupBy(*by).agg(
        F.sum("requests_total").alias("requests_total"),
        F.when(F.count_if(has) > 0, F.sum(F.when(has, F.coalesce("requests_failed", F.lit(0))))).alias("requests_failed"),
        F.sum(F.when(has, F.coalesce("duration_sec", F.lit(0.0)))).alias("_duration"),
        F.avg(F.when(has, F.col("requests_per_min"))).alias("_rpm"),
        F.count_if(has).alias("scrapers_with_metrics"),
    )
    spread = F.when(F.col("_duration") > 0, F.col("requests_total") / (F.col("_duration") / 60.0))
    return sums.select(
        *by, "requests_total", "requests_failed",
        pct_or_null(F.col("requests_failed"), F.col("requests_total")).alias("error_rate_pct"),
        F.round(F.coalesce("_rpm", spread), 2).alias("requests_per_min"),
        "scrapers_with_metrics",
    )


def failed_scrapers(results: DataFrame, checks: DataFrame) -> DataFrame:
    """M6, per scraper: the ones that failed and why.

    ``results`` has ``scraper, all_passed, files_found, files_optional, requests_failed, failed_items_summary``.
    """
    names = checks.filter(~F.col("passed")).select("scraper", "check_name").distinct()
    first = first_rows(names, ["scraper"], ["check_name"], 5)
    listed = first.groupBy("scraper").agg(F.array_join(F.array_sort(F.collect_list("check_name")), ", ").alias("_names"))
    joined = results.filter(~F.coalesce("all_passed", F.lit(False))).join(listed, "scraper", "left")
    no_files = (F.coalesce("files_found", F.lit(0)) == 0) & ~F.coalesce("files_optional", F.lit(False))
    reason = F.concat_ws(
        "; ",
        F.when(no_files, "no Excel files"),
        F.concat(F.lit("validation: "), F.col("_names")),
        F.when(F.col("requests_failed") > 0, F.concat(F.col("requests_failed").cast("string"), F.lit(" HTTP error(s)"))),
        F.col("failed_items_summary"),
    )
    return joined.select(
        "scraper", F.when(reason == "", "validation failed").otherwise(reason).alias("reason"), "requests_failed", "error_rate_pct"
    )


def run_error_summary(results: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """M6, totals: scrapers passed and failed and the failed share in percent.

    With ``alerts`` also their number and the requests of all scrapers (M5) as ``http``. Both sides are one row.
    """
    failed = ~F.coalesce("all_passed", F.lit(False))
    totals = _run_totals(results, failed)
    if alerts is None:
        return totals
    requests = site_request_rollup(results, []).withColumnRenamed("scrapers_with_metrics", "scrapers_reporting")
    http = requests.select(F.lit(1).alias("_one"), F.struct(*requests.columns).alias("http"))
    raised = alerts.agg(F.count(F.lit(1)).alias("alert_count")).withColumn("_one", F.lit(1))
    return totals.withColumn("_one", F.lit(1)).join(raised, "_one").join(http, "_one").drop("_one")


def _run_totals(results: DataFrame, failed: Column) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("scrapers_total"),
        F.count_if(failed).alias("scrapers_failed"),
        F.count_if(~failed).alias("scrapers_passed"),
        pct_or_null(F.count_if(failed), F.count(F.lit(1)), 1).alias("validation_fail_rate_pct"),
    )


def scraper_results(doc: Column) -> Column:
    """(name, result) of each scraper in a report, whose ``scrapers`` is a list or an object."""
    listed = F.transform(
        V.items(doc, "$.scrapers"),
        lambda s, i: F.struct(
            F.coalesce(V.text(s, "$.scraper"), F.concat(F.lit("scraper_"), i.cast("string"))).alias("name"),
            s.alias("result"),
        ),
    )
    named = F.transform(
        F.map_entries(V.members(doc, "$.scrapers")),
        lambda e: F.struct(e["key"].alias("name"), e["value"].alias("result")),
    )
    return F.coalesce(listed, named, F.array().cast("array<struct<name:string,result:variant>>"))


def result_list(doc: Column) -> Column:
    return F.transform(scraper_results(doc), lambda s: s["result"])


def report_request_metrics(doc: Column, results: Column) -> Column:
    """M7: request figures of a report: root, then its metrics block, then its error summary, then its scrapers."""
    block = "requests_total: variant, requests_failed: variant, error_rate_pct: string, requests_per_min: string"
    names = ["requests_total", "requests_failed", "error_rate_pct", "requests_per_min"]
    report = f"struct<{block}, request_metrics: struct<{block}>, error_summary: struct<http: struct<{block}>>>"

    def figures(b: Column) -> Column:
        told = F.struct(
            V.told_whole(b["requests_total"]).alias("total"), V.told_whole(b["requests_failed"]).alias("failed"),
            b["error_rate_pct"].try_cast("double").alias("err"), b["requests_per_min"].try_cast("double").alias("rpm"),
        )
        return F.when(b.isNotNull(), told)

    zero = F.lit(0).cast("bigint")
    start = F.struct(
        zero.alias("n"), zero.alias("total"), zero.alias("failed"), zero.alias("rated"), F.lit(0.0).alias("rpm")
    )

    def add(sums: Column, r: Column) -> Column:
        return F.struct(
            (sums["n"] + 1).alias("n"),
            (sums["total"] + r["total"]).alias("total"),
            (sums["failed"] + F.coalesce(r["failed"], zero)).alias("failed"),
            (sums["rated"] + F.when(r["rpm"].isNotNull(), 1).otherwise(0)).cast("bigint").alias("rated"),
            (sums["rpm"] + F.coalesce(r["rpm"], F.lit(0.0))).alias("rpm"),
        )

    told = F.transform(F.transform(results, lambda r: V.get(r, "$", f"struct<{block}>")), figures)
    counted = F.aggregate(F.filter(told, lambda r: r["total"].isNotNull()), start, add)
    over_scrapers = let(
        counted,
        lambda c: F.when(
            c["n"] > 0,
            F.struct(
                c["total"].alias("total"), c["failed"].alias("failed"), pct_or_null(c["failed"], c["total"]).alias("err"),
                F.when(c["rated"] > 0, F.round(c["rpm"] / c["rated"], 2)).alias("rpm"),
            ),
        ),
    )

    def first_usable(f: Column) -> Column:
        blocks = F.array(F.struct(*[f[n].alias(n) for n in names]), f["request_metrics"], f["error_summary"]["http"])
        # a lower block that only lacks its total still gives way to the next one; the last one read stays
        return let(
            F.transform(blocks, figures),
            lambda b: F.coalesce(
                F.try_element_at(F.filter(b, lambda x: x["total"].isNotNull()), F.lit(1)), over_scrapers, b[2], b[1], b[0]
            ),
        )

    return let(V.get(doc, "$", report), first_usable)


def with_report_requests(reports: DataFrame, doc: str) -> DataFrame:
    """Add the four request columns of M7 to rows that hold a report document."""
    with_results = reports.withColumn("_r", result_list(F.col(doc)))
    found = with_results.withColumn("_m", report_request_metrics(F.col(doc), F.col("_r")))
    total = F.col("_m.total")
    failed = F.coalesce("_m.failed", F.when(total.isNotNull(), F.lit(0).cast("bigint")))
    return (
        found.withColumn("requests_total", total)
        .withColumn("requests_failed", failed)
        .withColumn("error_rate_pct", F.coalesce("_m.err", pct_or_null(failed, total)))
        .withColumn("requests_per_min", F.col("_m.rpm"))
        .drop("_m", "_r")
    )
