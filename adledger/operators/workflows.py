"""Workflow names, runs and their status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.text import as_col, no_texts, one_of



def is_monitor_workflow(name: Column | str) -> Column:
    """Whether a workflow is a monitoring job rather than a scraper."""
    label = as_col(name)
    low = F.lower(label)
    monitor = (
        one_of(label, rules.MONITOR_WORKFLOWS) | label.startswith("Monitor Hub")
        | low.contains("schema monitor") | low.endswith(" r2 monitor")
    )
    return F.coalesce((label != "") & monitor, F.lit(False))


def split_workflow_names(label: Column | str) -> Column:
    """The workflow names of a label joined by arrows or commas, monitors left out."""
    parts = F.split(F.regexp_replace(as_col(label), "→|->", ","), ",")
    names = F.transform(parts, lambda p: F.regexp_replace(F.trim(p), "^\"+|\"+$|^'+|'+$", ""))
    return F.filter(names, lambda n: (n != "") & ~is_monitor_workflow(n))


def join_names(names: Column) -> Column:
    return F.when(F.size(names) > 0, F.array_join(names, rules.WORKFLOW_ARROW))


def workflow_names(workflows: Column, single: Column, owner: Column, repo: Column) -> Column:
    """Configured workflow names in order; none without an owner and a repository."""
    placed = (F.coalesce(F.trim(owner), F.lit("")) != "") & (F.coalesce(F.trim(repo), F.lit("")) != "")
    listed = F.flatten(F.transform(workflows, split_workflow_names))
    lone = F.when(~is_monitor_workflow(single), split_workflow_names(single))
    names = F.when(workflows.isNotNull(), listed).otherwise(F.coalesce(lone, no_texts()))
    return F.when(placed, F.coalesce(names, no_texts())).otherwise(no_texts())


def configured_names(prefix: str = "") -> Column:
    at = lambda c: F.col(f"{prefix}{c}")
    return workflow_names(at("workflows"), at("workflow_name"), at("github_username"), at("repo"))


def _report_names(doc: Column) -> Column:
    """Names configured in a report document itself."""
    entry = lambda w: F.coalesce(F.when(V.is_text(w), V.text(w, "$")), V.text(w, "$.name"), V.text(w, "$.workflow"))
    listed = F.filter(F.transform(V.items(doc, "$.workflows"), entry), lambda n: n.isNotNull())
    one = F.when(V.is_text(doc, "$.workflows"), F.array(V.text(doc, "$.workflows")))
    return workflow_names(
        F.coalesce(listed, one), V.text(doc, "$.workflow_name"), V.text(doc, "$.github_username"), V.text(doc, "$.repo")
    )


def _is_missing(label: Column) -> Column:
    text = F.trim(label)
    return text.isNull() | (text == "") | text.isin(*rules.MISSING_LABELS)


def stored_name(doc: Column) -> Column:
    return V.text(doc, "$.github_run.workflow_name")


def run_items(doc: Column) -> Column:
    runs = V.items(doc, "$.github_run.workflows")
    return F.filter(F.coalesce(runs, F.array().cast("array<variant>")), lambda w: V.is_object(w))


def bad_conclusion(conclusion: Column) -> Column:
    return conclusion.isNotNull() & ~conclusion.isin("success", "skipped", "cancelled")


def workflow_status(doc: Column, site_status: Column) -> Column:
    """Stored status, else failure when any run ended badly, else the site's own status."""
    runs = run_items(doc)
    from_runs = F.when(
        F.size(runs) > 0,
        F.when(F.exists(runs, lambda w: bad_conclusion(V.text(w, "$.conclusion"))), "failure").otherwise("success"),
    )
    stored = F.when(~is_monitor_workflow(stored_name(doc)), V.text(doc, "$.github_run.workflow_status"))
    own = F.when(site_status == "ok", "success").when(site_status == "failed", "failure")
    return F.coalesce(stored, from_runs, own)


def workflow_duration(doc: Column) -> Column:
    """Seconds over all scraper runs, else the stored duration; never a monitor's."""

    def seconds(run: Column) -> Column:
        start = F.coalesce(V.text(run, "$.run_started_at"), V.text(run, "$.started_at")).try_cast("timestamp")
        end = F.coalesce(V.text(run, "$.updated_at"), V.text(run, "$.finished_at")).try_cast("timestamp")
        spent = F.greatest(F.lit(0).cast("bigint"), F.unix_seconds(end) - F.unix_seconds(start))
        return F.coalesce(V.whole(run, "$.duration_sec"), F.when(start.isNotNull() & end.isNotNull(), spent))

    runs = F.filter(run_items(doc), lambda w: ~is_monitor_workflow(V.text(w, "$.name")))
    known = F.filter(F.transform(runs, seconds), lambda s: s.isNotNull())
    total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("bigint"), lambda a, s: a + s))
    return F.when(
        ~is_monitor_workflow(stored_name(doc)), F.coalesce(total, V.whole(doc, "$.github_run.duration_sec"))
    )


def workflow_label(doc: Column, registry_names: Column, registry_single: Column) -> Column:
    """Stored name, else configured names, else names of runs, else a legacy name, else a dash."""
    stored = F.when(~_is_missing(stored_name(doc)) & ~is_monitor_workflow(stored_name(doc)), stored_name(doc))
    run_names = F.filter(
        F.transform(run_items(doc), lambda w: V.text(w, "$.name")),
        lambda n: n.isNotNull() & (n != "") & ~is_monitor_workflow(n),
    )
    legacy = F.coalesce(F.nullif(registry_single, F.lit("")), F.nullif(V.text(doc, "$.workflow_name"), F.lit("")))
    return F.coalesce(
        stored,
        join_names(F.coalesce(registry_names, no_texts())),
        join_names(_report_names(doc)),
        join_names(run_names),
        F.when(~is_monitor_workflow(legacy), legacy),
        F.lit("—"),
    )


def run_reference(doc: Column, path: str) -> Column:
    """Run id or number, null when the stored run is a monitor's."""
    return F.when(~is_monitor_workflow(stored_name(doc)), V.text(doc, f"$.github_run.{path}"))


def lookback_start(partition_date: Column, schedule: Column) -> Column:
    """First moment a run may have started, by schedule."""
    table = F.create_map(*[F.lit(x) for pair in rules.RUN_LOOKBACK_DAYS.items() for x in pair])
    name = F.regexp_replace(F.lower(F.coalesce(schedule, F.lit("daily"))), "[ -]", "_")
    days = F.coalesce(F.try_element_at(table, name), F.lit(rules.RUN_LOOKBACK_DEFAULT))
    return F.date_sub(partition_date.cast("date"), days).cast("timestamp_ntz")


def wanted_runs(sites: DataFrame, partition_date: str) -> DataFrame:
    """One row per configured workflow of a site, in order."""
    return sites.select(
        "site_id",
        F.trim("github_username").alias("owner"),
        F.trim("repo").alias("repo"),
        lookback_start(F.lit(partition_date), F.col("schedule")).alias("not_before"),
        F.posexplode(configured_names()).alias("pos", "name"),
    )


def latest_run(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The newest completed run of each wanted workflow that started late enough.

    A maximum over structs, so each task passes on one run per workflow however many there are.
    """
    done = runs.filter(F.col("status") == "completed")
    fits = done.join(wanted, ["owner", "repo", "name"]).filter(F.col("run_started_at") >= F.col("not_before"))
    newest = F.max(F.struct("run_started_at", "run_id", "run_number", "conclusion", "duration_sec"))
    return fits.groupBy("site_id", "pos", "owner", "repo", "name").agg(newest.alias("_r")).select(
        "site_id", "pos", "owner", "repo", "name", "_r.run_id", "_r.run_number", "_r.conclusion", "_r.duration_sec",
        "_r.run_started_at",
    )


def pipeline_run_meta(runs: DataFrame, sites: DataFrame, partition_date: str) -> DataFrame:
    """Name, status, duration and last run of each site over its configured workflows, in order.

    A site without any run keeps its configured name and nulls.
    """
    wanted = wanted_runs(sites, partition_date)
    found = latest_run(runs, wanted)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda e: e["name"])
    per_site = found.groupBy("site_id").agg(
        ordered.alias("_names"),
        F.max(bad_conclusion(F.col("conclusion"))).alias("_bad"),
        F.sum(F.coalesce("duration_sec", F.lit(0))).alias("duration_sec"),
        F.max(F.struct("pos", "run_id", "run_number")).alias("_last"),
    )
    legacy = F.when(~is_monitor_workflow(F.col("workflow_name")), F.nullif("workflow_name", F.lit("")))
    named = sites.withColumn("_configured", configured_names()).join(per_site, "site_id", "left")
    complete = F.coalesce(F.size("_names") == F.size("_configured"), F.lit(False))
    hit = F.col("_last").isNotNull()
    return named.select(
        "site_id",
        F.when(hit, join_names(F.when(complete, F.col("_names")).otherwise(F.col("_configured"))))
        .otherwise(F.coalesce(join_names(F.col("_configured")), legacy, F.lit("—"))).alias("workflow_name"),
        F.when(hit, F.when(F.col("_bad"), "failure").otherwise("success")).alias("workflow_status"),
        F.when(hit, F.col("duration_sec")).alias("duration_sec"),
        F.col("_last.run_id").cast("string").alias("workflow_run_id"),
        F.col("_last.run_number").alias("workflow_run_number"),
        F.when(hit, "run_table").otherwise("registry_fallback").alias("source"),
    )
