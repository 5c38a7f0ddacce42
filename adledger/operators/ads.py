"""Ad counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.moments import parse_moment
from adledger.functions.text import is_missing_cell, let
from adledger.operators.ordering import keep_rows
from adledger.operators.validation import cell, data_sheets, first_header, role_headers


def id_values(rows: DataFrame, *carried: str) -> DataFrame:
    """Id text of each row, null where there is none, and whether its sheet has an id column."""
    headers = F.map_keys("cells")
    header = first_header(role_headers(headers, rules.ID_COLUMNS))
    value = F.trim(cell(F.col("_h")))
    empty = (value == "") | F.lower(value).isin("nan", "none")
    return (
        data_sheets(rows)
        .withColumn("_h", header)
        .select("scraper", *carried, F.col("_h").isNotNull().alias("has_id"), F.when(~empty, value).alias("ad_id"))
    )


def unique_ads(rows: DataFrame) -> DataFrame:
    """A1: distinct id texts per scraper over its files and sheets; null when no sheet has an id column."""
    return id_values(rows).groupBy("scraper").agg(
        F.count_distinct("ad_id").alias("_n"), F.bool_or("has_id").alias("has_id")
    ).select("scraper", F.when(F.col("has_id"), F.col("_n")).alias("unique_ads"))


def count_ads(rows: DataFrame, scrapers: DataFrame) -> DataFrame:
    """A2: ids when any sheet has an id column, else rows, else 0, for every scraper."""
    counted = id_values(rows).groupBy("scraper").agg(
        F.count_distinct("ad_id").alias("ids"),
        F.bool_or("has_id").alias("has_id"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    has_id = F.coalesce("has_id", F.lit(False))
    rows_n = F.coalesce("total_rows", F.lit(0))
    return scrapers.select("scraper").join(counted, "scraper", "left").select(
        "scraper",
        F.when(has_id, F.col("ids")).otherwise(rows_n).alias("unique_ads"),
        rows_n.alias("total_rows"),
        F.when(has_id, "excel_ids").when(rows_n > 0, "excel_rows").otherwise("none").alias("ads_source"),
    )


def summary_total(doc: Column) -> Column:
    """A3: total of a summary document: the root total, else the sum over its nested lists.

    In nested lists the first total of an item counts, and a number under ``listings`` is added on top.
    """

    def of_item(f: Column) -> Column:
        total = V.told_first([f[k] for k in rules.TOTAL_KEYS], V.told_count)
        number = F.when(V.number_kind(F.schema_of_variant(f["listings"])), V.get(f["listings"], "$", "double"))
        listings = number.cast("bigint")
        return F.when(total.isNotNull() | listings.isNotNull(), F.coalesce(total, F.lit(0)) + F.coalesce(listings, F.lit(0)))

    def of_document(f: Column) -> Column:
        root = V.told_first([f[k] for k in rules.TOTAL_KEYS], V.told_count)
        listed = V.told_items([f[k] for k in rules.TOTAL_LISTS])
        totals = F.transform(listed, lambda i: let(V.fields(i, [*rules.TOTAL_KEYS, "listings"]), of_item))
        nested = let(
            F.filter(totals, lambda t: t.isNotNull()),
            lambda parts: F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, t: a + t)),
        )
        return F.when(f.isNotNull(), F.coalesce(root, nested))

    return let(V.fields(doc, [*rules.TOTAL_KEYS, *rules.TOTAL_LISTS]), of_document)


def subcategory_rows(doc: Column, strict: bool = False) -> Column:
    """A5, one document: array of (subcategory, level_3, n) before grouping.

    A category whose children are plain names keeps its own row; ``strict`` drops it.
    """
    none = F.array().cast("array<struct<subcategory:string,level_3:string,n:bigint>>")
    filled = lambda v: let(V.items(v, "$"), lambda c: F.when(F.size(c) > 0, c))

    def child_row(f: Column, name: Column) -> Column:
        return F.struct(
            F.coalesce(name, F.lit("(unknown)")).alias("subcategory"),
            V.told_first([f[k] for k in rules.CHILD_NAME_KEYS], V.told_text).alias("level_3"),
            F.coalesce(V.told_first([f[k] for k in rules.BREAKDOWN_COUNT_KEYS], V.told_count), F.lit(0)).cast("bigint").alias("n"),
        )

    def rows_of(told: Column) -> Column:
        read = F.transform(told["children"], lambda c: V.fields(c, [*rules.CHILD_NAME_KEYS, *rules.BREAKDOWN_COUNT_KEYS]))
        objects = F.filter(read, lambda f: f.isNotNull())
        nested = F.filter(F.transform(objects, lambda f: child_row(f, told["name"])), lambda r: r["level_3"].isNotNull())
        own = F.when(
            told["name"].isNotNull() & told["n"].isNotNull(),
            F.array(F.struct(told["name"].alias("subcategory"), F.lit("").alias("level_3"), told["n"].alias("n"))),
        )
        no_children = F.size(told["children"]) == 0 if strict else F.size(objects) == 0
        return F.when(no_children, F.coalesce(own, none)).otherwise(nested)

    def category_rows(f: Column) -> Column:
        children = V.told_first([f[k] for k in rules.BREAKDOWN_CHILDREN], filled)
        told = F.struct(
            V.told_first([f[k] for k in rules.CATEGORY_NAME_KEYS], V.told_text).alias("name"),
            F.coalesce(children, F.array().cast("array<variant>")).alias("children"),
            V.told_first([f[k] for k in rules.BREAKDOWN_COUNT_KEYS], V.told_count).alias("n"),
        )
        return F.when(f.isNotNull(), let(told, rows_of))

    listed = let(V.fields(doc, rules.BREAKDOWN_LISTS), lambda f: V.told_items([f[k] for k in rules.BREAKDOWN_LISTS]))
    read = F.transform(listed, lambda i: V.fields(i, [*rules.CATEGORY_NAME_KEYS, *rules.BREAKDOWN_CHILDREN, *rules.BREAKDOWN_COUNT_KEYS]))
    return F.flatten(F.transform(F.filter(read, lambda f: f.isNotNull()), category_rows))


def subcategory_breakdown(docs: DataFrame, strict: bool = False) -> DataFrame:
    """A5: category and child counts of each document ``(scraper, key, body)``."""
    parsed = docs.select("scraper", "key", V.parse("body").alias("doc"))
    rows = parsed.select("scraper", "key", F.inline(subcategory_rows(F.col("doc"), strict)))
    return rows.groupBy("scraper", "key", "subcategory", "level_3").agg(
        F.sum("n").alias("ads_count"), F.sum("n").alias("sheet_rows"), F.count(F.lit(1)).alias("sheets_count")
    ).withColumn("source", F.lit("json_summary"))


def best_summary(docs: DataFrame) -> DataFrame:
    """A4: per scraper the document with the largest total; the first by path form and key on a tie.

    Without any total, the first document that has a breakdown is named for it.
    """
    parsed = docs.select("scraper", "key", "prefix_form", V.parse("body").alias("doc"))
    totalled = parsed.withColumn("total", summary_total(F.col("doc")))
    # the breakdown is only looked at where there is no total
    has_rows = F.when(F.col("total").isNull(), F.size(subcategory_rows(F.col("doc"))) > 0)
    facts = totalled.select("scraper", "key", "prefix_form", "total", has_rows.alias("has_rows"))
    place = F.struct("prefix_form", "key")
    # larger total first, then the smaller place: the minimum of (-total, place)
    return facts.groupBy("scraper").agg(
        F.min(F.when(F.col("total").isNotNull(), F.struct((-F.col("total")).alias("minus"), "prefix_form", "key"))).alias("_best"),
        F.min(F.when(F.col("total").isNull() & F.col("has_rows"), place)).alias("_rows"),
    ).select(
        "scraper",
        (-F.col("_best.minus")).alias("json_total"),
        F.col("_best.key").alias("json_key"),
        F.coalesce("_best.key", "_rows.key").alias("breakdown_key"),
    )


def resolve_ad_count(sheets: DataFrame, best: DataFrame) -> DataFrame:
    """Sheet ids, else the JSON total, else sheet rows, else none."""
    joined = sheets.join(best, "scraper", "left")
    by_id = F.col("ads_source") == "excel_ids"
    by_json = ~by_id & F.col("json_total").isNotNull()
    return joined.select(
        "scraper",
        F.when(by_json, F.col("json_total")).otherwise(F.col("unique_ads")).alias("unique_ads"),
        F.when(by_json & (F.col("total_rows") == 0), F.col("json_total")).otherwise(F.col("total_rows")).alias("total_rows"),
        F.when(by_json, "json_summary").otherwise(F.col("ads_source")).alias("ads_source"),
        F.col("json_key").alias("json_summary_key"),
    )


def hour_histogram(rows: DataFrame) -> DataFrame:
    """Rows per hour of their publish time; unreadable times are left out."""
    header = first_header(role_headers(F.map_keys("cells"), rules.DATE_COLUMNS))
    dated = data_sheets(rows).withColumn("_h", header)
    value = cell(F.col("_h"))
    moment = F.when(~is_missing_cell(value), parse_moment(value))
    hours = keep_rows(dated.select("scraper", F.hour(moment).alias("hour")), F.col("hour").isNotNull())
    return hours.groupBy("scraper", "hour").agg(F.count(F.lit(1)).alias("ads_count"))


def hour_pairs(result: Column) -> Column:
    """A8, one scraper result: (hour, count) pairs from the first populated shape it has.

    Lists come before maps, the root before its containers; hours outside 0-23 are dropped.
    """
    kind = "array<struct<hour:bigint,n:bigint>>"

    def usable(pairs: Column) -> Column:
        kept = F.filter(pairs, lambda p: p["hour"].between(0, 23))
        return F.when(F.size(kept) > 0, kept.cast(kind))

    def count_of(doc: Column, path: str) -> Column:
        value = V.whole(doc, path)
        return F.when(value >= 0, value).otherwise(F.lit(0).cast("bigint"))

    def from_list(path: str) -> Column:
        def pair(item: Column) -> Column:
            has_ads = F.array_contains(F.map_keys(V.members(item, "$")), "ads_count")
            n = F.when(has_ads, count_of(item, "$.ads_count")).otherwise(count_of(item, "$.count"))
            return F.struct(V.whole(item, "$.hour").alias("hour"), n.alias("n"))

        return usable(F.transform(F.filter(V.items(result, path), lambda i: V.is_object(i)), pair))

    def from_map(path: str) -> Column:
        def pair(entry: Column) -> Column:
            return F.struct(V.safe_int(entry["key"]).alias("hour"), count_of(entry["value"], "$").alias("n"))

        return usable(F.transform(F.map_entries(V.members(result, path)), pair))

    paths_of = lambda keys: [f"$.{k}" for k in keys] + [f"$.{c}.{k}" for c in rules.HOUR_CONTAINERS for k in keys]
    shapes = [from_list(p) for p in paths_of(rules.HOUR_LIST_KEYS)]
    shapes += [from_map(p) for p in paths_of(rules.HOUR_MAP_KEYS)]
    return F.coalesce(*shapes)


def hour_counts_from_report(results: DataFrame) -> DataFrame:
    """Counts per hour of scraper results ``(…keys, result VARIANT)``."""
    keys = [c for c in results.columns if c != "result"]
    pairs = results.select(*keys, F.inline(hour_pairs(F.col("result"))))
    return pairs.groupBy(*keys, F.col("hour").cast("int").alias("hour")).agg(F.sum("n").alias("ads_count"))
