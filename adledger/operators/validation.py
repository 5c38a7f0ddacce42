"""Row validation of phones and ad ids (V1-V15). Cell rules are in ``functions.phones`` and ``ad_ids``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.ad_ids import ad_id_facts
from adledger.functions.phones import longest_token, phone_facts, truthy_flag
from adledger.functions.text import bare_header, one_of, pct, shorten
from adledger.operators.ordering import first_rows, keep_rows
from adledger.session import saved

OK_PHONE = ["valid", "hidden", "missing"]


def data_sheets(rows: DataFrame) -> DataFrame:
    """Q1: rows of data sheets only."""
    return rows.filter(~F.lower(F.trim("sheet")).isin(*rules.SKIP_SHEETS))


def spelled_headers(headers: Column) -> Column:
    """Each header with its raw and bare spelling, worked out once for all roles."""
    return F.transform(
        headers,
        lambda h: F.struct(h.alias("name"), F.lower(F.trim(h)).alias("raw"), bare_header(h).alias("bare")),
    )


def role_of(spelled: Column, raw: list[str], canonical: list[str] | None = None) -> Column:
    """Q4: headers that play a role, in sheet order, from their spellings."""

    def plays(header: Column) -> Column:
        by_raw = one_of(header["raw"], raw)
        return by_raw | one_of(header["bare"], canonical) if canonical else by_raw

    return F.transform(F.filter(spelled, plays), lambda h: h["name"])


def role_headers(headers: Column, raw: list[str], canonical: list[str] | None = None) -> Column:
    """Q4: headers that play a role, in sheet order."""

    def plays(name: Column) -> Column:
        by_raw = one_of(F.lower(F.trim(name)), raw)
        return by_raw | one_of(bare_header(name), canonical) if canonical else by_raw

    return F.filter(headers, plays)


def phone_headers(headers: Column) -> Column:
    return role_headers(headers, rules.PHONE_COLUMNS, rules.PHONE_CANONICAL)


def first_header(headers: Column) -> Column:
    return F.try_element_at(headers, F.lit(1))


def find_columns(sheets: DataFrame) -> DataFrame:
    """Q4: role columns of every sheet. Ids are found by raw name when counting ads, and by raw or
    canonical name when validating."""
    columns = F.col("columns")
    return sheets.select(
        "file_key",
        "sheet",
        phone_headers(columns).alias("phone_columns"),
        first_header(role_headers(columns, rules.HIDE_COLUMNS)).alias("hide_column"),
        first_header(role_headers(columns, rules.ID_COLUMNS)).alias("id_column_raw"),
        first_header(role_headers(columns, rules.ID_COLUMNS, rules.ID_CANONICAL)).alias("id_column"),
        first_header(role_headers(columns, rules.DATE_COLUMNS)).alias("date_column"),
    )


def cell(header: Column) -> Column:
    """The row's cell under a header, null when the header is null or absent."""
    return F.when(header.isNotNull(), F.try_element_at(F.col("cells"), header))


def row_contact(rows: DataFrame) -> DataFrame:
    """V5: the contact of each row, from its first phone column that is not missing, and its id column.

    A hidden row with an empty first phone column is hidden at once; later columns are not looked at.
    Rows of sheets without phone columns get a null status.
    """
    spelled = F.col("_spelled")
    found = (
        rows.withColumn("_spelled", spelled_headers(F.map_keys("cells")))
        .withColumn("_phones", role_of(spelled, rules.PHONE_COLUMNS, rules.PHONE_CANONICAL))
        .withColumn("_hide", first_header(role_of(spelled, rules.HIDE_COLUMNS)))
        .withColumn("_hidden", truthy_flag(cell(F.col("_hide"))))
    )

    def look(header: Column) -> Column:
        value = F.try_element_at(F.col("cells"), header)
        facts = phone_facts(value, F.col("_hidden"))
        return F.struct(
            facts["status"].alias("status"), facts["phone"].alias("phone"),
            header.alias("column"), value.alias("value"),
        )

    looked = found.withColumn("_looked", F.transform("_phones", look))
    picked = looked.withColumn(
        "_pick", F.try_element_at(F.filter("_looked", lambda c: c["status"] != "missing"), F.lit(1))
    )
    some = F.size("_phones") > 0
    return picked.select(
        *rows.columns,
        F.when(some, F.coalesce(F.col("_pick.status"), F.lit("missing"))).alias("phone_status"),
        F.col("_pick.phone").alias("phone"),
        F.when(some, F.coalesce(F.col("_pick.column"), first_header(F.col("_phones")))).alias("phone_column"),
        F.col("_pick.value").alias("phone_value"),
        F.col("_phones").alias("phone_columns"),
        first_header(role_of(spelled, rules.ID_COLUMNS, rules.ID_CANONICAL)).alias("id_column"),
    )


def check_rows(rows: DataFrame) -> DataFrame:
    """Contact and ad id of every data row, before duplicates are known. No shuffle."""
    seen = row_contact(data_sheets(rows)).withColumn("id_value", cell(F.col("id_column")))
    facts = ad_id_facts(F.col("id_value"))
    return (
        seen.withColumn("_ad", F.when(F.col("id_column").isNotNull(), facts))
        .withColumn("ad_status", F.col("_ad.status"))
        .withColumn("ad_id", F.when(F.col("_ad.status") == "valid", F.col("_ad.ad_id")))
        .drop("_ad", "cells")
    )


def flag_duplicate_ids(checked: DataFrame) -> DataFrame:
    """V9: second and later rows of a valid id within one file become duplicates.

    The checked rows are written once, without their cells: both sides of the join below read them from there, so no cell
    is parsed again. The first place of each id is a minimum that is combined before the shuffle. Only ids that occur
    twice come back to the rows, which meet them by file and id; rows without an id meet nothing.
    """
    checked = saved(checked, "checked-rows")
    place = F.struct("sheet_pos", "row_no")
    per_id = checked.filter(F.col("ad_id").isNotNull()).groupBy(F.col("file_key").alias("_file"), F.col("ad_id").alias("_id"))
    many = per_id.agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    marked = checked.join(many, (F.col("file_key") == F.col("_file")) & (F.col("ad_id") == F.col("_id")), "left")
    repeated = F.coalesce((F.col("ad_status") == "valid") & (place > F.col("_first")), F.lit(False))
    return marked.withColumn("ad_status", F.when(repeated, "duplicate").otherwise(F.col("ad_status"))).drop("_file", "_id", "_first")


COUNTERS = [
    "rows_scanned", "phones_seen", "phones_valid", "phones_invalid", "phones_missing", "phones_hidden", "ads_seen",
    "ads_ok", "ads_bad", "ads_missing",
]


def _file_values(checked: DataFrame) -> DataFrame:
    """Per file one row of counters per sheet and one row per distinct valid phone and id.

    Each checked row gives up to three entries that are added up where they are read, so a hot file or a hot
    value never meets in one task as rows, and every later count comes from this one scan. What is the same for
    a whole sheet is part of the key, which leaves plain sums to aggregate.
    """
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), F.col(value).alias("value"))
    entries = F.filter(
        F.array(
            entry("sheet", "sheet"),
            F.when(F.col("phone_status") == "valid", entry("phone", "phone")),
            F.when(F.col("ad_id").isNotNull(), entry("ad_id", "ad_id")),
        ),
        lambda e: e.isNotNull(),
    )
    head = F.struct(F.col("sheet_pos"), F.col("id_column"), F.col("phone_columns"))
    rows = checked.select("scraper", "file_key", "phone_status", "ad_status", head.alias("_head"), F.inline(entries))
    phone, ad, row = F.col("phone_status"), F.col("ad_status"), F.col("kind") == "sheet"
    tests = {
        "rows_scanned": row,
        "phones_seen": row & phone.isNotNull(),
        "phones_valid": row & (phone == "valid"),
        "phones_invalid": row & ~phone.isin(*OK_PHONE),
        "phones_missing": row & (phone == "missing"),
        "phones_hidden": row & (phone == "hidden"),
        "ads_seen": row & ad.isNotNull(),
        "ads_ok": row & (ad == "valid"),
        "ads_bad": row & ad.isin("missing", "malformed"),
        "ads_missing": row & (ad == "missing"),
    }
    keyed = rows.withColumn("head", F.when(row, F.col("_head")))
    return keyed.groupBy("scraper", "file_key", "kind", "value", "head").agg(
        *[F.count_if(tests[c]).alias(c) for c in COUNTERS]
    )


def _first_id(*place: str) -> Column:
    """Id column of the first sheet that has one."""
    known = F.col("head.id_column").isNotNull()
    order = F.struct(*place, F.col("head.sheet_pos").alias("pos"), F.col("head.id_column").alias("id_column"))
    return F.min(F.when(known, order))


def _ad_totals(df: DataFrame) -> DataFrame:
    """Repeats are valid ids minus distinct ids per file, so no row has to be ordered for the counts."""
    repeats = F.col("ads_ok") - F.col("ads_valid")
    return (
        df.withColumn("ads_duplicates", repeats)
        .withColumn("ads_invalid", F.col("ads_bad") + repeats)
        .withColumn("columns_found", F.array_sort("columns_found"))
        .drop("ads_ok", "ads_bad")
    )


def _of_readable(checked: DataFrame, files: DataFrame | None) -> DataFrame:
    if files is None:
        return checked
    return checked.join(files.filter("readable").select("scraper", "file_key").distinct(), ["scraper", "file_key"], "left_semi")


def _with_zeros(df: DataFrame) -> DataFrame:
    """Counts of files and scrapers that gave no rows become zero, and their column lists empty."""
    counts = {c: 0 for c, kind in df.dtypes if kind in ("bigint", "int")}
    return df.fillna(counts).withColumn("columns_found", F.coalesce("columns_found", F.array().cast("array<string>")))


def file_validation(checked: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Counts per file.

    With the list of ``files`` (scraper, file_key, readable) every listed file has a row: one without data rows has
    zeros, and one that is not readable has zeros whatever rows are known of it.
    """
    kind = F.col("kind")
    per_file = _file_values(_of_readable(checked, files)).groupBy("scraper", "file_key").agg(
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.count_if(kind == "sheet").alias("sheets_scanned"),
        F.array_distinct(F.flatten(F.collect_set("head.phone_columns"))).alias("columns_found"),
        _first_id().getField("id_column").alias("id_column"),
        F.count_if(kind == "phone").alias("phones_unique_valid"),
        F.count_if(kind == "ad_id").alias("ads_unique_valid"),
        F.count_if(kind == "ad_id").alias("ads_valid"),
    )
    counted = _ad_totals(per_file)
    if files is None:
        return counted
    return _with_zeros(files.select("scraper", "file_key", "readable").join(counted, ["scraper", "file_key"], "left"))


def reason_histogram(checked: DataFrame) -> DataFrame:
    """Rows per status, for phones and for ids."""
    kinds = F.filter(
        F.array(
            F.struct(F.lit("phone").alias("kind"), F.col("phone_status").alias("reason")),
            F.struct(F.lit("ad_id").alias("kind"), F.col("ad_status").alias("reason")),
        ),
        lambda k: k["reason"].isNotNull(),
    )
    return checked.select("scraper", F.inline(kinds)).groupBy("scraper", "kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def invalid_samples(flagged: DataFrame, limit: int = rules.SAMPLE_LIMIT, merged: bool = False) -> DataFrame:
    """The first invalid cells of each file, phones and ids apart; ``merged``: of each scraper over its files in order."""
    bad_phone = F.col("phone_status").isNotNull() & ~F.col("phone_status").isin(*OK_PHONE)
    bad_id = F.col("ad_status").isin("missing", "malformed", "duplicate")

    def entry(kind: str, column: str, value: Column, reason: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.col(column).alias("column"),
            shorten(value, rules.SAMPLE_WIDTH).alias("value"),
            F.col(reason).alias("reason"),
        )

    id_value = F.when(F.col("ad_status") == "missing", "").otherwise(F.col("id_value"))
    found = F.filter(
        F.array(
            F.when(bad_phone, entry("phone", "phone_column", F.col("phone_value"), "phone_status")),
            F.when(bad_id, entry("ad_id", "id_column", id_value, "ad_status")),
        ),
        lambda e: e.isNotNull(),
    )
    cells = flagged.select("scraper", "file_key", "sheet", "sheet_pos", "row_no", F.inline(found))
    group, order = (["scraper", "kind"], ["file_key", "sheet_pos", "row_no"]) if merged else (["file_key", "kind"], ["sheet_pos", "row_no"])
    picked = first_rows(cells, group, order, limit)
    return picked.select(
        "scraper", "file_key", "kind", "sheet", (F.col("row_no") + 2).alias("row"), "column", "value", "reason"
    )


def scraper_validation(checked: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Files merged per scraper. Uniques are distinct over the scraper, repeats stay per file.

    One scan and a chain of aggregations: per file and value, then per scraper and value, then per scraper. With the
    list of ``files`` the files found and readable are those listed, and a scraper whose files hold no data rows has zeros.
    """
    kind = F.col("kind")
    group = F.when(kind == "sheet", F.col("file_key")).otherwise(F.col("value"))
    per_value = _file_values(_of_readable(checked, files)).groupBy("scraper", "kind", group.alias("value")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.array_distinct(F.flatten(F.collect_set("head.phone_columns"))).alias("columns_found"),
        _first_id("file_key").alias("first_id"),
    )
    merged = per_value.groupBy("scraper").agg(
        F.count_if(kind == "sheet").alias("files_found"),
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.sum(F.when(kind == "sheet", F.col("n"))).alias("sheets_scanned"),
        F.array_distinct(F.flatten(F.collect_set("columns_found"))).alias("columns_found"),
        F.min("first_id").getField("id_column").alias("id_column"),
        F.count_if(kind == "phone").alias("phones_unique_valid"),
        F.count_if(kind == "ad_id").alias("ads_unique_valid"),
        F.coalesce(F.sum(F.when(kind == "ad_id", F.col("n"))), F.lit(0)).alias("ads_valid"),
    )
    counted = _ad_totals(merged)
    if files is not None:
        listed = files.groupBy("scraper").agg(F.count(F.lit(1)).alias("files_found"), F.count_if("readable").alias("files_readable"))
        counted = _with_zeros(listed.join(counted.drop("files_found"), "scraper", "left"))
    return (
        counted
        .withColumn("phones_valid_pct", pct(F.col("phones_valid"), F.col("phones_seen")))
        .withColumn("phones_invalid_pct", pct(F.col("phones_invalid"), F.col("phones_seen")))
        .withColumn("ads_valid_pct", pct(F.col("ads_valid"), F.col("ads_seen")))
        .withColumn("ads_invalid_pct", pct(F.col("ads_invalid"), F.col("ads_seen")))
    )


def validation_gate(
    merged: DataFrame,
    scrapers: DataFrame,
    max_phone_pct: float = rules.INVALID_PCT_LIMIT,
    max_ads_pct: float = rules.INVALID_PCT_LIMIT,
) -> DataFrame:
    """Pass or the reasons for failing, for every configured scraper."""
    joined = scrapers.select("scraper", "files_optional").join(merged, "scraper", "left")
    none_found = F.col("files_found").isNull()

    def over(column: str, label: str, limit: float) -> Column:
        too_many = F.col(column) > F.lit(limit)
        return F.when(too_many, F.concat(F.lit(f"{label}="), F.col(column).cast("string"), F.lit(f">{limit}")))

    reasons = F.filter(
        F.array(
            F.when(none_found & ~F.coalesce("files_optional", F.lit(False)), "no_excel_files"),
            F.when(~none_found & (F.col("phones_seen") == 0) & (F.col("ads_seen") == 0), "no_phone_or_id_columns"),
            F.when(F.col("phones_seen") > 0, over("phones_invalid_pct", "phone_invalid_pct", max_phone_pct)),
            F.when(F.col("ads_seen") > 0, over("ads_invalid_pct", "ads_invalid_pct", max_ads_pct)),
        ),
        lambda r: r.isNotNull(),
    )
    return joined.withColumn("fail_reasons", reasons).withColumn("passed", F.size("fail_reasons") == 0)


TOTALS = [
    "files_found", "rows_scanned", "phones_seen", "phones_valid", "phones_invalid", "phones_missing",
    "phones_hidden", "ads_seen", "ads_valid", "ads_invalid", "ads_missing", "ads_duplicates",
]


def validation_totals(gated: DataFrame) -> DataFrame:
    """Totals over scrapers. Unique counts are added up, not made distinct again."""
    return (
        gated.agg(
            F.count(F.lit(1)).alias("scrapers_total"),
            F.count_if("passed").alias("scrapers_passed"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS],
            F.coalesce(F.sum("phones_unique_valid"), F.lit(0)).alias("phones_unique_valid_sum"),
            F.coalesce(F.sum("ads_unique_valid"), F.lit(0)).alias("ads_unique_valid_sum"),
        )
        .withColumn("phones_valid_pct", pct(F.col("phones_valid"), F.col("phones_seen")))
        .withColumn("phones_invalid_pct", pct(F.col("phones_invalid"), F.col("phones_seen")))
        .withColumn("ads_valid_pct", pct(F.col("ads_valid"), F.col("ads_seen")))
        .withColumn("ads_invalid_pct", pct(F.col("ads_invalid"), F.col("ads_seen")))
    )


def phone_identities(rows: DataFrame, *carried: str) -> DataFrame:
    """``scraper, status, identity`` of every phone cell that tells one.

    Every phone column counts. A phone is known by its normal form, else by its longest digit run.
    """
    headers = phone_headers(F.map_keys("cells"))
    cells = data_sheets(rows).select("scraper", *carried, F.explode(F.transform(headers, lambda h: F.try_element_at("cells", h))).alias("value"))
    facts = cells.withColumn("_f", phone_facts(F.col("value")))
    runs = F.regexp_extract_all("value", F.lit(r"\d+"), F.lit(0))
    named = facts.select(
        "scraper", *carried,
        F.col("_f.status").alias("status"),
        F.coalesce("_f.phone", F.nullif(longest_token(runs), F.lit(""))).alias("identity"),
    )
    return keep_rows(named, (F.col("status") != "missing") & F.col("identity").isNotNull())


def phone_sets(rows: DataFrame) -> DataFrame:
    """V6: distinct phones per scraper: all, valid, of another country, invalid.

    One pre-aggregation per phone replaces four distinct counts.
    """
    known = phone_identities(rows)
    valid, outside = F.col("status") == "valid", F.col("status") == "wrong_country_code"
    per_phone = known.groupBy("scraper", "identity").agg(
        F.max(valid).alias("valid"), F.max(outside).alias("outside"), F.max(~valid & ~outside).alias("invalid")
    )
    return per_phone.groupBy("scraper").agg(
        F.count(F.lit(1)).alias("unique_phones"),
        F.count_if("valid").alias("valid_phones"),
        F.count_if("invalid").alias("invalid_phones"),
        F.count_if("outside").alias("outside_country_phones"),
    )
