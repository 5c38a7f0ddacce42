"""Sheet inspection against the expected schema (Q1-Q15).

Check sets share one shape: ``scraper, file_key, sheet, check_name, passed, detail``. ``sheet`` keeps the full
name, the check name carries it cut to a label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.text import canonical_column, no_texts, one_of, shorten
from adledger.operators.validation import data_sheets, first_header, role_headers

CHECK_COLUMNS = ["scraper", "file_key", "sheet", "check_name", "passed", "detail"]


def sheet_profile(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Q2: header list and row count of each sheet, 0 rows for a sheet that only has a header."""
    counted = rows.groupBy("file_key", "sheet").agg(F.count(F.lit(1)).alias("row_count"))
    return headers.join(counted, ["file_key", "sheet"], "left").na.fill(0, ["row_count"])


def files_of(sheets: DataFrame) -> DataFrame:
    return sheets.groupBy("scraper", "file_key").agg(
        F.max("size_bytes").alias("size_bytes"), F.bool_and("readable").alias("readable")
    )


def is_template(name: Column) -> Column:
    found = F.lit(False)
    for marker in rules.TEMPLATE_MARKERS:
        found = found | name.contains(marker)
    return found


def file_rows(sheets: DataFrame) -> DataFrame:
    """One row per file with size, readability and ``sheets``, the sheets of its workbook in their order."""
    sheet = F.struct("sheet_pos", "sheet", "row_count", "columns")
    return sheets.groupBy("scraper", "file_key").agg(
        F.max("size_bytes").alias("size_bytes"), F.bool_and("readable").alias("readable"), F.array_sort(F.collect_list(sheet)).alias("sheets")
    )


def expectations(expected: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per scraper of the schema: ``configs``, its expected sheets under its profile, and the least file size."""
    optional = F.coalesce("p.optional_columns", no_texts())
    template = is_template(F.col("e.name"))
    core = (F.size(F.coalesce("p.core_columns", no_texts())) > 0) & (template | (F.col("e.name") != "Info"))
    config = F.struct(
        F.col("e.name").alias("expected_name"),
        template.alias("is_template"),
        F.coalesce("p.data_sheet_aliases", no_texts()).alias("aliases"),
        F.when(core, F.col("p.core_columns")).otherwise(F.coalesce("e.required_columns", no_texts())).alias("required_columns"),
        F.when(template, optional).otherwise(F.concat(F.coalesce("e.optional_columns", no_texts()), optional)).alias("optional_columns"),
        F.coalesce("e.row_min", F.lit(0)).cast("bigint").alias("row_min"),
        F.coalesce("e.row_max", F.lit(999999)).cast("bigint").alias("row_max"),
    )
    skipped = F.coalesce("p.skip_info_sheet", F.lit(False)) & (F.col("e.name") == "Info")
    joined = expected.alias("e").join(profiles.alias("p"), F.col("e.scraper") == F.col("p.scraper"), "left")
    return joined.groupBy(F.col("e.scraper").alias("scraper")).agg(
        F.collect_list(F.when(~skipped, config)).alias("configs"),
        F.coalesce(F.max("p.min_file_size_kb"), F.max("e.min_file_size_kb"), F.lit(0.0)).alias("least_kb"),
    )


def expected_files(sheets: DataFrame, expected: DataFrame, profiles: DataFrame, how: str = "inner") -> DataFrame:
    """The file rows with what is expected of them: all that the checks of a file look at, in one row."""
    return file_rows(sheets).join(expectations(expected, profiles), "scraper", how)


def _fits(config: Column, sheets: Column) -> Column:
    """The sheets that one expected sheet stands for, of those of a file; empty when there is none."""
    plain_data = lambda s: ~s["sheet"].isin("Info", "No Data")
    alias_place = lambda s: F.array_position(config["aliases"], s["sheet"])

    def of_template(s: Column) -> Column:
        filled = (alias_place(s) > 0) | (plain_data(s) & (s["row_count"] > 0))
        return F.when(F.size(config["aliases"]) > 0, filled).otherwise(plain_data(s))

    def place(s: Column) -> Column:
        return F.when(s["sheet"] == config["expected_name"], 0).when(alias_place(s) > 0, alias_place(s))

    placed = F.transform(sheets, lambda s: F.struct(place(s).alias("place"), s.alias("found")))
    named = F.slice(F.array_sort(F.filter(placed, lambda x: x["place"].isNotNull())), 1, 1)
    return F.when(config["is_template"], F.filter(sheets, of_template)).otherwise(F.transform(named, lambda x: x["found"]))


MATCH_COLUMNS = ["expected_name", "is_template", "required_columns", "optional_columns", "row_min", "row_max"]


def _matched(files: DataFrame, carried: list[str]) -> DataFrame:
    """A row per sheet that an expected sheet of ``config`` stands for; ``carried`` columns come along."""
    each = files.select(*carried, "config", F.explode_outer(_fits(F.col("config"), F.col("sheets"))).alias("_fit"))
    return each.select(*carried, *[F.col("config")[c].alias(c) for c in MATCH_COLUMNS], *[F.col("_fit")[c].alias(c) for c in ("sheet", "row_count", "columns")])


def match_expected_sheets(sheets: DataFrame, expected: DataFrame, profiles: DataFrame) -> DataFrame:
    """Q6: the observed sheets each expected sheet stands for; a null sheet when there is none.

    A template stands for all data sheets of a file. An exact name stands for the sheet of that name, else for
    the first alias present. Which sheet fits is decided inside the file's row.
    """
    files = expected_files(sheets, expected, profiles).filter("readable")
    return _matched(files.withColumn("config", F.explode("configs")), ["scraper", "file_key"])


def missing_columns(matches: DataFrame) -> DataFrame:
    """Q5: required columns a sheet lacks, core and optional apart, by canonical name.

    Header lists are a few dozen names inside one row, so this needs no join.
    """
    with_names = matches.withColumn("_seen", F.transform("columns", canonical_column)).withColumn(
        "_allowed", F.transform("optional_columns", canonical_column)
    )

    def lacking(name: Column) -> Column:
        canon = canonical_column(name)
        excused = (canon == "link") & F.array_contains("_seen", "slug")
        return ~F.array_contains(F.col("_seen"), canon) & ~excused

    def optional(name: Column) -> Column:
        canon = canonical_column(name)
        return one_of(canon, rules.OPTIONAL_HEADERS) | F.array_contains(F.col("_allowed"), canon)

    return (
        with_names.withColumn("_missing", F.filter("required_columns", lacking))
        .withColumn("missing_core", F.filter("_missing", lambda n: ~optional(n)))
        .withColumn("missing_optional", F.filter("_missing", optional))
        .drop("_seen", "_allowed", "_missing")
    )


def _label(prefix: str, sheet: Column) -> Column:
    return F.concat(F.lit(prefix), shorten(sheet, rules.CHECK_LABEL_LIMIT))


def _checks(df: DataFrame, name: Column, passed: Column, detail: Column, sheet: str | None = "sheet") -> DataFrame:
    return df.select(
        "scraper", "file_key",
        (F.col(sheet) if sheet else F.lit(None).cast("string")).alias("sheet"),
        name.alias("check_name"), passed.alias("passed"), detail.alias("detail"),
    )


def _entry(sheet: Column, label: Column, passed: Column, detail: Column) -> Column:
    """One check of a file inside its row."""
    return F.struct(sheet.alias("sheet"), label.alias("check_name"), passed.alias("passed"), detail.alias("detail"))


def _match_entries(kinds: tuple[str, ...]) -> Column:
    """Q7-Q9: the checks that apply to a match, as an array.

    ``columns`` (Q7): a sheet with rows passes when no core column is missing; a sheet without rows passes as
    skipped. ``range`` (Q8): rows within the expected range; empty sheets of a template are not checked, exact
    ones are. ``exists`` (Q9): an expected sheet, or every data sheet of a template, is absent.
    """
    rows, name, template = F.col("row_count"), F.col("sheet"), F.col("is_template")
    found, filled = name.isNotNull(), F.col("row_count") > 0
    told_as = F.when(template, name).otherwise(F.col("expected_name"))

    def entry(label: Column, passed: Column, detail: Column) -> Column:
        return _entry(name, label, passed, detail)

    missing = F.concat_ws(
        "; ",
        F.when(F.size("missing_core") > 0, F.concat(F.lit("Missing core: "), F.array_join("missing_core", ", "))),
        F.when(F.size("missing_optional") > 0, F.concat(F.lit("optional absent: "), F.array_join("missing_optional", ", "))),
        F.when(F.size("missing_core") > 0, F.concat(F.lit("actual headers: "), F.array_join(F.slice("columns", 1, 12), ", "), F.when(F.size("columns") > 12, "…").otherwise(""))),
    )
    bounds = F.concat(
        rows.cast("string"), F.lit(" rows (expected "), F.col("row_min").cast("string"), F.lit("-"),
        F.col("row_max").cast("string"), F.lit(")"),
    )
    entries = {
        "columns": F.when(
            found,
            entry(
                F.when(filled, _label("columns_in_", told_as)).otherwise(_label("rows_in_", told_as)),
                F.when(filled, F.size("missing_core") == 0).otherwise(F.lit(True)),
                F.when(filled, missing).otherwise(F.lit("0 rows, skipped")),
            ),
        ),
        "range": F.when(
            found & (~template | filled),
            entry(_label("rows_in_", told_as), rows.between(F.col("row_min"), F.col("row_max")), bounds),
        ),
        "exists": F.when(
            ~found,
            entry(
                F.when(template, "data_sheets_exist").otherwise(F.concat(F.lit("sheet_exists_"), F.col("expected_name"))),
                F.lit(False),
                F.when(template, "No data sheets found").otherwise(
                    F.concat(F.lit("Sheet '"), F.col("expected_name"), F.lit("' not found"))
                ),
            ),
        ),
    }
    return F.filter(F.array(*[entries[k] for k in kinds]), lambda e: e.isNotNull())


def match_checks(matches: DataFrame, kinds: tuple[str, ...] = ("columns", "range", "exists")) -> DataFrame:
    """Q7-Q9 in one pass over the matches, as many check rows per match as apply."""
    told = missing_columns(matches) if "columns" in kinds else matches
    return told.select("scraper", "file_key", F.inline(_match_entries(kinds)))


def check_sheet_columns(matches: DataFrame) -> DataFrame:
    """Q7."""
    return match_checks(matches, ("columns",))


def check_row_range(matches: DataFrame) -> DataFrame:
    """Q8."""
    return match_checks(matches, ("range",))


def check_sheet_exists(matches: DataFrame) -> DataFrame:
    """Q9."""
    return match_checks(matches, ("exists",))


def check_file_readable(files: DataFrame) -> DataFrame:
    """Q10: an unreadable file fails; no other check looks at it."""
    return _checks(files, F.lit("file_readable"), F.col("readable"), F.lit(""), sheet=None)


def _kb(size: Column) -> Column:
    return size / 1024


def _size_terms(least: Column) -> tuple[Column, Column]:
    """Whether ``size_bytes`` reaches the least size, and how that is told."""
    kb = _kb(F.col("size_bytes"))
    return kb >= least, F.concat(F.round(kb, 1).cast("string"), F.lit(" KB (min "), least.cast("string"), F.lit(" KB)"))


def check_file_size(files: DataFrame, expected: DataFrame, profiles: DataFrame) -> DataFrame:
    """Q11: size of at least the profile's minimum, else the schema's, else 0."""
    schema = expected.groupBy("scraper").agg(F.max("min_file_size_kb").alias("_schema_kb"))
    own = profiles.select("scraper", F.col("min_file_size_kb").alias("_profile_kb"))
    joined = files.filter("readable").join(schema, "scraper").join(own, "scraper", "left")
    return _checks(joined, F.lit("file_size_ok"), *_size_terms(F.coalesce("_profile_kb", "_schema_kb", F.lit(0.0))), sheet=None)


def check_size_floor(files: DataFrame, floors: DataFrame) -> DataFrame:
    """Q12: size of at least the floor observed for the scraper; no floor, no check."""
    joined = files.join(floors, "scraper")
    kb = _kb(F.col("size_bytes"))
    detail = F.concat(F.round(kb, 1).cast("string"), F.lit(" KB (observed floor "), F.col("floor_kb").cast("string"), F.lit(" KB)"))
    return _checks(joined, F.lit("observed_file_size_floor"), kb >= F.col("floor_kb"), detail, sheet=None)


def schema_checks(sheets: DataFrame, expected: DataFrame, profiles: DataFrame, unchecked: bool = False) -> DataFrame:
    """All schema checks of all files as one table, from one read of the sheets.

    A file's row is spread to one part for the file itself and one for each expected sheet, and each part tells its
    checks. With ``unchecked``, a file of which nothing is expected has one row with a null check.
    """
    files = expected_files(sheets, expected, profiles, "left" if unchecked else "inner")
    configs = F.col("configs")
    own = F.lit(None).cast(files.schema["configs"].dataType.elementType)
    # an unreadable file has only its own part
    parts = F.concat(F.array(own), F.when(F.col("readable") & configs.isNotNull(), configs).otherwise(F.slice(configs, 1, 0)))
    spread = files.withColumn("config", F.explode(F.coalesce(parts, F.array(own)))).withColumn("_own", F.col("config").isNull())
    matched = missing_columns(_matched(spread, ["scraper", "file_key", "size_bytes", "readable", "least_kb", "_own"]))
    none = F.lit(None).cast("string")
    of_file = F.array(
        _entry(none, F.lit("file_readable"), F.col("readable"), F.lit("")),
        F.when(F.col("readable"), _entry(none, F.lit("file_size_ok"), *_size_terms(F.col("least_kb")))),
    )
    entries = F.when(~F.col("_own"), _match_entries(("columns", "range", "exists"))).when(
        F.col("least_kb").isNotNull(), F.filter(of_file, lambda e: e.isNotNull())
    )
    if not unchecked:
        return matched.select("scraper", "file_key", F.inline(entries))
    told = matched.select("scraper", "file_key", "least_kb", F.inline_outer(entries))
    return told.filter(F.col("check_name").isNotNull() | F.col("least_kb").isNull()).drop("least_kb")


def file_verdict(checks: DataFrame) -> DataFrame:
    """Q13: a file passes when all its checks pass."""
    return checks.groupBy("scraper", "file_key").agg(
        F.bool_and("passed").alias("passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count("check_name").alias("checks_total"),
    )


def scraper_verdict(verdicts: DataFrame, scrapers: DataFrame) -> DataFrame:
    """Q14: a scraper passes when all its files pass. None found fails unless optional; unchecked files pass.

    ``verdicts`` has a row for every file found, an unchecked one with no checks and a null verdict.
    """
    checked = verdicts.groupBy("scraper").agg(
        F.count(F.lit(1)).alias("files_found"),
        F.bool_and("passed").alias("_passed"),
        F.sum("checks_passed").alias("checks_passed"),
        F.sum("checks_total").alias("checks_total"),
    )
    joined = scrapers.select("scraper", "files_optional").join(checked, "scraper", "left")
    n = F.coalesce("files_found", F.lit(0))
    optional = F.coalesce("files_optional", F.lit(False))
    return joined.select(
        "scraper",
        n.alias("files_found"),
        F.coalesce("checks_passed", F.lit(0)).alias("checks_passed"),
        F.coalesce("checks_total", F.lit(0)).alias("checks_total"),
        F.when(n == 0, optional).otherwise(F.coalesce("_passed", F.lit(True))).alias("all_passed"),
        (optional & (n == 0)).alias("files_optional"),
    )


def quality_metrics(rows: DataFrame, day: str) -> DataFrame:
    """Q15: per sheet repeated ids, shares of null id, title and price, and of rows not of the day."""
    headers = F.map_keys("cells")

    def value_of(names: list[str]) -> Column:
        header = first_header(F.filter(headers, lambda h: F.lower(h).isin(*names)))
        return F.struct(header.isNotNull().alias("has"), F.when(header.isNotNull(), F.try_element_at("cells", header)).alias("v"))

    picked = rows.filter(F.col("sheet") != "Info").select(
        "scraper", "file_key", "sheet",
        value_of(rules.QUALITY_ID_COLUMNS).alias("id"),
        value_of(["title"]).alias("title"),
        value_of(["price"]).alias("price"),
        value_of(rules.DATE_COLUMNS).alias("date"),
    )

    def share(test: Column, has: str) -> Column:
        hit = F.count_if(test & F.col(has))
        return F.round(hit * 100.0 / F.count(F.lit(1)), 1)

    with_id = F.count_if("id.has")
    distinct = F.count_distinct("id.v") + F.max(F.when(F.col("id.has") & F.col("id.v").isNull(), 1).otherwise(0))
    stale = ~F.coalesce(F.col("date.v").startswith(day), F.lit(False))
    return picked.groupBy("scraper", "file_key", "sheet").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.when(with_id > 0, with_id - distinct).otherwise(F.lit(0)).cast("bigint").alias("duplicate_id_count"),
        share(F.col("id.v").isNull(), "id.has").alias("null_id_pct"),
        share(F.col("title.v").isNull(), "title.has").alias("null_title_pct"),
        share(F.col("price.v").isNull(), "price.has").alias("null_price_pct"),
        share(stale, "date.has").alias("stale_date_pct"),
    )

