"""Baselines and trend checks (B1-B8). ``history`` is the sheets table with a ``date`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.text import shorten
from adledger.operators.inspection import _checks, _entry, file_rows, files_of

KEEP_DATES = 30


def keep_recent_dates(dates: Column, n: int = KEEP_DATES) -> Column:
    """The last ``n`` of a set of dates, ascending. Minimum and maximum stay all-time."""
    newest = F.slice(F.sort_array(F.array_distinct(dates), asc=False), 1, n)
    return F.array_sort(newest)


def build_baseline(history: DataFrame) -> DataFrame:
    """B1: size minimum, maximum, last and the observed dates of each scraper."""
    files = history.groupBy("scraper", "file_key", "date").agg(F.max("size_bytes").alias("size_bytes"))
    kb = F.round(F.col("size_bytes") / 1024, 1)
    return files.groupBy("scraper").agg(
        F.min(kb).alias("size_min"),
        F.max(kb).alias("size_max"),
        F.max(F.struct("date", "file_key", kb.alias("kb"))).getField("kb").alias("size_last"),
        keep_recent_dates(F.collect_set("date")).alias("observed_dates"),
    )


def build_sheet_baseline(history: DataFrame) -> DataFrame:
    """B2: row counts and the union of columns in first-seen order of each sheet.

    Columns are made distinct before they are gathered, so a list never holds more than a sheet's headers.
    """
    counts = history.groupBy("scraper", "sheet").agg(
        F.min("row_count").alias("rows_min"),
        F.max("row_count").alias("rows_max"),
        F.max(F.struct("date", "file_key", "row_count")).getField("row_count").alias("rows_last"),
    )
    seen = history.select("scraper", "sheet", "date", "file_key", F.posexplode("columns").alias("pos", "column"))
    first = seen.groupBy("scraper", "sheet", "column").agg(F.min(F.struct("date", "file_key", "pos")).alias("first"))
    columns = first.groupBy("scraper", "sheet").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("first", "column"))), lambda c: c["column"]).alias("columns")
    )
    return counts.join(columns, ["scraper", "sheet"], "left")


def merge_baseline(old: DataFrame, new: DataFrame) -> DataFrame:
    """New observations folded into stored ones."""
    o, n = old.alias("o"), new.alias("n")
    dates = F.concat(
        F.coalesce("o.observed_dates", F.array().cast("array<string>")),
        F.coalesce("n.observed_dates", F.array().cast("array<string>")),
    )
    return o.join(n, F.col("o.scraper") == F.col("n.scraper"), "full").select(
        F.coalesce("o.scraper", "n.scraper").alias("scraper"),
        F.least("o.size_min", "n.size_min").alias("size_min"),
        F.greatest("o.size_max", "n.size_max").alias("size_max"),
        F.coalesce("n.size_last", "o.size_last").alias("size_last"),
        keep_recent_dates(dates).alias("observed_dates"),
    )


def merge_sheet_baseline(old: DataFrame, new: DataFrame) -> DataFrame:
    """B4 for sheets."""
    o, n = old.alias("o"), new.alias("n")
    same = (F.col("o.scraper") == F.col("n.scraper")) & (F.col("o.sheet") == F.col("n.sheet"))
    none = F.array().cast("array<string>")
    return o.join(n, same, "full").select(
        F.coalesce("o.scraper", "n.scraper").alias("scraper"),
        F.coalesce("o.sheet", "n.sheet").alias("sheet"),
        F.least("o.rows_min", "n.rows_min").alias("rows_min"),
        F.greatest("o.rows_max", "n.rows_max").alias("rows_max"),
        F.coalesce("n.rows_last", "o.rows_last").alias("rows_last"),
        F.array_distinct(F.concat(F.coalesce("o.columns", none), F.coalesce("n.columns", none))).alias("columns"),
    )


def _watched(baseline: DataFrame, min_days: int) -> DataFrame:
    return baseline.filter(F.size("observed_dates") >= min_days)


def _size_terms(min_pct: float) -> tuple[Column, Column, Column]:
    """Name, outcome and detail of B5."""
    least = F.col("size_min") * (min_pct / 100.0)
    kb = F.col("size_bytes") / 1024
    detail = F.concat(
        F.round(kb, 1).cast("string"), F.lit(" KB vs "), F.round(least, 1).cast("string"),
        F.lit(f" KB ({min_pct:.0f}% of hist min "), F.col("size_min").cast("string"), F.lit(" KB)"),
    )
    return F.lit("trend_file_size"), kb >= least, detail


def check_size_trend(sheets: DataFrame, baseline: DataFrame, min_days: int = 3, min_pct: float = 50.0) -> DataFrame:
    """Size of at least a share of the historic minimum, once enough days were seen."""
    joined = files_of(sheets).join(_watched(baseline, min_days).select("scraper", "size_min"), "scraper").filter(
        F.col("size_min").isNotNull()
    )
    return _checks(joined, *_size_terms(min_pct), sheet=None)


def skip_volatile(sheets: DataFrame, profiles: DataFrame) -> DataFrame:
    """Sheets whose row counts may be compared with history."""
    volatile = profiles.filter(F.coalesce("skip_sheet_trend_checks", F.lit(False))).select("scraper")
    return sheets.filter(F.col("sheet") != "Info").join(volatile, "scraper", "left_anti")


def _row_trend(sheets: DataFrame, baseline: DataFrame, sheet_baseline: DataFrame, min_days: int) -> DataFrame:
    watched = _watched(baseline, min_days).select("scraper")
    stats = sheet_baseline.select("scraper", "sheet", "rows_min", "rows_max").join(watched, "scraper", "left_semi")
    return sheets.filter("readable").join(stats, ["scraper", "sheet"])


def _row_terms(prefix: str, word: str, limit: Column, passed: Column, pct: float, bound: str) -> tuple[Column, Column, Column]:
    name = F.concat(F.lit(prefix), shorten(F.col("sheet"), rules.TREND_LABEL_LIMIT))
    detail = F.concat(
        F.col("row_count").cast("string"), F.lit(f" rows vs {word} "), limit.cast("string"),
        F.lit(f" ({pct:.0f}% of hist {bound[-3:]} "), F.col(bound).cast("string"), F.lit(")"),
    )
    return name, passed, detail


def _low_terms(min_pct: float) -> tuple[Column, Column, Column]:
    """Name, outcome and detail of B6."""
    floor = F.greatest(F.lit(1).cast("bigint"), (F.col("rows_min") * (min_pct / 100.0)).cast("bigint"))
    return _row_terms("trend_rows_low_", "floor", floor, F.col("row_count") >= floor, min_pct, "rows_min")


def _high_terms(max_pct: float) -> tuple[Column, Column, Column]:
    """Name, outcome and detail of B7."""
    ceiling = (F.col("rows_max") * (max_pct / 100.0)).cast("bigint")
    return _row_terms("trend_rows_high_", "ceiling", ceiling, F.col("row_count") <= ceiling, max_pct, "rows_max")


def check_rows_low(sheets, baseline, sheet_baseline, min_days: int = 3, min_pct: float = 30.0) -> DataFrame:
    """Rows of at least a share of the historic minimum, never less than one."""
    return _checks(_row_trend(sheets, baseline, sheet_baseline, min_days).filter("rows_min > 0"), *_low_terms(min_pct))


def check_rows_high(sheets, baseline, sheet_baseline, min_days: int = 3, max_pct: float = 300.0) -> DataFrame:
    """Rows of at most a multiple of the historic maximum."""
    return _checks(_row_trend(sheets, baseline, sheet_baseline, min_days).filter("rows_max > 0"), *_high_terms(max_pct))


def trend_checks(
    sheets: DataFrame, baseline: DataFrame, sheet_baseline: DataFrame, profiles: DataFrame,
    min_days: int = 3, min_size_pct: float = 50.0, min_rows_pct: float = 30.0, max_rows_pct: float = 300.0,
) -> DataFrame:
    """Size and row trends as one check set, from one read of the sheets and of each baseline.

    A file's row is spread to one part for its size and one for each sheet that may be compared (B8).
    """
    volatile = profiles.groupBy("scraper").agg(F.bool_or(F.coalesce("skip_sheet_trend_checks", F.lit(False))).alias("volatile"))
    known = _watched(baseline, min_days).select("scraper", "size_min").join(volatile, "scraper", "left")
    files = file_rows(sheets.filter("readable")).join(known, "scraper")
    steady = F.filter("sheets", lambda s: (s["sheet"] != "Info") & ~F.coalesce("volatile", F.lit(False)))
    own = F.lit(None).cast(files.schema["sheets"].dataType.elementType)
    spread = files.select("scraper", "file_key", "size_bytes", "size_min", F.explode(F.concat(F.array(own), steady)).alias("_s"))
    parts = spread.select("scraper", "file_key", "size_bytes", "size_min", F.col("_s").isNull().alias("_own"), "_s.sheet", "_s.row_count")
    told = parts.join(sheet_baseline.select("scraper", "sheet", "rows_min", "rows_max"), ["scraper", "sheet"], "left")
    none, name = F.lit(None).cast("string"), F.col("sheet")
    entries = F.array(
        F.when(F.col("_own") & F.col("size_min").isNotNull(), _entry(none, *_size_terms(min_size_pct))),
        F.when(~F.col("_own") & (F.col("rows_min") > 0), _entry(name, *_low_terms(min_rows_pct))),
        F.when(~F.col("_own") & (F.col("rows_max") > 0), _entry(name, *_high_terms(max_rows_pct))),
    )
    return told.select("scraper", "file_key", F.inline(F.filter(entries, lambda e: e.isNotNull())))
