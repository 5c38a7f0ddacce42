"""Dates and times written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adledger.functions.text import as_col

# fixed values: accepted spellings of a publish time
MOMENT_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd"]


def parse_moment(value: Column | str) -> Column:
    """Timestamp without zone, or null for text in no known format.

    Fractions of a second and a zone suffix are cut off first, so one format list serves all writers.
    """
    plain = F.regexp_replace(F.trim(as_col(value)), r"(\.\d+)?(Z|[+-]\d\d:?\d\d)?$", "")
    whole = F.when(F.trim(as_col(value)).rlike(r"\d\d:\d\d"), plain).otherwise(F.trim(as_col(value)))
    return F.coalesce(
        *[F.try_to_timestamp(whole, F.lit(fmt)).cast("timestamp_ntz") for fmt in MOMENT_FORMATS]
    )


def relative_age(published: Column | str, now: Column | str) -> Column:
    """Age by the largest calendar unit that is not zero.

    Whole months are counted by adding months to the publish time (so the last of January to the last of
    February is one month); days, hours and minutes are what is left after them.
    """
    start = F.try_to_timestamp(as_col(published), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    end = as_col(now).cast("timestamp_ntz")

    def after_months(n: Column) -> Column:
        clock = F.date_format(start, "HH:mm:ss")
        day = F.date_format(F.add_months(start.cast("date"), n), "yyyy-MM-dd")
        return F.concat(day, F.lit(" "), clock).cast("timestamp_ntz")

    rough = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    months = F.when(after_months(rough) > end, rough - 1).otherwise(rough)
    left = F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(after_months(months).cast("timestamp"))

    def phrase(n: Column, unit: str) -> Column:
        return F.concat(n.cast("string"), F.when(n > 1, f" {unit}s ago").otherwise(f" {unit} ago"))

    years = F.floor(months / 12)
    days, hours, minutes = F.floor(left / 86400), F.floor(left / 3600), F.floor(left / 60)
    return (
        F.when(start.isNull(), "Unknown")
        .when(start > end, "Just now")
        .when(years > 0, phrase(years, "year"))
        .when(months > 0, phrase(months, "month"))
        .when(days > 0, phrase(days, "day"))
        .when(hours > 0, phrase(hours, "hour"))
        .when(minutes > 0, phrase(minutes, "minute"))
        .otherwise("Just now")
    )
