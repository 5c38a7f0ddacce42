"""Ad id cells: normal form and status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.phones import EASTERN_DIGITS, WESTERN_DIGITS, longest_token
from adledger.functions.text import as_col, is_missing_cell, let


def normalize_ad_id(value: Column | str) -> Column:
    """V7: digits without leading zeros, else the first of the longest digit runs, else null."""

    def body(cell: Column) -> Column:
        zeros_cut = F.regexp_replace(cell, "^0+", "")
        runs = F.regexp_extract_all(cell, F.lit(r"\d+"), F.lit(0))
        return (
            F.when(is_missing_cell(cell), F.lit(None).cast("string"))
            .when(cell.rlike(r"^\d+$"), F.when(zeros_cut == "", "0").otherwise(zeros_cut))
            .otherwise(F.nullif(longest_token(runs), F.lit("")))
        )

    plain = F.regexp_replace(F.trim(F.translate(as_col(value), EASTERN_DIGITS, WESTERN_DIGITS)), r"^(\d+)\.0$", "$1")
    return let(plain, body)


def ad_id_facts(value: Column | str) -> Column:
    """V8: struct of status and normal form of one id cell."""

    def body(normal: Column) -> Column:
        status = (
            F.when(is_missing_cell(value), "missing")
            .when(normal.isNull() | (F.length(normal) < rules.MIN_AD_ID_LENGTH), "malformed")
            .otherwise("valid")
        )
        return F.struct(status.alias("status"), normal.alias("ad_id"))

    return let(normalize_ad_id(value), body)
