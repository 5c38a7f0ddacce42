"""Phone cells: tokens, normal form, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions.text import as_col, is_missing_cell, let, one_of

EASTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
WESTERN_DIGITS = "01234567890123456789"


def only_digits(value: Column) -> Column:
    return F.regexp_replace(F.translate(value, EASTERN_DIGITS, WESTERN_DIGITS), r"\D", "")


def truthy_flag(value: Column | str) -> Column:
    """V4: the words a sheet uses for yes."""
    return one_of(F.lower(F.trim(as_col(value))), rules.TRUE_WORDS)


def phone_tokens(value: Column | str) -> Column:
    """V1: digit runs of one cell. A cell may hold one number or a list written as text."""

    def scalar(cell: Column) -> Column:
        return F.when(is_missing_cell(cell), F.lit("")).otherwise(only_digits(cell))

    def cell_tokens(cell: Column) -> Column:
        inner = F.concat(F.lit("["), F.substr(cell, F.lit(2)))
        as_list = F.concat(F.regexp_replace(inner, r"[\]}]$", ""), F.lit("]"))
        # words of a list written by a program, where they stand for themselves and not in quotes
        as_json = F.regexp_replace(as_list, r"(?<=[\[,(])\s*(?:None|True|False|nan)\s*(?=[\],)])", "null")
        read = lambda c: F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})
        nested = lambda c: F.coalesce(F.when(c.rlike(r"^\s*\["), read(c)), F.array(c))
        parsed = F.flatten(F.transform(read(as_json), nested))
        listed = cell.rlike(r"(?s)^(\[.*\]|\{.*\})$")
        return F.filter(
            F.when(listed & parsed.isNotNull(), F.transform(parsed, scalar)).otherwise(F.array(scalar(cell))),
            lambda token: token != "",
        )

    text = F.coalesce(F.trim(as_col(value)), F.lit(""))
    return let(text, cell_tokens)


def longest_token(tokens: Column) -> Column:
    """The first of the longest tokens; empty text when there is none."""
    return F.aggregate(
        tokens, F.lit(""), lambda best, t: F.when(F.length(t) > F.length(best), t).otherwise(best)
    )


def normalize_phone(digits: Column | str) -> Column:
    """V2: country code and eight digits, or null."""
    code, size = rules.COUNTRY_CODE, rules.LOCAL_PHONE_LENGTH
    full = len(code) + size

    def body(d: Column) -> Column:
        return (
            F.when(F.length(d) == size, F.concat(F.lit(code), d))
            .when((F.length(d) == full) & d.startswith(code), d)
            .when(
                (F.length(d) == full + 1) & d.startswith(code + "0"),
                F.concat(F.lit(code), F.substr(d, F.lit(len(code) + 2))),
            )
        )

    raw = as_col(digits)
    return let(F.when(raw.startswith("00") & (F.length(raw) > 2), F.substr(raw, F.lit(3))).otherwise(raw), body)


def phone_facts(value: Column | str, hidden: Column | None = None) -> Column:
    """V3: struct of status, normal form and longest digit run of one cell."""
    hidden = F.lit(False) if hidden is None else F.coalesce(hidden, F.lit(False))
    code, size = rules.COUNTRY_CODE, rules.LOCAL_PHONE_LENGTH

    def judge(d: Column, normal: Column) -> Column:
        short, long_ = F.length(d) < size, F.length(d) > rules.MAX_PHONE_LENGTH
        status = (
            F.when(d == "", F.when(hidden, "hidden").otherwise("missing"))
            .when(short, "too_short")
            .when(long_, "too_long")
            .when(normal.isNull() & (F.length(d) >= 10) & ~d.startswith(code), "wrong_country_code")
            .when(normal.isNull(), "malformed")
            .when(~F.substring(normal, len(code) + 1, 1).isin(*rules.LOCAL_PHONE_PREFIXES), "invalid_local_prefix")
            .otherwise("valid")
        )
        return F.struct(
            status.alias("status"),
            F.when(~short & ~long_, normal).alias("phone"),
            F.nullif(d, F.lit("")).alias("digits"),
        )

    digits = longest_token(phone_tokens(value))
    return let(
        let(digits, lambda d: F.struct(d.alias("d"), normalize_phone(d).alias("n"))),
        lambda p: judge(p["d"], p["n"]),
    )


def classify_phone(value: Column | str, hidden: Column | None = None) -> Column:
    return phone_facts(value, hidden)["status"]
