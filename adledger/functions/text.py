"""Column expressions over text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adledger import rules


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` without repeating its work."""
    return F.element_at(F.transform(F.array(value), body), 1)


def one_of(value: Column, words: list[str]) -> Column:
    return F.coalesce(value.isin(*words), F.lit(False))


def no_texts() -> Column:
    return F.array().cast("array<string>")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(as_col(value)), F.lit(""))


def is_missing_cell(value: Column | str) -> Column:
    """Null, blank or one of the words a spreadsheet writes for an empty cell."""
    text = F.trim(as_col(value))
    return text.isNull() | (text == "") | F.lower(text).isin(*rules.NULL_WORDS)


def bare_header(name: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(as_col(name))), "[^a-z0-9]", "")


def canonical_column(name: Column | str) -> Column:
    """Q3: header reduced to letters and digits, then mapped by the alias table."""
    aliases = F.create_map(*[F.lit(x) for pair in rules.HEADER_ALIASES.items() for x in pair])
    return let(bare_header(name), lambda bare: F.coalesce(F.try_element_at(aliases, bare), bare))


def title_words(value: Column | str) -> Column:
    """Title case that starts a new word after every non-letter."""
    pieces = F.regexp_extract_all(as_col(value), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))),
        "",
    )


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``; 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def pct_or_null(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits))


def file_name(key: Column | str) -> Column:
    return F.regexp_extract(as_col(key), r"([^/]*)$", 1)


def suffix(key: Column | str) -> Column:
    """Last extension of the file name in lower case, with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(as_col(key), r"[^/](\.[^./]+)$", 1))


def shorten(value: Column, width: int) -> Column:
    return F.substring(value, 1, width)


def sheet_name(label: Column | str, rule: str = "ellipsis") -> Column:
    """G1: a group label cut to the sheet name limit by one of four rules."""
    text = as_col(label)
    limit = rules.SHEET_NAME_LIMIT
    if rule == "ellipsis":
        return F.when(F.length(text) <= limit, text).otherwise(
            F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
        )
    if rule == "cut":
        return F.substring(text, 1, limit)
    if rule == "slug":
        return F.substring(title_words(F.replace(text, F.lit("-"), F.lit(" "))), 1, limit)
    if rule == "clean":
        plain = F.regexp_replace(F.replace(text, F.lit(" "), F.lit("_")), r"[\\/*?:\[\]]", "")
        return F.substring(plain, 1, limit)
    raise ValueError(f"unknown sheet name rule: {rule}")


def is_valid_image_url(url: Column | str) -> Column:
    """P16 as an expression: a web address whose host is not known to refuse downloads."""
    blocked = F.lit(False)
    for host in rules.BLOCKED_IMAGE_HOSTS:
        blocked = blocked | F.lower(as_col(url)).contains(host)
    return F.coalesce(as_col(url).rlike("^https?://") & ~blocked, F.lit(False))
