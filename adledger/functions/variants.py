"""Reading JSON documents whose shape varies, through the VARIANT type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from adledger.functions.text import as_col, let


def parse(text: Column | str) -> Column:
    """JSON text to VARIANT; null when it is not JSON."""
    return F.try_parse_json(as_col(text))


def get(doc: Column | str, path: str, kind: str) -> Column:
    return F.try_variant_get(as_col(doc), path, kind)


def text(doc: Column | str, path: str) -> Column:
    return get(doc, path, "string")


def items(doc: Column | str, path: str) -> Column:
    """Elements of a list; null when the path holds no list."""
    return get(doc, path, "array<variant>")


def members(doc: Column | str, path: str) -> Column:
    """Members of an object by name; null when the path holds no object."""
    return get(doc, path, "map<string,variant>")


def fields(doc: Column | str, names: list[str]) -> Column:
    """The named members of an object in one read, as a struct of VARIANT; null when it is no object."""
    return get(doc, "$", "struct<" + ", ".join(f"`{n}`: variant" for n in dict.fromkeys(names)) + ">")


def kind(doc: Column | str, path: str = "$") -> Column:
    return F.schema_of_variant(get(doc, path, "variant"))


def is_number(doc: Column | str, path: str = "$") -> Column:
    return F.coalesce(F.substring(kind(doc, path), 1, 3).isin("BIG", "DEC", "DOU", "FLO"), F.lit(False))


def is_object(doc: Column | str, path: str = "$") -> Column:
    """Whether the path holds an object. Asking for a struct looks at no field, while a schema would walk them all."""
    return get(doc, path, "struct<_:variant>").isNotNull()


def is_text(doc: Column | str, path: str = "$") -> Column:
    nested = is_object(doc, path) | get(doc, path, "array<variant>").isNotNull()
    return F.when(nested, F.lit(False)).otherwise(F.coalesce(kind(doc, path) == "STRING", F.lit(False)))


def number(doc: Column | str, path: str) -> Column:
    """A JSON number as double; text that looks like a number does not count."""
    value = get(doc, path, "double")
    return F.when(value.isNotNull(), F.when(is_number(doc, path), value))


def count_value(doc: Column | str, path: str) -> Column:
    """A JSON number that is not negative, cut to a whole number."""
    return F.when(get(doc, path, "double") >= 0, F.when(is_number(doc, path), get(doc, path, "bigint")))


def first_count(docs: list[Column], keys: list[str]) -> Column:
    return F.coalesce(*[count_value(d, f"$.{k}") for d in docs for k in keys])


def first_measure(docs: list[Column], keys: list[str]) -> Column:
    found = []
    for doc in docs:
        for key in keys:
            value = get(doc, f"$.{key}", "double")
            found.append(F.when(value >= 0, F.when(is_number(doc, f"$.{key}"), value)))
    return F.coalesce(*found)


def told_first(values: list[Column], read: Callable[[Column], Column]) -> Column:
    """What ``read`` makes of the first of some VARIANT values that it makes anything of.

    ``read`` is planned once, and run only for values that are there.
    """
    there = F.filter(F.array(*values), lambda v: v.isNotNull())
    return F.try_element_at(F.filter(F.transform(there, read), lambda v: v.isNotNull()), F.lit(1))


def number_kind(kind_: Column) -> Column:
    return F.substring(kind_, 1, 3).isin("BIG", "DEC", "DOU", "FLO")


def told_count(value: Column) -> Column:
    """``count_value`` of a scalar that was read before."""
    return F.when((get(value, "$", "double") >= 0) & number_kind(F.schema_of_variant(value)), get(value, "$", "bigint"))


def told_measure(value: Column) -> Column:
    """A JSON number that is not negative, of a scalar that was read before."""
    return let(get(value, "$", "double"), lambda d: F.when((d >= 0) & number_kind(F.schema_of_variant(value)), d))


def told_whole(value: Column) -> Column:
    """``whole`` of a scalar that was read before."""
    return F.when(number_kind(F.schema_of_variant(value)), get(value, "$", "bigint")).otherwise(safe_int(text(value, "$")))


def told_text(value: Column) -> Column:
    """Text of a scalar that was read before, trimmed; null when it is blank."""
    return F.nullif(F.trim(text(value, "$")), F.lit(""))


def told_items(values: list[Column]) -> Column:
    """The elements of all lists among some VARIANT values that were read before, in their order."""
    none = F.array().cast("array<variant>")
    return F.flatten(F.transform(F.array(*values), lambda v: F.coalesce(items(v, "$"), none)))


def wholes(doc: Column | str, names: list[str]) -> Column:
    """``whole`` of the named members of an object, in one read, as an array in the order of the names."""
    return let(fields(doc, names), lambda f: F.transform(F.array(*[f[n] for n in names]), told_whole))


def first_text(doc: Column, keys: list[str]) -> Column:
    """First key whose text is not blank, trimmed; null when none is."""
    return F.coalesce(*[F.nullif(F.trim(text(doc, f"$.{k}")), F.lit("")) for k in keys])


def whole(doc: Column | str, path: str) -> Column:
    """whole number or null; numbers are cut, text must be a whole number."""
    told = F.when(is_number(doc, path), get(doc, path, "bigint")).otherwise(safe_int(text(doc, path)))
    return F.when(get(doc, path, "variant").isNotNull(), told)


def real(doc: Column | str, path: str) -> Column:
    return get(doc, path, "string").try_cast("double")


def safe_int(value: Column | str) -> Column:
    """text of a whole number to bigint, null for anything else."""
    trimmed = F.trim(as_col(value))
    return F.when(trimmed.rlike(r"^[+-]?\d+$"), trimmed.try_cast("bigint"))


def safe_float(value: Column | str) -> Column:
    return F.trim(as_col(value)).try_cast("double")


def non_negative_int(value: Column | str, default: int = 0) -> Column:
    parsed = safe_int(value)
    return F.when(parsed >= 0, parsed).otherwise(F.lit(default).cast("bigint"))
