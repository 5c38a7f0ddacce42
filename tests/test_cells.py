"""Literal cases of the cell rules."""

import pytest
from pyspark.sql import functions as F

from adledger.functions import phones, text
from adledger.functions.ad_ids import ad_id_facts
from adledger.functions.moments import parse_moment, relative_age
from adledger.operators import alerts, layout, listings, pages

PHONES = [
    ("51234567", False, "valid", "96551234567"),
    ("96551234567", False, "valid", "96551234567"),
    ("0096551234567", False, "valid", "96551234567"),
    ("965051234567", False, "valid", "96551234567"),
    ("+965 5123-4567", False, "valid", "96551234567"),
    ("1234567", False, "too_short", None),
    ("12345678901234", False, "too_long", None),
    ("4471234567", False, "wrong_country_code", None),
    ("31234567", False, "invalid_local_prefix", "96531234567"),
    ("512345678", False, "malformed", None),
    (None, False, "missing", None),
    (None, True, "hidden", None),
    ("nan", True, "hidden", None),
    ("['96551234567']", False, "valid", "96551234567"),
    ('["12", "96551234567"]', False, "valid", "96551234567"),
    ("[96551234567]", False, "valid", "96551234567"),
    ("{'96551234567'}", False, "valid", "96551234567"),
    ("['nan']", False, "missing", None),
    ("[not a list", False, "missing", None),
    ("nan", False, "missing", None),
    ("٩٦٥٥١٢٣٤٥٦٧", False, "valid", "96551234567"),
]


def test_phone_status(spark):
    rows = [(i, cell, hidden) for i, (cell, hidden, _, _) in enumerate(PHONES)]
    df = spark.createDataFrame(rows, "i int, cell string, hidden boolean")
    facts = phones.phone_facts("cell", F.col("hidden"))
    got = df.select("i", facts["status"], facts["phone"]).orderBy("i").collect()
    assert [(r[1], r[2]) for r in got] == [(s, p) for _, _, s, p in PHONES]


AD_IDS = [
    (None, "missing", None), (" nan ", "missing", None), ("abc", "malformed", None), ("12", "malformed", "12"),
    ("00123", "valid", "123"), ("cars-20487561", "valid", "20487561"), ("000", "malformed", "0"),
    ("20476856.0", "valid", "20476856"), ("12-345-678", "valid", "345"),
]


def test_ad_ids(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(AD_IDS)], "i int, cell string")
    facts = ad_id_facts("cell")
    got = df.select("i", facts["status"], facts["ad_id"]).orderBy("i").collect()
    assert [(r[1], r[2]) for r in got] == [(s, n) for _, s, n in AD_IDS]


AGES = [
    ("2024-01-31 12:00:00", "2024-02-29 12:00:00", "1 month ago"),
    ("2024-01-31 12:00:00", "2024-02-29 11:59:59", "28 days ago"),
    ("2023-01-31 00:00:00", "2023-02-28 00:00:00", "1 month ago"),
    ("2022-02-28 00:00:00", "2024-02-28 00:00:00", "2 years ago"),
    ("2024-02-27 10:00:00", "2024-02-28 09:00:00", "23 hours ago"),
    ("2024-02-28 08:59:00", "2024-02-28 09:00:30", "1 minute ago"),
    ("2024-02-28 08:59:45", "2024-02-28 09:00:30", "Just now"),
    ("2025-01-01 00:00:00", "2024-02-28 09:00:30", "Just now"),
    ("last week", "2024-02-28 09:00:30", "Unknown"),
    (None, "2024-02-28 09:00:30", "Unknown"),
]


def test_relative_age(spark):
    df = spark.createDataFrame([(i, *row[:2]) for i, row in enumerate(AGES)], "i int, published string, now string")
    got = df.select("i", relative_age("published", "now").alias("age")).orderBy("i").collect()
    assert [r["age"] for r in got] == [a for _, _, a in AGES]


def test_parse_moment(spark):
    cells = ["2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05.123", "2024-01-02", "06/01/2026", "soon"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[1] for r in df.select("i", F.hour(parse_moment("c"))).orderBy("i").collect()]
    assert got == [3, 3, 3, 0, None, None]


@pytest.mark.parametrize(
    "label,rule,want",
    [
        ("x" * 31, "ellipsis", "x" * 31),
        ("x" * 32, "ellipsis", "x" * 28 + "..."),
        ("x" * 40, "cut", "x" * 31),
        ("land-cruiser-o'neil", "slug", "Land Cruiser O'Neil"),
        ("a b/c*[d]?", "clean", "a_bcd"),
    ],
)
def test_sheet_name(spark, label, rule, want):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(text.sheet_name("l", rule)).first()[0] == want


@pytest.mark.parametrize("date,count", [("2026-06-09", 4), ("2026-11-09", 2), ("2026-11-12", 1)])
def test_partition_prefixes(spark, date, count):
    df = spark.createDataFrame([("b", date)], "base string, date string")
    assert layout.partition_prefixes(df).count() == count


def test_severity(spark):
    names = ["file_readable", "sheet_exists_Info", "trend_rows_low_x", "trend_rows_high_x", "observed_file_size_floor"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[1] for r in df.select("i", alerts.check_severity(F.col("n"))).orderBy("i").collect()]
    assert got == ["critical", "critical", "high", "medium", "high"]


def test_attribute_rules(spark):
    attr = "array<struct<name_en:string,name_ar:string,type:string,val_kind:string,val:string,val_en:string,val_ar:string>>"
    attrs = [
        ("Color", "لون", "list", "object", None, "Red", ""),
        ("Year", None, "number", "string", "2020", None, None),
        ("Used", None, None, "string", "1", None, None),
        ("Color", None, "list", "object", None, "Blue", None),
        ("Gone", None, "list", "other", None, None, None),
    ]
    df = spark.createDataFrame([(1, attrs)], f"id int, attrs {attr}")
    standard = listings.attributes_to_maps(df).first()
    assert standard["spec_en"] == {"Color": "Blue", "Year": "2020", "Used": "Yes"}
    assert standard["spec_ar"] == {}
    kept = listings.attributes_to_maps(df, "property").first()
    assert kept["spec_ar"] == {"لون": ""}
    assert listings.attributes_to_maps(df, "new").first()["spec_en"]["Year"] == "No"


def test_jsonld_skips_broken_blocks(spark):
    html = (
        '<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@type": "A", "n": 1}</script>'
        '<script type="application/ld+json">{"@type": "B", "n": 2}</script>'
    )
    df = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    read = lambda kind: pages.page_jsonld(df, kind).selectExpr("try_variant_get(jsonld, '$.n', 'int')").first()[0]
    assert (read(None), read("B"), read("C")) == (1, 2, None)


def test_lists_with_program_words_and_nested_lists(spark):
    from adledger.functions.phones import classify_phone, phone_tokens

    cells = ["['96551234567', None, '12345']", "[['96551234567', '123'], '4']", "[None, True]", "['None of 12']"]
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select(phone_tokens("c").alias("t"), classify_phone("c").alias("s")).collect()
    assert [r["t"] for r in rows] == [["96551234567", "12345"], ["96551234567", "123", "4"], [], ["12"]]
    assert [r["s"] for r in rows] == ["valid", "valid", "missing", "too_short"]
