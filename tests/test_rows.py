"""Row rules on small tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from adledger.operators import inspection, ordering, output, sites, trends, validation
from adledger.operators.ads import summary_total
from adledger.functions import variants as V

ROWS = "scraper string, file_key string, sheet string, sheet_pos int, row_no long, cells map<string,string>"


def rows(spark, *cells):
    return spark.createDataFrame([("s", "f", "Main", 0, i, c) for i, c in enumerate(cells)], ROWS)


def test_hidden_row_stops_at_first_column(spark):
    df = rows(
        spark,
        {"phone": None, "contacts": "51234567", "is_hide_my_number": "1"},
        {"phone": None, "contacts": "51234567", "is_hide_my_number": "0"},
        {"phone": "nan", "contacts": None, "is_hide_my_number": None},
        {"title": "no phone column"},
    )
    got = validation.row_contact(df).orderBy("row_no").collect()
    assert [(r["phone_status"], r["phone_column"]) for r in got] == [
        ("hidden", "phone"), ("valid", "contacts"), ("missing", "phone"), (None, None),
    ]


@pytest.mark.parametrize("pct,passes", [(15.0, True), (15.01, False)])
def test_gate_edge(spark, pct, passes):
    merged = spark.createDataFrame(
        [("s", 1, 100, 100, pct, 0.0)], "scraper string, files_found long, phones_seen long, ads_seen long, phones_invalid_pct double, ads_invalid_pct double"
    )
    scrapers = spark.createDataFrame([("s", False), ("none", False), ("opt", True)], "scraper string, files_optional boolean")
    got = {r["scraper"]: r["passed"] for r in validation.validation_gate(merged, scrapers).collect()}
    assert got == {"s": passes, "none": False, "opt": True}


def test_first_rows_with_a_hot_key(spark):
    """A third of all rows share one key; the result equals a plain scan in order."""
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(500)}", rnd.randrange(4), i) for i in range(6000)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k string, pos int, n long")
    got = {(r["k"], r["pos"], r["n"]) for r in ordering.first_rows(df, ["k"], ["pos", "n"]).collect()}
    want = {}
    for k, pos, n in sorted(data, key=lambda r: (r[1], r[2])):
        want.setdefault(k, (k, pos, n))
    assert got == set(want.values())


def test_duplicates_follow_sheet_order(spark):
    data = [("s", "f", "B", 1, 0, {"id": "12345"}), ("s", "f", "A", 0, 9, {"id": "012345"}), ("s", "g", "A", 0, 1, {"id": "12345"})]
    checked = validation.check_rows(spark.createDataFrame(data, ROWS))
    got = {(r["file_key"], r["sheet"]): r["ad_status"] for r in validation.flag_duplicate_ids(checked).collect()}
    assert got == {("f", "B"): "duplicate", ("f", "A"): "valid", ("g", "A"): "valid"}
    merged = validation.scraper_validation(checked).first()
    assert (merged["ads_valid"], merged["ads_duplicates"], merged["ads_unique_valid"]) == (2, 1, 1)


def test_trend_floor(spark):
    sheets = spark.createDataFrame(
        [("s", "f", 1024, True, "Ten", 0, ["a"], 2), ("s", "f", 1024, True, "One", 1, ["a"], 1), ("t", "g", 1024, True, "Ten", 0, ["a"], 0)],
        "scraper string, file_key string, size_bytes long, readable boolean, sheet string, sheet_pos int, columns array<string>, row_count long",
    )
    base = spark.createDataFrame(
        [("s", 1.0, 1.0, 1.0, ["1", "2", "3"]), ("t", 1.0, 1.0, 1.0, ["1", "2"])],
        "scraper string, size_min double, size_max double, size_last double, observed_dates array<string>",
    )
    stats = spark.createDataFrame(
        [("s", "Ten", 10, 10), ("s", "One", 1, 1), ("t", "Ten", 10, 10)], "scraper string, sheet string, rows_min long, rows_max long"
    )
    got = {r["sheet"]: (r["passed"], r["detail"]) for r in trends.check_rows_low(sheets, base, stats).collect()}
    assert got["Ten"] == (False, "2 rows vs floor 3 (30% of hist min 10)")
    assert got["One"][0] and "floor 1 " in got["One"][1]
    assert len(got) == 2


def test_columns_link_excused_by_slug(spark):
    matches = spark.createDataFrame(
        [("s", "f", "M", True, "Main", 5, ["Slug", "Listing ID"], ["link", "id", "views", "Grade", "price"], ["grade"], 0, 9)],
        "scraper string, file_key string, expected_name string, is_template boolean, sheet string, row_count long, columns array<string>, "
        "required_columns array<string>, optional_columns array<string>, row_min long, row_max long",
    )
    got = inspection.missing_columns(matches).first()
    assert (got["missing_core"], got["missing_optional"]) == (["price"], ["views", "Grade"])


D = datetime.date
USABLE, EMPTY = '{"total_unique_ads": 5}', '{"total_unique_ads": 0, "scrapers": {}}'
CASES = {
    "today": ("monthly", {D(2024, 5, 10): USABLE, D(2024, 5, 1): USABLE}, (D(2024, 5, 10), False)),
    "empty-today": ("monthly", {D(2024, 5, 10): EMPTY, D(2024, 5, 1): USABLE}, (D(2024, 5, 1), True)),
    "missing-daily": ("daily", {D(2024, 5, 9): USABLE}, (None, False)),
    "only-empty": ("weekly", {D(2024, 5, 10): EMPTY, D(2024, 5, 8): EMPTY}, (D(2024, 5, 10), False)),
    "at-edge": ("weekly", {D(2024, 5, 3): USABLE}, (D(2024, 5, 3), True)),
    "past-edge": ("weekly", {D(2024, 5, 2): USABLE}, (None, False)),
    "unreadable": ("weekly", {D(2024, 5, 10): "{", D(2024, 5, 9): USABLE}, (D(2024, 5, 9), True)),
    "later-only": ("monthly", {D(2024, 5, 11): USABLE}, (None, False)),
}


def test_latest_usable_report(spark):
    registry = spark.createDataFrame(
        [(i, name, f"folder {name}", c[0], None, None) for i, (name, c) in enumerate(CASES.items())],
        "seq int, site_id string, folder string, schedule string, report_fallback string, report_lookback_days int",
    )
    stored = [(name, day, body) for name, c in CASES.items() for day, body in c[1].items()]
    facts = sites.report_facts(spark.createDataFrame(stored, "site_id string, report_date date, body string"))
    asked = sites.asked_days(sites.fallback_policy(registry), "2024-05-10")
    got = {r["site_id"]: (r["report_date"], r["report_fallback"]) for r in sites.latest_usable_report(asked, facts).collect()}
    assert got == {name: c[2] for name, c in CASES.items()}


def test_summary_total_shapes(spark):
    bodies = ['{"total_listings": 3, "items": [{"listings": 9}]}', '{"items": [{"total_ads": 2, "listings": 1}, "x"]}', '{"a": 1}', "[1]", "{bad"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", V.parse("b").alias("d"))
    assert [r[1] for r in df.select("i", summary_total(F.col("d"))).orderBy("i").collect()] == [3, 3, None, None, None]


def test_page_cuts(spark):
    from adledger.operators import listings

    day, old = "2024-01-15 08:00:00", "2024-01-14 08:00:00"
    data = [("a", 1, day), ("a", 2, day), ("a", 4, day), ("b", 2, day), ("c", 1, day), ("c", 2, old), ("c", 2, day), ("c", 3, day), ("d", 1, None)]
    cards = spark.createDataFrame(data, "category string, page int, date_published string")
    first = listings.cut_pages_first_empty(cards, "2024-01-15", 9, ["category"])
    assert sorted((r["category"], r["page"]) for r in first.collect()) == [("a", 1), ("a", 2), ("c", 1), ("c", 2), ("c", 3)]
    older = listings.cut_pages_found_older(cards, "2024-01-15", ["category"])
    assert sorted((r["category"], r["page"]) for r in older.collect() if r["category"] == "c") == [("c", 1), ("c", 2)]


def test_run_metrics(spark):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    log = spark.createDataFrame([("r", t(0), False, 0), ("r", t(30), True, 4)], "run_id string, ts timestamp, failed boolean, session_count long")
    got = output.run_metrics(log).first()
    assert (got["requests_total"], got["error_rate_pct"], got["requests_per_min"], got["duration_sec"]) == (4, 25.0, 8.0, 30.0)


def test_image_roster_against_plain_python(spark):
    """The one query whose numbers are hashes: kinds, addresses and extensions against a plain loop."""
    from adledger.operators import listings

    data = [(1, "https://x/l.PNG?v=1", "media", ["https://x/a", "https://x/b.jpeg"]), (2, None, "https://x/c.verylong", None), (3, "", None, [])]
    df = spark.createDataFrame(data, "id int, logo string, cover_image string, media_urls array<string>")
    got = sorted((r["id"], r["kind"], r["url"], r["file_name"].rsplit(".", 1)[1]) for r in listings.business_image_roster(df).collect())
    want = []
    for id_, logo, cover, media in data:
        images = ([("logo", logo)] if logo else []) + ([("cover", cover)] if cover and cover != "media" else [])
        images += [(f"media_{i}", u) for i, u in enumerate(media or [])]
        for kind, url in images:
            name = url.split("?")[0].rsplit("/", 1)[-1]
            ext = "." + name.rsplit(".", 1)[1].lower() if "." in name else ""
            want.append((id_, kind, url, (ext if ext and len(ext) <= 5 else ".jpg")[1:]))
    assert got == sorted(want)


def test_repeated_ids_with_a_hot_id_and_rows_without(spark):
    rnd = random.Random(9)
    data = [("f", rnd.randrange(3), i, None if rnd.random() < 0.4 else "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(200)}") for i in range(4000)]
    rows = spark.createDataFrame([(f, p, n, a, "missing" if a is None else "valid") for f, p, n, a in data], "file_key string, sheet_pos int, row_no long, ad_id string, ad_status string")
    got = {r["row_no"]: r["ad_status"] for r in validation.flag_duplicate_ids(rows).collect()}
    seen = set()
    for f, p, n, a in sorted(data, key=lambda r: (r[1], r[2])):
        assert got[n] == ("missing" if a is None else "duplicate" if a in seen else "valid")
        seen.add(a)
    assert len(got) == len(data)


def test_files_without_data_rows_are_listed(spark):
    data = [("s", "f", "Main", 0, 0, {"id": "12345", "phone": "51234567"}), ("s", "broken", "Main", 0, 0, {"id": "99999"})]
    files = spark.createDataFrame([("s", "f", True), ("s", "info-only", True), ("s", "broken", False), ("t", "alone", True)], "scraper string, file_key string, readable boolean")
    checked = validation.check_rows(spark.createDataFrame(data, ROWS))
    got = {r["file_key"]: (r["readable"], r["rows_scanned"], r["phones_seen"]) for r in validation.file_validation(checked, files).collect()}
    assert got == {"f": (True, 1, 1), "info-only": (True, 0, 0), "broken": (False, 0, 0), "alone": (True, 0, 0)}
    merged = validation.scraper_validation(checked, files)
    assert {r["scraper"]: (r["files_found"], r["files_readable"], r["ads_seen"]) for r in merged.collect()} == {"s": (3, 2, 1), "t": (1, 1, 0)}
    scrapers = spark.createDataFrame([("t", False)], "scraper string, files_optional boolean")
    assert validation.validation_gate(merged, scrapers).first()["fail_reasons"] == ["no_phone_or_id_columns"]


def test_short_detail_has_a_link_and_the_status_of_its_card(spark):
    from adledger.operators import listings

    page = '{"props": {"pageProps": {"listing": {"user_adv_id": "7", "slug": "a-7", "title": "t", "images": ["x"], "user": {"listings_count": 3}}}}}'
    payloads = spark.createDataFrame([(1, page)], "page_id long, body string").select("page_id", V.parse("body").alias("payload"))
    details = listings.project_listing_detail(payloads, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    cards = spark.createDataFrame([("a-7", "pinned"), ("", "none")], "slug string, status string")
    rows = listings.short_listing_detail(details, cards, "https://site/listing/").collect()
    assert [(r["id"], r["link"], r["status"], r["user_ads"]) for r in rows] == [("7", "https://site/listing/a-7", "pinned", "3 ads")]
    assert len(rows[0]) == 25
