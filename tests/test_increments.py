"""Sets by day, counts by batch, and all checks of a file in its row."""

from datetime import date

from pyspark.sql import functions as F

from adledger.operators import inspection as q
from adledger.operators import windows
from adledger.streaming.intake import LANDED, hour_counts, start_hour_counts


def test_windows_equal_distinct_values(spark, tmp_path):
    data = [("s", "k", date(2024, 1, d), v) for d, v in [
        (1, "7"), (1, "07"), (1, "-7"), (1, "63"), (1, "64"), (2, "7"), (2, "x"), (4, "x"), (9, "999999999999999999"), (9, "9999999999999999999"), (9, ""),
    ]]
    values = spark.createDataFrame(data, "scraper string, kind string, day date, value string")
    for buckets in (1, 4096):
        got = {r.day_to: r.distinct_count for r in windows.window_counts(windows.day_sets(values, buckets), 3).collect()}
        want = {}
        for d in range(1, 10):
            seen = {v for _, _, day, v in data if d - 2 <= day.day <= d}
            if seen:
                want[date(2024, 1, d)] = len(seen)
        assert got == want
    root = str(tmp_path / "sets")
    windows.write_day_sets(windows.day_sets(values), root)
    again = values.filter("day = '2024-01-01' AND value = '7'")
    windows.write_day_sets(windows.day_sets(again), root)
    stored = {r.day_to.day: r.distinct_count for r in windows.window_counts(windows.read_day_sets(spark, root), 3).collect()}
    assert (stored[1], stored[2], stored[4], stored[9]) == (1, 2, 2, 3)
    assert windows.window_counts(windows.day_sets(values.filter("false"))).count() == 0


def test_each_batch_counts_its_own_files(spark, tmp_path):
    landing, store, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def land(*rows):
        data = [("site", date(2024, 1, day), "s", "f", "Main", 0, n, {"date_published": f"2024-01-{day:02d} {hour:02d}:10:00"}) for n, (day, hour) in enumerate(rows)]
        spark.createDataFrame(data, LANDED).coalesce(1).write.mode("append").parquet(landing)
        run = start_hour_counts(spark, landing, store, checkpoint, late_after=2)
        assert run.awaitTermination(120)
        return sum(p["numInputRows"] for p in run.recentProgress)

    assert land((10, 3), (10, 3), (1, 5)) == 3  # nothing is late in the first batch
    assert land((10, 3), (8, 4), (7, 4)) == 3  # the 7th is before the 10th less two days
    assert land((12, 1)) == 1
    assert land((9, 1), (10, 3)) == 2
    got = {(r.hub_partition_date.day, r.hour): (r.ads_count, r.late_count) for r in hour_counts(spark, store).collect()}
    assert got == {(10, 3): (4, 0), (1, 5): (1, 0), (8, 4): (1, 0), (7, 4): (0, 1), (12, 1): (1, 0), (9, 1): (0, 1)}
    assert start_hour_counts(spark, landing, store, checkpoint, late_after=2).awaitTermination(120)
    assert hour_counts(spark, store).count() == 6


def test_a_file_row_holds_all_checks(spark):
    sheets = spark.createDataFrame([
        ("a", "a1", 2048, True, "Info", 0, 1, ["Title"]), ("a", "a1", 2048, True, "Old", 1, 5, ["ID", "Title"]),
        ("a", "a2", 100, True, "Info", 0, 0, None), ("a", "a3", 10, False, "Info", 0, 0, []), ("free", "f1", 1, True, "Any", 0, 1, ["x"]),
    ], "scraper string, file_key string, size_bytes long, readable boolean, sheet string, sheet_pos int, row_count long, columns array<string>")
    expected = spark.createDataFrame(
        [("a", "Main", ["ID", "Title"], [], 1, 4, 1.0), ("a", "Info", ["Title"], [], None, None, 1.0)],
        "scraper string, name string, required_columns array<string>, optional_columns array<string>, row_min long, row_max long, min_file_size_kb double",
    )
    profiles = spark.createDataFrame(
        [("a", False, ["Old"], None, None, None)],
        "scraper string, skip_info_sheet boolean, data_sheet_aliases array<string>, core_columns array<string>, optional_columns array<string>, min_file_size_kb double",
    )
    checks = q.schema_checks(sheets, expected, profiles)
    failed = {(r.file_key, r.check_name) for r in checks.filter("NOT passed").collect()}
    assert failed == {("a1", "rows_in_Main"), ("a2", "file_size_ok"), ("a2", "sheet_exists_Main"), ("a3", "file_readable")}
    assert checks.filter("file_key = 'f1'").count() == 0 and checks.filter("file_key = 'a3'").count() == 1
    told = q.file_verdict(q.schema_checks(sheets, expected, profiles, unchecked=True))
    assert {(r.file_key, r.passed, r.checks_total) for r in told.filter("scraper = 'free'").collect()} == {("f1", None, 0)}
    scrapers = spark.createDataFrame([("a", False), ("free", False), ("none", True), ("gone", False)], "scraper string, files_optional boolean")
    got = {r.scraper: (r.files_found, r.all_passed) for r in q.scraper_verdict(told, scrapers).collect()}
    assert got == {"a": (3, False), "free": (1, True), "none": (0, True), "gone": (0, False)}
    assert q.schema_checks(sheets.filter(F.lit(False)), expected, profiles).count() == 0
