"""Readers, writers and table upkeep in a temporary folder."""

import datetime
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from adledger import schemas
from adledger.catalog import registry, storage
from adledger.operators import trends
from adledger.operators.output import write_grouped
from adledger.plans import hub_chain
from adledger.session import scratch_dir
from adledger.sources import readers, versions, writers
from adledger.streaming.intake import LANDED, start_hour_intake

DAY = datetime.date(2024, 1, 2)


def hourly(spark, *data):
    return spark.createDataFrame(list(data), "hub_partition_date date, site_id string, scraper string, hour int, ads_count int, seq int")


def test_replace_and_empty_partition(spark, tmp_path):
    root, table = str(tmp_path / "t"), "scraper_hourly_daily"
    other = datetime.date(2024, 1, 3)
    writers.write_hub_table(hourly(spark, (DAY, "a", "s", 1, 5, 0), (other, "a", "s", 1, 7, 0)), root, table)
    writers.replace_partition(hourly(spark, (DAY, "a", "s", 1, 1, 0), (DAY, "a", "s", 1, 9, 1)), root, table, "2024-01-02")
    stored = {(r["hub_partition_date"], r["ads_count"]) for r in readers.read_hub_table(spark, root, table).collect()}
    assert stored == {(DAY, 9), (other, 7)}
    writers.replace_partition(hourly(spark, (other, "a", "s", 1, 7, 0)).filter("false"), root, table, "2024-01-02")
    assert readers.read_hub_table(spark, root, table, "2024-01-02").count() == 0
    assert readers.read_hub_table(spark, root, table).count() == 1


def test_push_skips_days_without_hub_row(spark, tmp_path):
    tables = {t: spark.createDataFrame([], schemas.table_schema(t)) for t in schemas.TABLES}
    assert writers.push_partition(tables, str(tmp_path / "p"), "2024-01-02") is False


def test_absent_table_has_full_schema(spark, tmp_path):
    for table in schemas.TABLES:
        assert readers.read_hub_table(spark, str(tmp_path), table).columns == schemas.table_columns(table)
    assert [len(schemas.TABLES[t]) for t in ("hub_daily", "site_daily", "scraper_daily")] == [33, 48, 37]


def test_listing_arrays_and_brand_documents(spark, tmp_path):
    folder = tmp_path / "cars" / "year=2024" / "month=1" / "day=2" / "json version"
    folder.mkdir(parents=True)
    (folder / "suv.json").write_text(json.dumps([{"id": "1", "title": "a"}, {"id": "2", "images": ["x"]}]))
    got = readers.read_listing_json(spark, str(tmp_path / "cars"), ["2024-01-02"])
    assert sorted((r["category"], str(r["save_date"]), r["id"]) for r in got.collect()) == [("suv", "2024-01-02", "1"), ("suv", "2024-01-02", "2")]
    assert readers.read_listing_json(spark, str(tmp_path / "cars"), ["2024-01-03"]).count() == 0
    brands = tmp_path / "brands"
    brands.mkdir()
    (brands / "b.json").write_text(json.dumps({"brand": "B", "types": [{"type": "T", "details": [{"id": "1"}, {"id": "2"}]}]}))
    assert readers.read_brand_json(spark, str(brands)).select("brand", "type", "id").count() == 2


def test_summaries_by_place(spark, tmp_path):
    day = tmp_path / "s" / "year=2024" / "month=01" / "day=02"
    (day / "json-files").mkdir(parents=True)
    (day / "json-files" / "a.json").write_text('{"total_listings": 1}')
    (day / "json-files" / "bad.json").write_text("{")
    (day / "old_Summary_1.json").write_text('{"requests_total": 2}')
    (day / "other.json").write_text("{}")
    root = str(tmp_path / "s")
    assert readers.read_summary_json(spark, root).count() == 1
    got = readers.read_summary_json(spark, root, for_metrics=True).select("prefix_form", "body").collect()
    assert sorted(r["prefix_form"] for r in got) == [0, 1]


def test_sheet_rows_from_csv_and_json(spark, tmp_path):
    rows = spark.createDataFrame([("s", "f", "Main", 0, 1, json.dumps({"ID": "7", "Phone": None}))], schemas.INPUTS["sheet_rows"].replace("MAP<STRING,STRING>", "STRING"))
    rows.write.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    rows.write.json(str(tmp_path / "j"))
    for kind, path in (("csv", "c"), ("json", "j")):
        assert readers.read_sheet_rows(spark, str(tmp_path / path), kind).first()["cells"] == {"ID": "7", "Phone": None}


def test_hour_intake_redoes_whole_days(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def land(n, stamp):
        cells = {"date_published": stamp}
        data = [("site", DAY, "s", "f", "Main", 0, n, cells)]
        spark.createDataFrame(data, LANDED).write.mode("append").parquet(landing)
        start_hour_intake(spark, landing, root, checkpoint).awaitTermination(120)

    land(1, "2024-01-01 03:10:00")
    land(2, "2024-01-01 03:50:00")
    stored = readers.read_hub_table(spark, root, "scraper_hourly_daily").select("hour", "ads_count", F.col("site_id")).collect()
    assert [(r["hour"], r["ads_count"], r["site_id"]) for r in stored] == [(3, 2, "site")]


def test_keys_are_stored_once_with_or_without_a_sequence(spark, tmp_path):
    root, table = str(tmp_path / "k"), "scraper_hourly_daily"
    rows = hourly(spark, (DAY, "a", "s", 1, 5, 0), (DAY, "a", "s", 1, 3, 0), (DAY, "a", "s", 2, 1, 0)).drop("seq")
    writers.replace_partition(rows, root, table, "2024-01-02")
    assert sorted((r["hour"], r["ads_count"]) for r in readers.read_hub_table(spark, root, table).collect()) == [(1, 5), (2, 1)]


def test_entries_of_one_key_reach_the_table_once(spark, tmp_path):
    told = [{"subcategory": "Cars", "ads_count": 1}, {"subcategory": "Cars", "ads_count": 3_000_000_000}, {"subcategory": "Vans", "ads_count": None, "count": 9}]
    report = {"scrapers": [{"scraper": "s", "subcategory_breakdown": told, "unique_ads": 3_000_000_000}]}
    good = {"run_date": "2024-01-02", "generated_at": "x", "sites": [{"site_id": "a", "report": report}]}
    bad = {"run_date": "n/a", "sites": [{"site_id": "a", "report": report}]}
    docs = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),)], "body string").select(F.parse_json("body").alias("doc"))
    registry = spark.createDataFrame([], f"seq int, {schemas.INPUTS['registry_site']}")
    root = str(tmp_path / "chain")
    hub_chain.backfill_documents(docs, registry, root, 0)
    rows = readers.read_hub_table(spark, root, "scraper_subcategory_daily").collect()
    assert sorted((r["subcategory"], r["ads_count"]) for r in rows) == [("Cars", None), ("Vans", 0)]
    assert [r["unique_ads"] for r in readers.read_hub_table(spark, root, "scraper_daily").collect()] == [None]
    assert [str(r["hub_partition_date"]) for r in readers.read_hub_table(spark, root, "hub_daily").collect()] == ["2024-01-02"]


def test_grouped_days_do_not_erase_each_other(spark, tmp_path):
    path = str(tmp_path / "grouped")
    for day in ("2024-01-02", "2024-01-03"):
        rows = spark.createDataFrame([("1", "cars", "suv", day)], "id string, category string, child string, save_date string")
        write_grouped(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_endings_in_capitals_count(spark, tmp_path):
    folder = tmp_path / "c" / "year=2024" / "month=1" / "day=2" / "json-files"
    folder.mkdir(parents=True)
    for name in ("a.json", "b.JSON", "c.txt"):
        (folder / name).write_text('{"total_listings": 1}')
    assert readers.read_summary_json(spark, str(tmp_path / "c")).count() == 2


def test_values_that_do_not_fit_become_null(spark):
    rows = spark.createDataFrame([("n/a", "3000000000")], "hub_partition_date string, hour string")
    got = writers.align(rows, "scraper_hourly_daily").first()
    assert (got["hub_partition_date"], got["hour"]) == (None, None)


def test_scratch_needs_a_shared_folder_outside_one_machine(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_only_folders_of_asked_days_are_read(spark, tmp_path):
    for base in ("cars", "vans/used"):
        for day in ("month=01/day=02", "month=1/day=3", "month=1/day=4", "month=12/day=30"):
            folder = tmp_path / base / "year=2024" / day / "json-files"
            folder.mkdir(parents=True)
            (folder / "suv.json").write_text(json.dumps([{"id": day}]))
    got = readers.read_listing_json(spark, str(tmp_path), ["2024-01-02", "2024-01-04", "2031-01-01"], bases=("*", "*/*"))
    assert len(got.inputFiles()) == 4 and all("day=02" in f or "day=4" in f for f in got.inputFiles())
    assert sorted((str(r.save_date), r.id) for r in got.collect()) == [("2024-01-02", "month=01/day=02")] * 2 + [("2024-01-04", "month=1/day=4")] * 2
    assert len(readers.read_listing_json(spark, str(tmp_path), ["2024-01-03"]).inputFiles()) == 1
    none = readers.read_listing_json(spark, str(tmp_path), ["2031-01-01"])
    assert none.count() == 0 and none.columns == got.columns
    assert len(readers.read_summary_json(spark, str(tmp_path), dates=["2024-12-30"]).inputFiles()) == 2


def test_only_reports_and_documents_of_asked_days_are_read(spark, tmp_path):
    for day in ("2024-01-02", "2024-01-03", "2024-02-01"):
        for folder, name in ((tmp_path / "data" / "site" / "monitor" / day, "report.json"), (tmp_path / "hub" / day, "all-sites.json")):
            folder.mkdir(parents=True)
            (folder / name).write_text(json.dumps({"run_date": day}))
    reports = readers.read_reports(spark, str(tmp_path), ["2024-01-03", "2024-01-09"])
    assert len(reports.inputFiles()) == 1 and [(r.prefix, str(r.report_date)) for r in reports.collect()] == [("site", "2024-01-03")]
    assert readers.read_reports(spark, str(tmp_path), ["2024-02-01"], sites=("data/site",)).count() == 1
    documents = readers.read_hub_document(spark, str(tmp_path), ["2024-02-01"])
    assert len(documents.inputFiles()) == 1 and [str(r.hub_date) for r in documents.collect()] == ["2024-02-01"]
    assert readers.read_reports(spark, str(tmp_path), ["2031-01-01"]).count() == 0 == readers.read_hub_document(spark, str(tmp_path), ["2031-01-01"]).count()


def daily(spark, day, unique):
    """All six tables of one day, with the number of ads in those that a reader compares."""
    tables = {t: spark.createDataFrame([], schemas.table_schema(t)) for t in schemas.TABLES}
    for t in ("hub_daily", "site_daily", "scraper_daily"):
        row = spark.createDataFrame([(day, "a", "s", unique)], "hub_partition_date date, site_id string, scraper string, unique_ads bigint")
        tables[t] = writers.align(row.withColumnRenamed("unique_ads", "total_unique_ads") if t == "hub_daily" else row, t)
    return tables


def seen(spark, root, day=None):
    return sorted((str(r["hub_partition_date"]), r["unique_ads"]) for t in ("site_daily", "scraper_daily") for r in readers.read_hub_table(spark, root, t, day).collect())


def test_a_push_that_stops_between_tables_leaves_the_old_day_whole(spark, tmp_path, monkeypatch):
    root, other = str(tmp_path / "pub"), datetime.date(2024, 1, 3)
    assert writers.push_partition(daily(spark, DAY, 1), root, "2024-01-02") and writers.push_partition(daily(spark, other, 5), root, "2024-01-03")
    broken = daily(spark, DAY, 2)
    broken["scraper_daily"] = broken["scraper_daily"].withColumn("unique_ads", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        writers.push_partition(broken, root, "2024-01-02")
    assert seen(spark, root) == [("2024-01-02", 1)] * 2 + [("2024-01-03", 5)] * 2
    monkeypatch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        writers.push_partition(daily(spark, DAY, 3), root, "2024-01-02")
    monkeypatch.undo()
    assert seen(spark, root, "2024-01-02") == [("2024-01-02", 1)] * 2
    held = readers.read_hub_table(spark, root, "site_daily", "2024-01-02")
    writers.push_partition(daily(spark, DAY, 4), root, "2024-01-02")
    assert seen(spark, root, "2024-01-02") == [("2024-01-02", 4)] * 2 and [r["unique_ads"] for r in held.collect()] == [1]
    assert len(versions.vacuum(spark, root)) == 2 and seen(spark, root) == [("2024-01-02", 4)] * 2 + [("2024-01-03", 5)] * 2


def test_days_in_folders_stay_when_others_are_published(spark, tmp_path):
    root, other = str(tmp_path / "mixed"), datetime.date(2024, 1, 3)
    for day, n in ((DAY, 1), (other, 2)):
        for table, rows in daily(spark, day, n).items():
            writers.write_hub_table(rows, root, table)
    writers.push_partition(daily(spark, DAY, 7), root, "2024-01-02")
    assert seen(spark, root) == [("2024-01-02", 7)] * 2 + [("2024-01-03", 2)] * 2
    writers.replace_partition(daily(spark, other, 9)["site_daily"], root, "site_daily", "2024-01-03")
    writers.replace_partition(daily(spark, DAY, 9)["scraper_daily"].filter("false"), root, "scraper_daily", "2024-01-02")
    assert seen(spark, root) == [("2024-01-02", 7), ("2024-01-03", 2), ("2024-01-03", 9)]


def test_of_two_writers_one_is_told_and_publication_tries_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    rows = lambda n: spark.createDataFrame([(f"s{n}", float(n), float(n), float(n), ["2024-01-01"])], schemas.INPUTS["baseline"])
    assert writers.write_baseline(rows(1), root) == 1
    with pytest.raises(versions.NewerVersion):
        versions.commit(rows(2), root, 0)
    assert [r["scraper"] for r in readers.read_baseline(spark, root).collect()] == ["s1"]
    for n in (2, 3, 4):
        writers.update_baseline(spark, root, rows(n), trends.merge_baseline)
    assert versions.versions(spark, root) == [3, 4]
    assert sorted(r["scraper"] for r in readers.read_baseline(spark, root).collect()) == ["s1", "s2", "s3", "s4"]
    published, first = str(tmp_path / "race"), []
    plain = versions.live_days

    def slow(spark_, root_):
        out = plain(spark_, root_)
        if not first:
            first.append(True)
            writers.push_partition(daily(spark, datetime.date(2024, 1, 5), 5), published, "2024-01-05")
        return out

    monkeypatch.setattr(versions, "live_days", slow)
    writers.push_partition(daily(spark, DAY, 1), published, "2024-01-02")
    assert seen(spark, published) == [("2024-01-02", 1)] * 2 + [("2024-01-05", 5)] * 2


def test_a_run_that_stops_leaves_the_stored_statistics(spark, tmp_path):
    root = str(tmp_path / "kept")
    rows = spark.createDataFrame([("s", 1.0, 1.0, 1.0, ["2024-01-01"])], schemas.INPUTS["baseline"])
    writers.write_baseline(rows, root)
    with pytest.raises(Exception, match="lost"):
        writers.update_baseline(spark, root, rows, lambda old, new: old.withColumn("size_min", F.raise_error(F.lit("lost")).cast("double")))
    assert [r["size_min"] for r in readers.read_baseline(spark, root).collect()] == [1.0]


def test_many_small_documents_are_spread_to_write_and_packed_to_read(spark, tmp_path, monkeypatch):
    bodies = {f"s/json-files/{i:03d}.json": json.dumps({"total_listings": i, "title": "سيارة"}) for i in range(300)}
    docs = spark.createDataFrame([*bodies.items()], "key string, body string").coalesce(1)
    dealt, write = [], type(docs).foreachPartition
    monkeypatch.setattr(type(docs), "foreachPartition", lambda self, f: (dealt.append(self.rdd.getNumPartitions()), write(self, f)))
    root = scratch_dir(spark, "small")
    writers.write_documents(docs, root)
    assert dealt == [4]
    back = readers.read_summary_json(spark, root)
    assert back.rdd.getNumPartitions() <= 4
    assert {r["key"].split(root.rstrip("/") + "/")[1]: r["body"] for r in back.collect()} == bodies


def test_of_documents_with_one_key_the_last_of_a_task_stays(spark):
    docs = spark.createDataFrame([("a/report.json", '{"n": %d}' % n) for n in range(9)], "key string, body string").coalesce(1)
    root = scratch_dir(spark, "again")
    writers.write_documents(docs, root)
    assert [r["body"] for r in readers.whole_documents(spark, root).collect()] == ['{"n": 8}']


def read_back(spark, root, **how):
    return sorted((r["key"].split(root.rstrip("/") + "/")[1], r["prefix_form"], r["body"]) for r in readers.read_summary_json(spark, root, for_metrics=True, **how).collect())


def test_documents_as_lines_are_read_as_if_each_were_a_file(spark, tmp_path):
    day, text = "a b/1/year=2024/month=01/day=02", json.dumps({"n": "سيارة \u2028 \r\n \x00 \"x\""}, ensure_ascii=False)
    docs = [(f"{day}/json-files/{i:03d}.{'JSON' if i % 2 else 'json'}", json.dumps({"i": i}) + "\n") for i in range(300)]
    docs += [(f"{day}/{name}", text) for name in ("json-files/t.json", "json-files/deep/t.json", "Summary.json", "other.json", "json-files/z.json")]
    docs += [(f"{day}/json-files/{name}", text) for name in (".hidden.json", "_kept.json", "a.txt", "a.json.gz", "a.documents.jsonl.gz")]
    docs += [(f"{day}/json-files/bad.json", "{"), (f"{day}/json-files/empty.json", ""), ("top.json", text), ("b/year=2024/month=1/day=3/json-files/x.json", "[1]")]
    rows = spark.createDataFrame(docs, "key string, body string").repartition(3)
    files, lines = str(tmp_path / "files"), str(tmp_path / "lines")
    writers.write_documents(rows, files)
    writers.write_documents(rows, lines, lines=True)
    stored = [p for p in (tmp_path / "lines").rglob("*") if p.is_file()]
    assert len(stored) <= 4 + 5 and all(p.name.endswith(".documents.jsonl.gz") for p in stored)
    (tmp_path / "files" / day / "json-files" / "a.documents.jsonl.gz").unlink()  # no lines, only named so
    want = read_back(spark, files)
    assert len(want) == 305 and read_back(spark, lines, lines=True) == want and read_back(spark, lines) == []
    assert read_back(spark, files, lines=True) == want
    asked = {"dates": ["2024-01-03"], "bases": ("*", "*/*")}
    assert read_back(spark, lines, lines=True, **asked) == read_back(spark, files, **asked) == [("b/year=2024/month=1/day=3/json-files/x.json", 0, "[1]")]


def test_of_lines_with_one_key_the_last_stays_and_a_root_is_written_once(spark, tmp_path):
    docs = spark.createDataFrame([(key, '{"n": %d}' % n) for n in range(9) for key in ("json-files/a.json", "json-files//b.json")], "key string, body string")
    root = str(tmp_path / "again")
    writers.write_documents(docs, root, lines=True)
    assert sorted(r["body"] for r in readers.whole_documents(spark, root, lines=True).collect()) == ['{"n": 8}'] * 2
    with pytest.raises(ValueError, match="only once"):
        writers.write_documents(docs, root, lines=True)


@pytest.mark.parametrize("lines", [False, True])
def test_documents_without_text_end_the_write(spark, tmp_path, lines):
    docs = spark.createDataFrame([("json-files/a.json", "{}"), ("json-files/b.json", None)], "key string, body string")
    with pytest.raises(Exception, match="no text to write under json-files/b.json" if lines else "NoneType"):
        writers.write_documents(docs, str(tmp_path / "none"), lines=lines)


def test_summaries_take_few_files_however_many_there_are(spark, tmp_path, monkeypatch):
    day = datetime.datetime(2024, 1, 2)
    rows = [(n, n % 3 + 1, "O", 1.0, day, "2-HIGH") for n in range(400)]
    orders = spark.createDataFrame(rows + rows[:50], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    orders.write.parquet(str(tmp_path / "in" / "orders.parquet"))
    monkeypatch.setattr(storage, "scratch_dir", lambda _, label: str(tmp_path / label))
    got = storage.s2(spark, str(tmp_path / "in")).collect()
    assert len([p for p in (tmp_path / "summaries").rglob("*") if p.is_file()]) <= 4 + 3
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT DISTINCT * FROM '{tmp_path}/in/orders.parquet/*.parquet'")
    want = con.execute(registry.ORACLES["s2_read_summary_json"]).fetchall()
    assert len(want) > 300 and sorted(map(tuple, got)) == sorted(want)
