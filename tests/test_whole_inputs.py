"""Queries over all days, and listings in bounded files, against their SQL on the smallest given table."""

import duckdb
import pytest

import __spark_entry__ as entry
from adledger.catalog import storage
from tests.test_queries import SF, TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    want, names = rows_of([d[0] for d in result.description], result.fetchall())
    assert columns == names
    assert got == want


@pytest.mark.parametrize("name", ["s11_baseline_all_days", "w6_backfill_all_days"])
def test_all_days(spark, con, name):
    matches_sql(spark, con, name)


def test_listing_arrays_are_bounded(spark, con, monkeypatch):
    monkeypatch.setattr(storage, "ARRAY_ROWS", 2)
    sizes, write = [], storage.writers.write_documents

    def watched(docs, root):
        sizes.extend(r.n for r in docs.selectExpr("json_array_length(body) AS n").collect())
        write(docs, root)

    monkeypatch.setattr(storage.writers, "write_documents", watched)
    matches_sql(spark, con, "s1_read_listing_arrays")
    groups = con.execute("SELECT count(DISTINCT (event_type, CAST(ts AS DATE))) FROM events").fetchone()[0]
    assert len(sizes) > groups and max(sizes) < 10


def test_gate_of_listed_files(spark, con):
    matches_sql(spark, con, "v14_listed_files")
