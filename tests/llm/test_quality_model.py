"""The classifier on held-out labels, and the shrinking of shares against plain formulas."""

import math

import pytest
from pyspark.sql import functions as F

from adledger.llm import quality_model as qm
from adledger.llm.queries import QUERIES


def rows_of(n=240):
    good = [(i, " ".join(f"word{(i * 7 + k) % 97}" for k in range(60)) + ".", f"h{i % 4}") for i in range(n)]
    bad = [(1000 + i, " ### ".join(f"word{(i * 5 + k) % 89}" for k in range(60)), f"h{i % 2}") for i in range(n // 4)]
    return good + bad


def test_held_out_documents(spark, docs_of):
    rows = rows_of()
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _, _ in rows if i % 2], "doc_id long, quality int")
    got = {r.doc_id: r for r in qm.classify(docs_of(rows), labels).collect()}
    assert len(got) == len(rows)
    held = [i for i, _, _ in rows if i % 2 == 0]
    assert sum(got[i].kept == (i < 1000) for i in held) / len(held) > 0.97
    assert all(0 <= r.posterior <= 1 and 0 < r.path_share < 1 for r in got.values())
    assert got[2].host_share > got[0].host_share


def test_odd_rows(spark, docs_of):
    rows = [*rows_of(40), (5000, None, None), (5001, "", "h0"), (5002, "x " * 60_000, "h0"), (None, "a b", "h9"), (3, "word3 again", "h1")]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _, _ in rows_of(40)] + [(5001, 0), (5001, 1), (5002, None), (None, 1)], "doc_id long, quality int")
    out = qm.classify(docs_of(rows), labels).collect()
    assert len(out) == len(rows) and all(r.posterior is not None and not math.isnan(r.posterior) for r in out)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_labels_of_one_kind(spark, docs_of, labels):
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    assert qm.classify(docs_of(rows_of(8)), told).count() == 10
    assert qm.classify(docs_of([(1, "a")]).filter("doc_id > 1"), told).count() == 0


def test_sparse_groups_shrink_further(spark):
    same = spark.createDataFrame([("a", 100, 80.0), ("b", 100, 81.0), ("c", 3, 2.4)], "host string, n long, s double")
    apart = spark.createDataFrame([("a", 100, 99.0), ("b", 100, 20.0), ("c", 3, 0.0)], "host string, n long, s double")
    assert qm.strength(same, 163.4 / 203) > 20 > qm.strength(apart, 119 / 203)
    assert qm.strength(same.filter("n < 5"), 0.5) == 1e6


def test_site_levels(spark):
    urls = ["http://User@Th.example.com:80/fr/825?page=2", "https://m.x.net/#top", "no address", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(*(c.alias(n) for c, n in zip(qm.site_levels(F.col("u")), "hp", strict=True))).collect()
    assert [(r.h, r.p) for r in got] == [("th.example.com", "fr"), ("m.x.net", ""), ("", ""), (None, None)]


def test_op2_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op2_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    both = rows.join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in both) / len(both) > 0.95
    good = [r for r in both if r.quality == 1]
    assert sum(r.kept for r in good) / len(good) > 0.98
