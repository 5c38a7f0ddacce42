"""Best documents of each item against scoring all, on made and given texts; groups left alone; odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from adledger.llm import mask_ranking as mr
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), t) for t in TERM.findall(text or "")]


def brute(docs, items, most=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:most], 1)]
    return out


def collected(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "item_id long, text string, rank int, doc_id string, score int")


@pytest.mark.parametrize("cells,block", [(1 << 22, 2048), (1, 3)])
def test_made_texts(spark, docs_of, monkeypatch, cells, block):
    monkeypatch.setattr(mr, "CELLS", cells)
    monkeypatch.setattr(mr, "ITEMS", block)
    rnd = random.Random(5)
    pool = ["The", "the", "a", "É", "é", "x1", "1", "zz", "naïve", "日本", "K", "İ", *(f"w{i}" for i in range(30))]
    text = lambda n: "".join(rnd.choice(pool[:8] if rnd.random() < 0.6 else pool) + rnd.choice([" ", "-", "\n", "_", ". "]) for _ in range(rnd.randrange(n)))
    docs = [(i, text(60)) for i in range(400)]
    items = [(i, text(14)) for i in range(12)]
    assert collected(mr.best_documents(docs_of(docs, 5), items_of(spark, items))) == sorted(brute(docs, items), key=str)


def test_odd_rows(spark, docs_of):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (5, "... !"), (6, "a " * 30_000), (7, "b"), (-4, "a b"), (8, "c")]
    items = [(1, "A, b!"), (2, None), (3, "?"), (None, "b"), (5, "nowhere"), (1, "c")]
    assert collected(mr.best_documents(docs_of(docs), items_of(spark, items), most=4)) == sorted(brute(docs, items, 4), key=str)
    assert mr.best_documents(docs_of([(1, "x")]).filter("doc_id > 1"), items_of(spark, items)).count() == 0
    assert mr.best_documents(docs_of(docs), items_of(spark, items).filter("item_id > 90")).count() == 0


def test_groups_below_the_bound_are_left_alone():
    rnd = np.random.default_rng(6)
    n, terms_ = 3000, 12
    held = [rnd.choice(terms_, rnd.integers(1, 5), replace=False) for _ in range(n)]
    offsets = np.cumsum([0, *map(len, held)])
    rows = mr.Postings(np.arange(n), rnd.integers(5, 60, n), offsets, np.concatenate(held), np.ones(offsets[-1], np.int64), rnd.integers(100, 9000, terms_), n, 30 * n)
    best: list = []
    scored = rows.rank(np.arange(terms_), best, 10)
    every = sorted(zip((-rows.gain.sum(axis=0)).tolist(), range(n), strict=True))[:10]
    assert sorted((-s, -i) for s, i in best) == every and scored < n / 3


def test_op12_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert collected(QUERIES["op12_lexical_search"](spark, SF)) == sorted(brute(docs, items), key=str)
