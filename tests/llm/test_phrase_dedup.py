"""Removed words against brute force; automata, labels and odd rows."""

import hashlib
import random
import re

import pytest

from adledger.llm import phrase_dedup as pd
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(texts, window):
    """Removed runs of words of each text, in the order of the list."""
    seen, out = set(), []
    for words in (WORD.findall(t or "") for t in texts):
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        runs = []
        for i in sorted(gone):
            if runs and runs[-1][1] == i:
                runs[-1] = (runs[-1][0], i + 1)
            else:
                runs.append((i, i + 1))
        out.append(runs)
    return out


def kept(text, gone):
    words = WORD.findall(text or "")
    return " ".join(w for i, w in enumerate(words) if not any(s <= i < e for s, e in gone))


def made(rnd, n):
    pool = [[rnd.choice(["a", "b", "é", "la la", "x y"]) + str(rnd.randrange(9)) for _ in range(rnd.randrange(1, 120))] for _ in range(5)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randrange(6)):
            r, p = rnd.random(), rnd.choice(pool)
            i = rnd.randrange(len(p))
            words += p[i:i + rnd.randrange(90)] if r < 0.5 else [rnd.choice("ab")] * rnd.randrange(60) if r < 0.6 else [rnd.choice("abcdefgh") for _ in range(rnd.randrange(60))]
        texts.append("".join(w + rnd.choice([" ", "\n", "\t ", " \x0b"]) for w in words))
    return texts


@pytest.mark.parametrize("window,hot,shard", [(8, 4096, 1 << 17), (20, 4096, 50), (5, 3, 200), (11, 2, 1)])
def test_made_texts(docs_of, monkeypatch, window, hot, shard):
    monkeypatch.setattr(pd, "SHARD", shard)
    texts = made(random.Random(window), 70)
    rows = {r.doc_id: r for r in pd.remove_passages(docs_of(list(enumerate(texts))), window=window, hot=hot, remembered=5).collect()}
    assert len(rows) == len(texts)
    for i, (text, gone) in enumerate(zip(texts, brute(texts, window), strict=True)):
        assert [(s.start, s.end) for s in rows[i].removed] == gone
        assert rows[i].n_words == len(WORD.findall(text)) and bytes(rows[i].kept).decode() == kept(text, gone)


def test_shard_finds_every_later_place():
    rnd = random.Random(4)
    for _ in range(40):
        window = rnd.randrange(2, 7)
        texts = [[rnd.choice("abc") for _ in range(rnd.randrange(window, 40))] for _ in range(6)]
        got = pd.later_places([" ".join(t).encode() for t in texts], [(i, 0, 100) for i in range(6)], window)
        covered = [{(k, j - 100) for k, _, s, n in got for j in range(s, s + n) if k == i} for i in range(6)]
        for i, gone in enumerate(brute([" ".join(t) for t in texts], window)):
            assert covered[i] == {(i, j) for s, e in gone for j in range(s, e)}


def test_odd_rows(docs_of):
    short, long_ = " ".join("x" for _ in range(19)), " ".join(f"w{i}" for i in range(300))
    rows = [(1, None), (2, ""), (3, short), (4, short), (5, long_), (5, long_), (6, long_ + "\n"), (None, "first " + long_), (7, "é " * 5_000), (8, " \t\n")]
    got = [(r.doc_id, [(s.start, s.end) for s in r.removed], r.n_words) for r in pd.remove_passages(docs_of(rows)).collect()]
    want = [(1, [], 0), (2, [], 0), (3, [], 19), (4, [], 19), (5, [(0, 300)], 300), (5, [(0, 300)], 300), (6, [(0, 300)], 300), (None, [], 301), (7, [(1, 5000)], 5000), (8, [], 0)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pd.remove_passages(docs_of([(1, "x")]).filter("doc_id > 1")).count() == 0


def test_op13_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r.doc_id: r for r in QUERIES["op13_phrase_dedup"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for (i, text), gone in zip(docs, brute([t for _, t in docs], 20), strict=True):
        r = rows[i]
        assert (r.n_words, r.n_removed) == (len(WORD.findall(text or "")), sum(e - s for s, e in gone))
        assert r.kept_sha256 == hashlib.sha256(kept(text, gone).encode()).hexdigest()
