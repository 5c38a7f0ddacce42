"""Removed bytes against brute force; the transform and its intervals against plain comparison."""

import hashlib
import random

import numpy as np
import pytest

from adledger.llm import substring_dedup as sd
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(bodies, least):
    """Removed runs of each body, in the order of the list."""
    seen, out = set(), []
    for body in bodies:
        covered = np.zeros(len(body) + 2, int)
        for i in range(len(body) - least + 1):
            if body[i:i + least] in seen:
                covered[i + 1:i + least + 1] = 1
            seen.add(body[i:i + least])
        edge = np.diff(covered)
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)))
    return out


def made(rnd, n):
    pool = ["".join(rnd.choice("abc é") for _ in range(rnd.randrange(1, 400))) for _ in range(4)]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.randrange(5)):
            r, p = rnd.random(), rnd.choice(pool)
            i = rnd.randrange(len(p))
            text += p[i:i + rnd.randrange(300)] if r < 0.5 else rnd.choice(["a", "ab", "abc"]) * rnd.randrange(1, 250) if r < 0.65 else "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(300)))
        texts.append(text)
    return texts


def test_intervals_part_rows_like_plain_comparison():
    rnd = np.random.default_rng(0)
    for _ in range(60):
        least, parts = int(rnd.integers(1, 12)), []
        for _ in range(rnd.integers(1, 12)):
            new = rnd.integers(0, 3, rnd.integers(1, 60))
            parts.append(np.concatenate([new[:5], parts[rnd.integers(len(parts))][3:]]) if parts and rnd.random() < 0.6 else new)
        text = np.concatenate([np.append(p, sd.END) for p in parts])
        order = sd.rotations(text, least + 1)
        rows = [tuple(np.roll(text, -i)[:least]) for i in order]
        assert rows == sorted(rows)
        assert sd.parted(text, order, least).tolist() == [True, *(a != b for a, b in zip(rows, rows[1:], strict=False)), True]


@pytest.mark.parametrize("least,hot", [(20, 32_768), (100, 32_768), (30, 3)])
def test_made_texts(docs_of, least, hot):
    texts = made(random.Random(least), 60)
    rows = {r.doc_id: r for r in sd.remove_repeats(docs_of(list(enumerate(texts))), least=least, hot=hot, remembered=5).collect()}
    for i, (text, gone) in enumerate(zip(texts, brute([t.encode() for t in texts], least), strict=True)):
        assert [(s.start, s.end) for s in rows[i].removed] == gone
        assert rows[i].n_bytes == len(text.encode())


def test_odd_rows(docs_of):
    a, b = "x" * 99, "".join(chr(97 + i % 26) + str(i) for i in range(200))
    rows = [(1, None), (2, ""), (3, a), (4, a), (5, b), (5, b), (6, b), (None, "0" + b), (7, "é" * 20_000), (8, a + "x")]
    got = [(r.doc_id, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in sd.remove_repeats(docs_of(rows)).collect()]
    assert len(got) == len(rows)
    for i, text in rows:
        body = (text or "").encode()
        if i in (5, 6):
            want = [(0, len(body))]
        elif i == 7:
            want = [(2, len(body))]
        else:
            want = []
        kept = body[:want[0][0]] if want else body
        assert got.count((i, want, kept)) == rows.count((i, text))
    assert sd.remove_repeats(docs_of([(1, "x")]).filter("doc_id > 1")).count() == 0


def test_op4_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r.doc_id: r for r in QUERIES["op4_suffix_array_dedup"](spark, SF).collect()}
    for (i, body), gone in zip(docs, brute([b for _, b in docs], 100), strict=True):
        kept, at = b"", 0
        for s, e in gone:
            kept, at = kept + body[at:s], e
        kept += body[at:]
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(body), sum(e - s for s, e in gone), len(gone), hashlib.sha256(kept).hexdigest())
