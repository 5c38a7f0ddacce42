"""The mix: targets, exact quotas, disjoint blocks, whole passes, and the same rows on every run."""

import re
from collections import Counter, defaultdict

import numpy as np

from adledger.llm import mixing
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    capped = mixing.targets([10, 500, 490])
    assert capped[0] == 30.0 and abs(sum(capped) - 1000) < 1e-9 and abs(capped[1] / capped[2] - 2) < 1e-9
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    assert mixing.targets([0, 10]) == [0.0, 10.0]


def test_tree_splits_quotas_exactly():
    quotas = np.array([1000, 37, 0, 5])
    shards = [mixing.shard_quotas(quotas, 7, k, 1) for k in range(7)]
    assert sum(h for h, _ in shards).tolist() == quotas.tolist()
    for (h, b), (_, after) in zip(shards, shards[1:], strict=False):
        assert (h + b).tolist() == after.tolist()
    assert max(h.sum() for h, _ in shards) - min(h.sum() for h, _ in shards) <= 3


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 64, 1000):
        got = mixing.permuted(np.arange(n), n, "k")
        assert sorted(got.tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, "a").tolist() != mixing.permuted(np.arange(1000), 1000, "b").tolist()


def mixed(docs, **options):
    whole, pieces = mixing.mix(docs, **options)
    return whole.collect(), pieces.collect()


def test_odd_rows(docs_of):
    rows = [(1, "a b c " * 50, "x"), (2, None, "x"), (3, "", None), (4, "d e " * 400, None), (4, "d e " * 400, None), (5, "w " * 30_000, "y"), (None, "q r s", "z"), (6, " \n", "x")]
    whole, pieces = mixed(docs_of(rows))
    assert len(whole) == len(rows)
    sizes = defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    taken, target = defaultdict(int), {}
    for r in whole:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = ["x", "y", "z", None]
    assert [target[s] for s in names] == mixing.targets([sizes[s] for s in names])
    assert all(abs(taken[s] - target[s]) <= max(2, sizes[s] / 128) for s in names)
    spans = defaultdict(list)
    for p in pieces:
        spans[p.row_id, p.copy].append((p.first_word, p.first_word + p.n_words))
    for s in spans.values():
        s.sort()
        assert all(a[1] <= b[0] for a, b in zip(s, s[1:], strict=False))


def test_reruns_agree_however_rows_are_dealt(docs_of):
    rows = [(i, f"word{i} " * (i % 13), f"s{i % 3}") for i in range(400)]
    one, two = (sorted((r.doc_id, r.taken) for r in mixed(docs_of(rows, n), words_per_shard=500)[0]) for n in (1, 5))
    assert one == two


def test_documents_of_the_mix(docs_of):
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(40)), "a" if i % 5 else "b") for i in range(200)]
    docs = docs_of(rows)
    whole = {r.doc_id: r for r in mixing.mix(docs)[0].collect()}
    out = mixing.mixed_documents(docs, words_per_shard=1000)
    assert out.columns == docs.columns
    got, texts = Counter(), dict((i, t) for i, t, _ in rows)
    for r in out.collect():
        assert set(r.text.split()) <= set(texts[r.doc_id].split()) and r.n_chars == len(r.text)
        got[r.doc_id] += len(r.text.split())
    assert sum(got.values()) > 0 and len(whole) == 200


def test_empty_table(docs_of):
    docs = docs_of([(1, "a")]).filter("doc_id > 1")
    assert mixed(docs) == ([], [])


def test_op9(spark):
    rows = QUERIES["op9_source_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for d in docs.values():
        sizes[d.source] += len(WORD.findall(d.text or ""))
    for r in rows:
        s = docs[r.doc_id].source
        assert r.size == len(WORD.findall(docs[r.doc_id].text)) and r.source_size == sizes[s] and r.taken <= 3 * r.size
        taken[s] += r.taken
        target[s] = r.target
    order = sorted(sizes)
    assert [target[s] for s in order] == mixing.targets([sizes[s] for s in order])
    assert all(abs(taken[s] - target[s]) <= max(2, sizes[s] / 128) for s in order)


def test_documents_come_whole(docs_of):
    rows = [(i, f"  t{i} " + "\n".join(f"t{i}x{k}" for k in range(5 + i * 37 % 300)), f"s{i % 23}") for i in range(230)]
    texts, target = {i: t for i, t, _ in rows}, {}
    out = mixing.mixed_documents(docs_of(rows), words_per_shard=1000).collect()
    cut = [r for r in out if r.text != texts[r.doc_id]]
    assert len(out) > 200 and len({r.source for r in cut}) == len(cut)
    assert all(texts[r.doc_id].split()[:len(r.text.split())] == r.text.split() for r in cut)
    whole, _ = mixed(docs_of(rows))
    taken = Counter()
    for r in out:
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[r.source] - r.target) <= 1 for r in whole)
    passes = Counter(r.doc_id for r in out)
    assert all(passes[r.doc_id] in (int(r.target // r.source_size), int(r.target // r.source_size) + 1) for r in whole)
