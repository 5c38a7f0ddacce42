"""Exact and near dedup against brute force, on odd rows and on the smallest given table."""

import random

import numpy as np
import xxhash

from adledger.llm import components, exact_dedup, simhash
from adledger.llm.queries import QUERIES
from adledger.llm import rows as rows_of
from adledger.llm.rows import keep_decided

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta " * 40_000
ODD = [(1, "a b c"), (2, None), (3, ""), (4, "a b c"), (5, "a b c "), (6, LONG), (7, LONG), (8, LONG + "x"), (None, "a b c"), (9, "é\x00ü"), (9, "é\x00ü"), (10, " \t ")]


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    bits = np.zeros(64, int)
    for g in grams:
        h = xxhash.xxh64(g, seed=42).intdigest()
        bits += [h >> i & 1 for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(grams))


def brute_roots(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_exact_classes_of_odd_rows(docs_of):
    rows = exact_dedup.exact_classes(docs_of(ODD)).collect()
    texts = {}
    for i, t in ODD:
        texts.setdefault(t or "", []).append(i)
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in rows) == sorted(
        (i or 0, max(x or 0 for x in texts[t or ""]), len(texts[t or ""])) for i, t in ODD)
    assert sum(r.kept for r in rows) == len(texts)


def test_exact_dedup_keeps_one_row_of_each_text(docs_of):
    docs = docs_of(ODD)
    kept = keep_decided(docs, exact_dedup.exact_classes(docs))
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({t or "" for _, t in ODD})


def test_long_texts_are_cut_by_content(docs_of):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(200_000))
    rows = exact_dedup.chunked(docs_of([(1, base), (2, "in front " + base)])).collect()
    first, second = ({c.sha for c in r.chunks} for r in rows)
    assert all(sum(c.n_bytes for c in r.chunks) == r.n_bytes for r in rows)
    assert len(first) > 20 and len(first & second) >= len(first) - 2


def test_chunks_of_one_key_are_told_apart(spark):
    chunk = "array<struct<key:long,n_bytes:int,sha:binary>>"
    rows = spark.createDataFrame([(0, [(5, 3, b"a"), (5, 3, b"b")]), (1, [(5, 3, b"a"), (5, 3, b"a")]), (2, [(5, 3, b"a"), (5, 3, b"b")])], f"row_id long, chunks {chunk}")
    got = {r.row_id: r.recipe for r in exact_dedup.recipes(rows).collect()}
    assert got[0] == got[2] != got[1]


def test_empty_tables(docs_of):
    docs = docs_of([(1, "x")]).filter("doc_id > 1")
    assert exact_dedup.exact_classes(docs).count() == simhash.near_classes(docs).count() == 0
    assert keep_decided(docs, simhash.near_keepers(docs)).count() == 0


def test_covering_masks_cover_all_pairs():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def test_links_of_small_and_large_buckets(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(6)]
    values = list({b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(5))) & (1 << 64) - 1 for b in base for _ in range(60)})
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    want = brute_roots(values)
    for bucket in (2, 8, 1000):
        got = {r.node % (1 << 64): r.root % (1 << 64) for r in components.components(simhash.near_links(frame, bucket=bucket)).collect()}
        classes = {}
        for v, w in zip(values, want, strict=True):
            classes.setdefault(w, set()).add(v)
        mine = {}
        for v in values:
            mine.setdefault(got.get(v, v), set()).add(v)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


def test_near_classes_of_odd_rows(docs_of):
    rows = simhash.near_classes(docs_of(ODD)).collect()
    assert sorted((r.doc_id or 0, r.fp % (1 << 64)) for r in rows) == sorted((i or 0, brute_print(t)) for i, t in ODD)
    assert {r.component_id for r in rows if r.fp == 0} == {2}


def test_op8_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs.sort()
    prints = [brute_print(t) for _, t in docs]
    roots = brute_roots(prints)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_near_dedup"](spark, SF).collect()}
    assert got == {(i, f"{p:016x}", docs[r][0]) for (i, _), p, r in zip(docs, prints, roots, strict=True)}


def changed(rnd, words, n):
    out = list(words)
    for i in rnd.sample(range(len(out)), n):
        out[i] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


def jaccard(a, b):
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_similar_texts_are_found_and_others_stay(docs_of):
    rnd = random.Random(4)
    texts = []
    for g in range(40):
        words = [f"w{rnd.randrange(4000)}" for _ in range(200)]
        texts += [" ".join(words), changed(rnd, words, 3), changed(rnd, words, 40)]
    kept = {r.doc_id: r.kept for r in simhash.similar_keepers(docs_of(list(enumerate(texts)))).collect()}
    assert min(jaccard(texts[k], texts[k + 1]) for k in range(0, 120, 3)) > 0.8 > max(jaccard(texts[k], texts[k + 2]) for k in range(0, 120, 3))
    assert all(kept[k] and kept[k + 2] for k in range(0, 120, 3))
    assert sum(not kept[k + 1] for k in range(0, 120, 3)) >= 38


def test_a_crowd_of_similar_texts(docs_of, spark):
    rnd = random.Random(6)
    words = [f"w{rnd.randrange(4000)}" for _ in range(300)]
    texts = [changed(rnd, words, 2) for _ in range(120)] + [" ".join(f"v{rnd.randrange(4000)}" for _ in range(300)) for _ in range(30)]
    rows = docs_of(list(enumerate(texts)))
    signed_rows = spark.createDataFrame([(i, *([int(x) for x in s.view(np.int64)] for s in simhash.signature(t.encode()))) for i, t in enumerate(texts)], "row_id long, words array<long>, sketch array<long>")
    for bucket in (64, 4):
        roots = {r.node: r.root for r in components.components(simhash.similar_links(signed_rows, bucket=bucket)).collect()}
        assert set(roots) == set(range(120)) and set(roots.values()) == {0}
    assert sorted(r.doc_id for r in simhash.similar_keepers(rows).filter("kept").collect()) == [0, *range(120, 150)]


def test_similar_keepers_of_odd_rows(docs_of):
    rows = simhash.similar_keepers(docs_of(ODD)).collect()
    kept = sorted((r.doc_id if r.doc_id is not None else -1) for r in rows if r.kept)
    assert len(rows) == len(ODD) and kept == [-1, 2, 6, 9]
    assert simhash.similar_keepers(docs_of([(1, "x")]).filter("doc_id > 1")).count() == 0


def kept_by_brute_force(texts, least=0.8):
    roots, sets = list(range(len(texts))), [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                roots[max(find(i), find(j))] = min(find(i), find(j))
    return {i for i in range(len(texts)) if find(i) == i}


def test_appended_replaced_and_scattered_edits_against_brute_force(docs_of):
    rnd = random.Random(9)
    words_of = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    texts = []
    for g in range(90):
        words, part = words_of(200), words_of(8 + g % 45)
        edits = [words + part, part[:22] + words[len(part[:22]):], changed(rnd, words, 1 + g % 7).split()]
        texts += [" ".join(words), " ".join(edits[g % 3])]
    alike = [jaccard(a, b) for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert sum(x >= 0.8 for x in alike) > 50 and sum(0.8 <= x < 0.85 for x in alike) > 10 and sum(x < 0.8 for x in alike) > 10
    assert {r.doc_id for r in simhash.similar_keepers(docs_of(list(enumerate(texts)))).filter("kept").collect()} == kept_by_brute_force(texts)


def test_pairs_at_just_the_similarity_asked(docs_of):
    words = [f"w{k}" for k in range(84)]
    texts = [" ".join(words), " ".join(words + [f"x{k}" for k in range(20)]), " ".join(["y", *words, "z"]), "v " + " ".join(words + [f"x{k}" for k in range(20)])]
    assert jaccard(texts[0], texts[1]) == 0.8
    assert {r.doc_id for r in simhash.similar_keepers(docs_of(list(enumerate(texts[:2])))).filter("kept").collect()} == {0}
    assert jaccard(texts[0], texts[3]) < 0.8
    assert {r.doc_id for r in simhash.similar_keepers(docs_of([(0, texts[0]), (3, texts[3])])).filter("kept").collect()} == {0, 3}


def test_a_crowd_that_holds_separate_pairs(docs_of, spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = [f"w{k}" for k in range(120)]
    texts = [" ".join(rnd.sample(vocabulary, 120)) for _ in range(60)]
    texts += [" ".join([*t.split(), t.split()[0]]) for t in texts[:20]]
    assert {r.doc_id for r in simhash.similar_keepers(docs_of(list(enumerate(texts)))).filter("kept").collect()} == kept_by_brute_force(texts) == set(range(60))
    frame = [" ".join(vocabulary + [f"v{rnd.randrange(10**6)}" for _ in range(40)]) for _ in range(50)]
    frame += [f"{t} end" for t in frame[:15]]
    rows = spark.createDataFrame([(i, *([int(x) for x in s.view(np.int64)] for s in simhash.signature(t.encode()))) for i, t in enumerate(frame)], "row_id long, words array<long>, sketch array<long>")
    monkeypatch.setattr(simhash, "BLOCK", 8)
    roots = {r.node: r.root for r in components.components(simhash.similar_links(rows, bucket=4)).collect()}
    assert {i for i in range(65) if roots.get(i, i) == i} == kept_by_brute_force(frame) == set(range(50))


def test_just_below_the_similarity_asked(docs_of):
    """Four shingles of five make 0.8 and are dropped; four of six are kept."""
    rows = [(6, "a b c d a b c d " * 9), (8, "a b c d " * 18 + "x"), (9, "a b c d " * 18 + "x y")]
    assert {jaccard(rows[0][1], t) for _, t in rows[1:]} == {4 / 5, 4 / 6}
    assert {r.doc_id for r in simhash.similar_keepers(docs_of(rows[:2])).filter("kept").collect()} == {6}
    assert {r.doc_id for r in simhash.similar_keepers(docs_of([rows[0], rows[2]])).filter("kept").collect()} == {6, 9}


def test_a_sieve_lets_all_keys_pass_and_few_others(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "key").union(spark.sql("SELECT CAST(NULL AS LONG)"))
    rows = rows_of.sifted(spark.range(-50, 3000).selectExpr("id AS bucket2", "IF(id < 0, NULL, id) AS id"), "id", rows_of.sieve(keys, "key"))
    got = [(r.id, r.may) for r in rows.collect()]
    assert all(may for i, may in got if i is None or i % 3 == 0) and sum(may for i, may in got if i is not None and i % 3) < 20


def test_kept_rows_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d", True) for i, t in ODD], "doc_id long, text string, k_id string, sha string, may string, row string, bits boolean")
    kept = keep_decided(docs, exact_dedup.exact_classes(docs))
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t in ODD})
