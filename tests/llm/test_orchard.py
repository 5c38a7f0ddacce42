"""Orchard's search against plain search; clusters against brute force; odd vectors."""

import hashlib
import math
import random

import numpy as np

from adledger.llm import orchard
from adledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, dims, scale, k, rounds, seed=1):
    """Cluster and distance of each kept row, in order, and the centroids."""
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, _, v in sorted((name(i), ",".join(map(str, v)), v) for i, v in kept)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, o) in zip(kept, own, strict=True) if o == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign(), strict=True)], centroids


def test_search_equals_plain_search():
    rnd = np.random.default_rng(1)
    for trial in range(200):
        dims, k = int(rnd.integers(1, 6)), int(rnd.integers(1, 12))
        kind = np.int64 if trial % 4 else object
        x, c = rnd.integers(-4, 5, (50, dims)).astype(kind), rnd.integers(-4, 5, (k, dims)).astype(kind)
        at, d, taken = orchard.nearest(x, c, *orchard.neighbours(c))
        all_d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).astype(np.int64)
        assert at.tolist() == all_d.argmin(axis=1).tolist() and d.tolist() == all_d.min(axis=1).tolist()
        assert taken <= 50 * k


def test_search_leaves_far_centroids_alone():
    rnd = np.random.default_rng(2)
    c = rnd.integers(-10_000, 10_000, (64, 3))
    x = c[rnd.integers(0, 64, 500)] + rnd.integers(-20, 20, (500, 3))
    assert orchard.nearest(x, c, *orchard.neighbours(c))[2] < 500 * 24


def test_limbs():
    for n in (0, -1, 5, 1 << 48, -(1 << 100) - 7, 10**45):
        assert sum(p << (orchard.LIMB * i) for i, p in enumerate(orchard.limbs(n))) == n


def frame(spark, rows):
    full = [(i, v, 3, "x", [1], 2) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, cluster int, big string, v array<long>, distance long").repartition(3)


def test_made_vectors(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(200), [float(np.float32(rnd.gauss(0, 1) + 3 * (i % 3)))] * 2 + [float(rnd.randrange(-2, 3))]) for i in range(300)]
    rows += [(None, [1.0, 2.0, 3.0]), (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [math.nan, 1.0, 2.0]), (5, [math.inf, 0.0, 0.0]), (6, [1.0, 2.0]), (7, [0.0] * 4)]
    got, centroids = orchard.clusters(frame(spark, rows), dims=3, scale=8, k=7, rounds=4)
    got = got.collect()
    want, final = brute(rows, 3, 8, 7, 4)
    assert centroids == final
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(want, key=str)
    inertia = sum(d for _, _, d in want)
    for r in got:
        assert r.inertia == inertia and r.cluster_inertia == sum(d for _, j, d in want if j == r.cluster)
        assert r.centroid == ",".join(map(str, final[r.cluster]))


def test_huge_components_and_few_vectors(spark):
    huge = float(np.float32(3e38))
    rows = [(1, [huge, 1.0]), (2, [-huge, 0.5]), (3, [0.25, 0.25]), (4, [1e12, -1e12]), (4, [1e12, -1e12])]
    got, centroids = orchard.clusters(frame(spark, rows), dims=2, k=16, rounds=2)
    want, final = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 2, 64, 16, 2)
    assert len(centroids) == 5 and centroids == final
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect()) == sorted((i, j, min(d, orchard.MOST)) for i, j, d in want)
    far, _ = orchard.clusters(frame(spark, rows), dims=2, k=1, rounds=0)
    assert {r.inertia for r in far.collect()} == {orchard.MOST}


def test_no_vectors(spark):
    rows, centroids = orchard.clusters(frame(spark, [(1, None)]))
    assert rows.count() == 0 and centroids == [] and "centroid" in rows.columns


def test_op11_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, final = brute(rows, 64, 64, 16, 3)
    got = QUERIES["op11_centroid_clustering"](spark, SF).collect()
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    assert sorted((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == sorted((i, j, d, hashes[j]) for i, j, d in want)
