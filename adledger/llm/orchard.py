"""Centroid clustering of integer vectors, with Orchard's search for the nearest centroid.

Each centroid has a list of the others, nearest first. A vector starts at some centroid and walks its list; a closer centroid,
or one as close with a smaller number, is jumped to at once, and its list is walked from the front. Centroids met before are
marked and not measured again. A walk ends where the list's distance is strictly more than twice the vector's: all that
follows is farther from the vector than the centroid it has. All vectors of a batch walk at once.

Distances and means are exact integers. Per round, a task sends one row of sums per centroid; the driver holds the centroids
(``k`` times ``dims`` numbers) and nothing that grows with the table.

Defined cases: vectors with another number of components, with a null or a non-finite one, and null vectors are left out.
A null id is hashed as the text ``null``. Rows that repeat an id are vectors of their own; equal hashes are ordered by the
components as text. Fewer vectors than centroids give fewer centroids; an empty table gives no rows. Components too large for
64-bit distances are worked on as unbounded integers; a distance or inertia beyond 64 bits is given as the largest long.
Other columns of the table are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.session import saved

#: Components below this keep squared distances of up to 4096 dimensions within 64 bits.
SAFE = 1 << 24
MOST = (1 << 63) - 1
#: Bits of the parts that unbounded integers are added in.
LIMB = 48
#: Vectors that walk at once.
WALKERS = 8192


def _whole_numbers(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Kept vectors as whole numbers; ``big`` says that unbounded integers are needed, which then travel as text."""
    for batch in batches:
        ids, vectors = batch.column(0).to_pylist(), batch.column(1)
        rows: list[tuple] = []
        if len(vectors) and not vectors.null_count:
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten()
            if (sizes == dims).all() and not flat.null_count:
                x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                if np.isfinite(x).all() and np.abs(x).max() * scale < SAFE:
                    whole = np.floor(x * scale).astype(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * dims, pa.int32()), pa.array(whole.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.nulls(len(ids), pa.string())], names=["vec_id", "v", "big"])
                    continue
        for i, v in zip(ids, vectors.to_pylist(), strict=True):
            if v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
                continue
            whole = [_scaled(float(x), scale) for x in v]
            small = all(abs(x) < SAFE for x in whole)
            rows.append((i, whole if small else None, None if small else ",".join(map(str, whole))))
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.string())], names=["vec_id", "v", "big"])


def _scaled(x: float, scale: int) -> int:
    """``floor(scale * x)``, the product in doubles; one that overflows is taken exactly."""
    return math.floor(x * scale) if math.isfinite(x * scale) else math.floor(x) * scale


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and the components, as ``v`` (longs) or, where one is very large, as ``big`` (text)."""
    given = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("vector"))
    return given.mapInArrow(partial(_whole_numbers, dims=dims, scale=scale), "vec_id long, v array<long>, big string")


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid, all centroids by distance from it (itself first), and these squared distances."""
    d = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    own = np.eye(len(centroids), dtype=bool)
    order = np.array([sorted(range(len(d)), key=lambda j: (not own[i, j], d[i, j], j)) for i in range(len(d))])
    return order, np.take_along_axis(d, order, axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of ``x`` its nearest centroid (of equals the smallest number), the squared distance, and all distances taken."""
    rows, k = np.arange(len(x)), len(centroids)
    at, step = np.zeros(len(x), np.int64), np.ones(len(x), np.int64)
    best = ((x - centroids[0]) ** 2).sum(axis=1)
    met = np.zeros((len(x), k), bool)
    met[:, 0] = True
    walking, taken = rows[: len(x) if k > 1 else 0], len(x)
    while len(walking):
        # Twice the distance, in squares; a list's end and this bound both end a walk.
        ahead = apart[at[walking], step[walking]] <= 4 * best[walking]
        walking = walking[ahead.astype(bool)]
        other = order[at[walking], step[walking]]
        step[walking] += 1
        fresh = ~met[walking, other]
        who, other = walking[fresh], other[fresh]
        met[who, other] = True
        d = ((x[who] - centroids[other]) ** 2).sum(axis=1)
        taken += len(who)
        closer = ((d < best[who]) | ((d == best[who]) & (other < at[who]))).astype(bool)
        who, other = who[closer], other[closer]
        at[who], best[who], step[who] = other, d[closer], 1
        walking = walking[step[walking] < k]
    return at, best, taken


def limbs(n: int) -> list[int]:
    """A whole number as signed parts of ``LIMB`` bits, the lowest first, which can be added one by one."""
    sign, n, out = (-1 if n < 0 else 1), abs(n), []
    while n or not out:
        out.append(sign * (n & ((1 << LIMB) - 1)))
        n >>= LIMB
    return out


def _walks(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, nearest centroids and distances, in 64 bits or, where a number is very large, as Python integers."""
    safe = all(abs(c) < SAFE for row in centroids for c in row)
    known: dict[type, tuple[np.ndarray, ...]] = {}
    for batch in batches:
        ids, v, big = batch.columns[:3]
        for large in (False, True):
            mine = big.is_valid() if large else big.is_null()
            own = ids.filter(mine)
            if not len(own):
                continue
            kind = object if large or not safe else np.int64
            if kind not in known:
                c = np.array(centroids, kind)
                known[kind] = (c, *neighbours(c))
            if large:
                x = np.array([[int(c) for c in b.split(",")] for b in big.filter(mine).to_pylist()], object)
            else:
                x = v.filter(mine).flatten().to_numpy().reshape(len(own), -1).astype(kind)
            for lo in range(0, len(own), WALKERS):
                part = x[lo:lo + WALKERS]
                at, d, _ = nearest(part, *known[kind])
                yield own[lo:lo + WALKERS], part, at, d


def _sums(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """Vectors and componentwise sums per centroid, once for the whole task."""
    count, total = [0] * len(centroids), np.zeros((len(centroids), len(centroids[0])), object)
    for _, x, at, _ in _walks(batches, centroids):
        for j in np.unique(at).tolist():
            mine = x[at == j]
            count[j] += len(mine)
            total[j] += mine.sum(axis=0).astype(object)
    rows = [(j, p, i, count[j], part) for j, n in enumerate(count) if n for p, s in enumerate(total[j]) for i, part in enumerate(limbs(int(s)))]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "place", "limb", "n", "part"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    for ids, _, at, d in _walks(batches, centroids):
        parts = [limbs(v) for v in d.tolist()] if d.dtype == object else [[v] for v in d.tolist()]
        yield pa.RecordBatch.from_arrays([ids, pa.array(at, pa.int32()), pa.array([min(v, MOST) for v in d.tolist()], pa.int64()), pa.array(parts, pa.list_(pa.int64()))], names=["vec_id", "cluster", "distance", "parts"])


def _text(whole: Column, big: Column) -> Column:
    return F.coalesce(big, F.array_join(whole.cast("array<string>"), ","))


def first_centroids(whole: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``seed:id``, in the order of the hashes."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = whole.select(F.sha2(name, 256).alias("h"), _text(F.col("v"), F.col("big")).alias("c")).orderBy("h", "c").limit(k).collect()
    return [[int(x) for x in r["c"].split(",")] for r in rows]


def moved(whole: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every centroid becomes the floor of its vectors' mean, those without vectors stay.

    Sums of tasks are added per centroid and component in Spark; k times dims rows, as a rule, come to the driver.
    """
    sent = whole.mapInArrow(partial(_sums, centroids=centroids), "cluster long, place long, limb long, n long, part long")
    added = sent.groupBy("cluster", "place", "limb").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()
    sums: dict[tuple[int, int], list[int]] = {}
    for r in added:
        of = sums.setdefault((r["cluster"], r["place"]), [0, 0])
        of[0], of[1] = max(of[0], r["n"]), of[1] + (int(r["s"]) << (LIMB * r["limb"]))
    out = [list(c) for c in centroids]
    for (j, p), (n, s) in sums.items():
        out[j][p] = s // n
    return out


def clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of every kept vector with its cluster's and the whole inertia and
    its ``centroid`` as text; and the centroids."""
    whole = saved(whole_vectors(vectors, id_col, vec_col, dims, scale), "whole-vectors")
    centroids = first_centroids(whole, k, seed)
    if not centroids:
        empty = whole.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid"))
        return empty, []
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    rows = saved(whole.mapInArrow(partial(_assigned, centroids=centroids), "vec_id long, cluster int, distance long, parts array<long>"), "clusters")
    parts = rows.select("cluster", F.posexplode("parts").alias("limb", "part"))
    per: dict[int, int] = {}
    for r in parts.groupBy("cluster", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect():
        per[r["cluster"]] = per.get(r["cluster"], 0) + (int(r["s"]) << (LIMB * r["limb"]))
    spark = vectors.sparkSession
    facts = [(j, min(s, MOST), min(sum(per.values()), MOST), ",".join(map(str, centroids[j]))) for j, s in per.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid string")
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"), centroids
