"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Every bit position gets a non-zero vector of radius + 1 bits, and there is a table for each non-zero vector v; its key
keeps the positions whose vector has an odd product with v. Two fingerprints that differ in at most ``radius`` positions
collide in some table, always: the vectors of those positions leave a v that is orthogonal to all of them.

Defined cases: a null text is empty. A text without words has fingerprint zero, which links like any other. Rows that
repeat id or text share a component. Null ids are passed over by minima; a component of null ids only has a null id.
An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.components import components
from adledger.llm.rows import Scratch, bodies, dealt, sieve, sifted, slices
from adledger.session import saved

BITS = 64
SEED = 42


def fingerprint(body: bytes, shingle: int = 3) -> int:
    """Bits set in more than half of the shingles' XXH64 values; words are lower-cased in A-Z and split at ASCII space."""
    words = body.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        return digest(join(words), SEED)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(words) - shingle + 1, 1 << 16):
        part = words[at:at + (1 << 16) + shingle - 1]
        hashes = np.array([digest(join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)), strict=False)], np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * counts > len(words) - shingle + 1
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [b.as_py() for b in batch.column(1)]
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        keys = [hashlib.sha256(t).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys), pa.array(values)], names=["doc_id", "text_sha256", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id``, ``text_sha256`` and ``fp`` (64 bits as a signed long) of every row."""
    return bodies(docs, id_col, text_col).mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, text_sha256 string, fp long")


def covering_masks(radius: int) -> list[int]:
    """The 2**(radius + 1) - 1 masks; position i has the vector i mod their number plus 1."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((i % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _within(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def near_links(distinct: DataFrame, radius: int = 2, bucket: int = 64) -> DataFrame:
    """Edges (a, b) that connect just what all pairs of ``fp`` within ``radius`` connect.

    Buckets of up to ``bucket`` fingerprints are compared in pairs. Members of larger ones go another exact way, without
    buckets: each is put under all values one half of the radius away, and two that meet there are within the radius
    (an odd radius has its remaining step checked by the pairs that meet). Such a meeting holds few members by nature.
    """
    masks = covering_masks(radius)
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(masks)))
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    total = len(masks) * distinct.count()
    sizes = saved(dealt(rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), total), "buckets")
    crowded = saved(dealt(rows.join(sizes, ["t", "key"]), total), "bucket-members")
    lists = crowded.filter(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("m"))
    pairs = F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (y > x) & _within(x, y, radius)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    cold = lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    if radius != 2:
        raise ValueError("the exact way for large buckets is written for radius 2")
    flips = F.array(F.lit(0).cast("long"), *(F.lit(signed(1 << i)) for i in range(BITS)))
    members = crowded.filter(F.col("n") > bucket).select("fp").distinct()
    balls = members.select("fp", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("fp")))).alias("z"))
    meet = balls.groupBy("z").agg(F.collect_list("fp").alias("m")).filter(F.size("m") > 1)
    hot = meet.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).filter("a <> b")
    return cold.union(hot)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, bucket: int = 64) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_sha256, fp and component_id, the least id that links reach."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    total = prints.count()
    distinct = saved(dealt(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), total), "distinct-fingerprints")
    roots = components(near_links(distinct, radius, bucket), 7 * total)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = saved(dealt(rooted, total), "roots")
    ids = saved(dealt(rooted.groupBy("root").agg(F.min("least").alias("component_id")), total), "component-ids")
    names = saved(dealt(rooted.join(ids, "root").select("fp", "component_id"), total), "component-of")
    return prints.join(names, "fp").select("doc_id", "text_sha256", "fp", "component_id")


def near_keepers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """doc_id, text_sha256, kept: one row of each component stays, that with its least id (one of them, if it repeats)."""
    rows = saved(near_classes(docs, id_col, text_col, **options).withColumn("row_id", F.monotonically_increasing_id()), "near-classes")
    first = saved(rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(F.min("row_id").alias("first")), "near-first")
    first = first.withColumnRenamed("first", "row_id").select("row_id", F.lit(True).alias("kept"))
    return rows.join(first, "row_id", "left").select("doc_id", "text_sha256", F.coalesce("kept", F.lit(False)).alias("kept"))


# --- by the similarity of five-word shingles ------------------------------------------------------------

#: Members of a crowd that meet in one task.
BLOCK = 512
#: Texts that are read to learn which shingles are frequent; only the work depends on it, and no result.
ORDER_SAMPLE = 20_000
#: Frequent shingles that are told apart, and the least number of sampled texts that makes one frequent.
ORDER_MOST, ORDER_LEAST = 100_000, 3


def shingle_set(body: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted XXH64 values of the distinct shingles; of fewer words the whole sequence is one, and no words are one too."""
    words, digest = body.lower().split(), xxhash.xxh64_intdigest
    grams = zip(*(words[k:] for k in range(min(shingle, len(words)))), strict=False) if words else [()]
    return np.unique(np.array([digest(b" ".join(g), SEED) for g in grams], np.uint64))


def prefix_of(values: np.ndarray, least: float, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """So many of a set's first values, rare ones first, that any set alike in ``least`` shares one with its own such."""
    counts = np.zeros(len(values), np.int64)
    if frequent is not None and len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], values), len(frequent[0]) - 1)
        counts = np.where(frequent[0][at] == values, frequent[1][at], 0)
    keep = len(values) - int(np.ceil(least * len(values) - 1e-9)) + 1
    return values[np.lexsort((values, counts))][:keep]


def signature(body: bytes, shingle: int = 5, least: float = 0.8, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a text's set of shingles, in the order of all texts, and the set."""
    values = shingle_set(body, shingle)
    return prefix_of(values, least, frequent), values


def _signatures(batches: Iterator[pa.RecordBatch], shingle: int, least: float, frequent: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [b.as_py() for b in batch.column(1)]
        pairs = [signature(t, shingle, least, frequent) for t in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), pa.array([p.view(np.int64) for p, _ in pairs], pa.list_(pa.int64())),
            pa.array([len(v) for _, v in pairs], pa.int32()), pa.array([hashlib.sha256(v.tobytes()).hexdigest() for _, v in pairs], pa.string()),
        ], names=["doc_id", "text_sha256", "prefix", "n", "set_sha256"])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [shingle_set(b.as_py(), shingle).view(np.int64) for b in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["row_id", "shingles"])


def frequent_shingles(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the shingles that are frequent among sampled texts (doc_id, body)."""
    share = max(1, texts.count() // ORDER_SAMPLE)
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select(F.lit(0).cast("long"), "body")
    grams = sample.mapInArrow(partial(_sets, shingle=shingle), "row_id long, shingles array<long>").select(F.explode("shingles").alias("h"))
    rows = grams.groupBy("h").agg(F.count("*").alias("c")).filter(F.col("c") >= ORDER_LEAST).orderBy(F.desc("c"), "h").limit(ORDER_MOST).collect()
    hashes, counts = np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["c"] for r in rows], np.int64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _may_be_alike(least: float) -> Column:
    """What sizes and places allow of a pair that shares a shingle, if it is the first that both have."""
    both = F.col("x.n") + F.col("y.n")
    return F.least("x.rest", "y.rest") >= both * (least / (1 + least)) - 1e-6


def verified(asked: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets (row_id, shingles) have a Jaccard similarity of ``least`` or more."""
    both = asked.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("common") >= least * (F.size("sa") + F.size("sb") - F.col("common")) - 1e-6).select("a", "b")


def decided(asked: DataFrame, rows: DataFrame, least: float, sets_of: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The candidates (a, b) that are alike; sets are read of rows that are in one, and of no others."""
    scratch = Scratch()
    ids = scratch.saved(asked.select(F.col("a").alias("row_id")).union(asked.select("b")).distinct(), "candidate-rows")
    sets = scratch.saved(sets_of(ids), "candidate-sets") if sets_of else rows.select("row_id", F.col("third").alias("shingles"))
    alike = saved(verified(asked, sets, least), "similar")
    scratch.remove()
    return alike


def similar_links(rows: DataFrame, least: float = 0.8, bucket: int = 16, sets_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Edges (a, b) that connect just what all pairs of ``rows`` alike in ``least`` of their shingles or more connect.

    Columns of ``rows``, by place: row_id, prefix, and the set of shingles, or its size where ``sets_of`` gives the sets
    (row_id, shingles) of some row_ids. Sets this alike share a value of their prefixes, always, so the rows that share
    one are the candidates; sizes and places rule out most, and the sets themselves decide.

    Values with more than ``bucket`` members go in two steps. First each member meets one chosen member, another one in
    each of its crowds. Then all pairs that this left unconnected are compared, in blocks of about ``BLOCK`` members
    against blocks, so that no task holds a crowd, and none is left out: pairs in one component need no comparison.
    """
    rows = rows.toDF("row_id", "prefix", "third")
    size = F.col("third") if sets_of else F.size("third")
    keys = rows.select("row_id", size.alias("n"), F.posexplode("prefix").alias("at", "h"))
    spread = keys.select("h", "row_id", "n", (F.col("n") - F.col("at")).alias("rest"))
    total, scratch = rows.count(), Scratch()
    shared = scratch.saved(spread.groupBy("h").agg(F.count("*").alias("members")).filter("members > 1"), "shared-values")
    bits = sieve(shared, "h", scratch)
    members = scratch.saved(sifted(spread, "h", bits).filter("may").drop("may").join(shared, "h"), "prefix-members")
    scratch.remove(shared, bits)
    cold = members.filter(F.col("members") <= bucket)
    pairs = cold.alias("x").join(cold.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.row_id") < F.col("y.row_id")) & _may_be_alike(least))
    crowd = members.filter(F.col("members") > bucket)
    mixed = F.xxhash64("h", "row_id")
    chosen = crowd.groupBy("h").agg(F.min_by(F.struct("row_id", "n", "rest"), mixed).alias("one")).select("h", "one.*")
    stars = crowd.alias("x").join(chosen.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.row_id") != F.col("y.row_id")) & _may_be_alike(least))
    ends = [F.least("x.row_id", "y.row_id").alias("a"), F.greatest("x.row_id", "y.row_id").alias("b")]
    asked = scratch.saved(pairs.select(*ends).union(stars.select(*ends)).distinct(), "candidates")
    found = decided(asked, rows, least, sets_of)
    if crowd.isEmpty():
        scratch.remove()
        return found
    roots = scratch.saved(dealt(components(found, total), total), "crowd-roots")
    crowd = crowd.join(roots, F.col("row_id") == F.col("node"), "left").select("h", "row_id", "n", "rest", F.coalesce("root", "row_id").alias("root"))
    several = crowd.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")).filter("lo < hi").select("h", "members")
    placed = crowd.join(several, "h").withColumn("last", F.floor((F.col("members") - 1) / BLOCK))
    placed = scratch.saved(placed.withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("last") + 1)), "crowd-blocks")
    scratch.remove(members, roots)
    left = placed.select("*", F.col("block").alias("p"), F.explode(F.sequence("block", "last")).alias("q"))
    right = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("p"), F.col("block").alias("q"))
    apart = (F.col("x.root") != F.col("y.root")) & ((F.col("x.p") < F.col("x.q")) | (F.col("x.row_id") < F.col("y.row_id")))
    met = left.alias("x").join(right.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.p") == F.col("y.p")) & (F.col("x.q") == F.col("y.q")) & apart & _may_be_alike(least))
    rest = saved(met.select(*ends).distinct().join(asked, ["a", "b"], "left_anti"), "crowd-candidates")
    scratch.remove()
    return found.union(decided(rest, rows, least, sets_of))


def similar_keepers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, text_sha256, kept: of the texts that links of similarity ``least`` connect, that with the least id stays.

    Similarity is of the sets of ``shingle``-word shingles, by their 64-bit hashes. Texts with equal sets are linked by the
    hash of the set, and one of them meets the others. Texts without words are alike. Cases are else as above.
    """
    texts = bodies(docs, id_col, text_col)
    run = partial(_signatures, shingle=shingle, least=least, frequent=frequent_shingles(texts, shingle))
    rows = texts.mapInArrow(run, "doc_id long, text_sha256 string, prefix array<long>, n int, set_sha256 string")
    rows = saved(rows.withColumn("row_id", F.monotonically_increasing_id()), "signatures")
    total = rows.count()
    same = rows.groupBy("set_sha256").agg(F.min("row_id").alias("a"), F.count("*").alias("rows")).filter("rows > 1")
    copies = saved(dealt(rows.join(same, "set_sha256").filter("row_id <> a").select("a", F.col("row_id").alias("b")), total), "equal-sets")
    single = rows.join(copies, F.col("row_id") == F.col("b"), "left_anti").select("row_id", "prefix", "n")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = saved(rows.join(ids, "row_id").select("row_id", F.col("doc_id").alias("w_id"), "text_sha256"), "wanted-texts")
        may = sifted(texts, "doc_id", sieve(wanted, "w_id")).filter("may").withColumn("text_sha256", F.sha2("body", 256))
        found = may.join(wanted, "text_sha256").filter(F.col("doc_id").eqNullSafe(F.col("w_id")))
        return found.select("row_id", "body").mapInArrow(partial(_sets, shingle=shingle), "row_id long, shingles array<long>").dropDuplicates(["row_id"])

    links = similar_links(single, least, sets_of=sets_of).union(copies)
    roots = saved(dealt(components(links, total), total), "similar-roots")
    placed = saved(dealt(rows.select("row_id", "doc_id").join(roots, F.col("row_id") == F.col("node")), total), "similar-rows")
    stays = placed.groupBy("root").agg(F.min(F.struct("doc_id", "row_id")).alias("s")).select(F.col("s.row_id").alias("stays"))
    gone = saved(dealt(placed.join(stays, F.col("row_id") == F.col("stays"), "left_anti").select("row_id", F.lit(False).alias("kept")), total), "similar-dropped")
    return rows.select("row_id", "doc_id", "text_sha256").join(gone, "row_id", "left").select("doc_id", "text_sha256", F.coalesce("kept", F.lit(True)).alias("kept"))
