"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents, in a hashed order that the seed decides, are laid end to end, once for each pass over the source.
The first words of that line, as many as the target, are the source's part of the mix, so every document comes whole as
often as there are passes and only the one document that crosses the end of the target is cut there. The line falls into
blocks of about equal numbers of words; a document belongs to the block of its first word, and whole.

A tree splits the blocks of all sources among the output shards: at each node the blocks of one half are a multivariate
hypergeometric draw from the node's, seeded by the node, so any shard finds its own quotas alone on its way down from the
root, together with how many blocks of each source stand before its own. Block numbers are permuted by a keyed bijection;
a shard owns a run of permuted places, so shards are disjoint. Within a shard, documents are shuffled by a hash.

Nothing that grows with the documents passes the driver: it sees the list of sources (one row each) and no more.

Defined cases: a null text has size 0 and takes 0 words; a source of null sorts last and is a source like any other.
Repeated rows are documents of their own. An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adledger.llm.rows import whole_text
from adledger.session import saved

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A target stops at so many times its source's size.
MOST_TIMES = 3.0
SPACE = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """Number of words, split at ASCII white space."""
    body = F.btrim(text, F.lit(SPACE))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST_TIMES) -> list[float]:
    """Words wanted of each source: by weight, none above ``most`` times its size, the excess shared anew by weight."""
    wanted: dict[int, float] = {}
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[k % len(weights)] for k in open_)
        share_of = {k: left * weights[k % len(weights)] / total for k in open_}
        above = [k for k in open_ if share_of[k] > most * sizes[k]]
        if not above:
            wanted |= share_of
            break
        wanted |= {k: most * sizes[k] for k in above}
        left -= sum(most * sizes[k] for k in above)
        open_ = [k for k in open_ if k not in above]
    return [wanted.get(k, 0.0) for k in range(len(sizes))]


def block_words(size: int, blocks: int, most: int) -> int:
    """Words of a block: about ``blocks`` blocks in a source, and no more than 2**20 of ``most`` words or longer."""
    return max(1, min(most, -(-size // blocks)), -(-size >> 20))


def recipe(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float, blocks: int, most_words: int, most_sources: int) -> list[dict]:
    """A row per source, from one row per source: size, target, its whole number of words, words of a block, and blocks."""
    rows = sizes.limit(most_sources + 1).collect()
    if len(rows) > most_sources:
        raise ValueError(f"a mix may have up to {most_sources} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["source_size"] for r in rows], weights, share, most)
    found = []
    for k, (r, t) in enumerate(zip(rows, wanted, strict=True)):
        words = block_words(r["source_size"], blocks, most_words)
        found.append({"source_no": k, "source": r["source"], "source_size": r["source_size"], "target": t, "words": round(t), "block_words": words, "blocks": -(-round(t) // words)})
    return found


def _node(seed: int, depth: int, index: int) -> np.random.Generator:
    return np.random.default_rng([seed, depth, index])


def draw(rng: np.random.Generator, colors: np.ndarray, n: int) -> np.ndarray:
    """How many of each colour are among ``n`` drawn without replacement: one hypergeometric marginal after another."""
    taken, rest = np.zeros(len(colors), np.int64), int(colors.sum())
    for k, have in enumerate(colors.tolist()):
        rest -= have
        taken[k] = rng.hypergeometric(have, rest, n) if n and have and rest else min(n, have)
        n -= int(taken[k])
    return taken


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source in a shard, and how many stand before them in lower shards.

    Shards lo..hi halve until one is left; the left half gets its share of the node's blocks to within one block.
    """
    have, before = quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    lo, hi, depth = 0, shards, 0
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = draw(_node(seed, depth, lo), have, int(have.sum()) * (mid - lo) // (hi - lo))
        if shard < mid:
            have, hi = left, mid
        else:
            have, before, lo = have - left, before + left, mid
        depth += 1
    return have, before


def permuted(places: np.ndarray, n: int, key: str) -> np.ndarray:
    """A keyed bijection of 0..n-1: a four-round Feistel network over the next even power of two, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.sha256(key.encode()).digest(), "<u8")
    out, open_ = places.astype(np.uint64), np.ones(len(places), bool)
    while open_.any():
        x = out[open_]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mix = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mix ^ (mix >> np.uint64(32))) & mask)
        out[open_] = (left << np.uint64(half)) | right
        open_ = out >= n
    return out.astype(np.int64)


def _shard_rows(batches: Iterator[pa.RecordBatch], sources: list[dict], shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    quotas = np.array([s["blocks"] for s in sources], np.int64)
    for batch in batches:
        for shard in batch.column(0).to_pylist():
            have, before = shard_quotas(quotas, shards, shard, seed)
            for s, n, at in zip(sources, have.tolist(), before.tolist(), strict=True):
                for lo in range(at, at + n, 1 << 16):
                    draws = np.arange(lo, min(lo + (1 << 16), at + n), dtype=np.int64)
                    blocks = permuted(draws, s["blocks"], f"{seed}/{s['source_no']}")
                    yield pa.RecordBatch.from_pydict({"shard": np.full(len(draws), shard), "source_no": np.full(len(draws), s["source_no"], np.int32), "block": blocks})


def drawn_blocks(spark, sources: list[dict], shards: int, seed: int) -> DataFrame:
    """shard, source_no, block: every block of the mix, worked out per shard from the seed alone."""
    return spark.range(shards).repartition(min(shards, 200)).mapInArrow(partial(_shard_rows, sources=sources, shards=shards, seed=seed), "shard long, source_no int, block long")


def laid_out(rows: DataFrame, sources: list[dict], seed: int, bin_rows: int = 5_000) -> DataFrame:
    """``rows`` (row_id, source, size) with source_no and ``at``, the words before each in its source's hashed order.

    Rows are dealt to bins by hash, so many that a bin has about ``bin_rows`` rows of even the largest source. Sums of
    bins, one row each, give where a bin begins, and a running sum inside the bin does the rest.
    """
    spark = rows.sparkSession
    bins = max(1, -(-rows.count() // bin_rows))
    names = spark.createDataFrame([(s["source_no"], s["source"]) for s in sources], "source_no int, name string")
    rows = rows.join(F.broadcast(names), rows["source"].eqNullSafe(names["name"])).drop("name")
    rows = rows.withColumn("h", F.xxhash64("doc_id", "size", F.lit(seed))).withColumn("bin", F.pmod("h", F.lit(bins)))
    sums = rows.groupBy("source_no", "bin").agg(F.sum("size").alias("words"))
    order = W.partitionBy("source_no").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("source_no", "bin", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("bin_at"))
    inside = W.partitionBy("source_no", "bin").orderBy("h", "row_id").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("in_bin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums, ["source_no", "bin"]).select("row_id", "doc_id", "source", "size", "source_no", (F.col("bin_at") + F.col("in_bin")).alias("at"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.0, most: float = MOST_TIMES, blocks: int = 256, most_words: int = 1 << 14, words_per_shard: int = 1 << 20, seed: int = 42,
    most_sources: int = 100_000, row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row per document (row_id, doc_id, source, size, source_size, target, taken), and the pieces of the mix.

    A piece (shard, place, row_id, doc_id, size, first_word, n_words, copy) is a document in one pass: all of its words, or
    its first words where it crosses the end of its source's target, which one document of a source does at most. So a
    source's taken words are its target to the word. ``place`` orders a shard after its local shuffle. A source has about
    ``blocks`` blocks a pass, more where they would be longer than ``most_words`` words. ``row_col`` names a column that
    tells rows apart, where the caller needs the pieces by a number of its own.
    """
    spark = docs.sparkSession
    row = docs[row_col] if row_col else F.monotonically_increasing_id()
    rows = saved(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), words_of(whole_text(docs, text_col)).alias("size"), row.alias("row_id")), "sizes")
    sources = recipe(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most, blocks, most_words, most_sources)
    if not sources:
        nothing = rows.select("*", F.col("size").alias("source_size"), F.col("size").cast("double").alias("target"), F.col("size").alias("taken"))
        return nothing, rows.select(F.col("row_id").alias("shard"), F.col("row_id").alias("place"), "row_id", "doc_id", "size", F.col("size").alias("first_word"), F.col("size").alias("n_words"), F.lit(0).alias("copy"))
    shards = max(1, -(-round(sum(s["target"] for s in sources)) // words_per_shard))
    table = spark.createDataFrame([(s["source_no"], s["source_size"], s["target"], s["words"], s["block_words"]) for s in sources], "source_no int, source_size long, target double, words long, block_words long")
    placed = saved(laid_out(rows, sources, seed).join(F.broadcast(table), "source_no"), "laid-out")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - F.col("at") - 1) / F.col("source_size")))
    copies = placed.filter("size > 0 AND at < words").select("*", F.explode(passes).alias("copy")).withColumn("from", F.col("copy") * F.col("source_size") + F.col("at"))
    copies = copies.select("source_no", F.floor(F.col("from") / F.col("block_words")).alias("block"), "row_id", "doc_id", "size", F.lit(0).cast("long").alias("first_word"), F.least("size", F.col("words") - F.col("from")).alias("n_words"), F.col("copy").cast("int").alias("copy"))
    drawn = saved(drawn_blocks(spark, sources, shards, seed), "drawn-blocks")
    pieces = copies.join(drawn, ["source_no", "block"]).select("shard", F.xxhash64("doc_id", "first_word", "copy", F.lit(seed)).alias("place"), "row_id", "doc_id", "size", "first_word", "n_words", "copy")
    pieces = saved(pieces, "pieces")
    taken = pieces.groupBy("row_id").agg(F.sum("n_words").alias("taken"))
    whole = placed.join(taken, "row_id", "left").select("row_id", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return whole, pieces


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix as documents, in the order of its shards: a row per document and pass, with the columns of ``docs``.

    A document keeps its whole text. The one that crosses the end of its source's target has its first words, by single
    spaces.
    """
    numbered = saved(docs.withColumn("_m_row", F.monotonically_increasing_id()), "mix-input")
    whole, pieces = mix(numbered, id_col, text_col, source_col, row_col="_m_row", **options)
    per_row = pieces.groupBy("row_id").agg(F.collect_list(F.struct("shard", "place", "size", "n_words")).alias("_m_passes"))
    text = whole_text(numbered, text_col)
    joined = numbered.join(per_row.withColumnRenamed("row_id", "_m_row"), "_m_row").withColumn("_m_text", text)
    each = joined.select("*", F.explode("_m_passes").alias("_m_pass"))
    words = F.split(F.btrim("_m_text", F.lit(SPACE)), r"[\x20\x09-\x0D]+")
    part = F.array_join(F.slice(words, 1, F.col("_m_pass.n_words").cast("int")), " ")
    each = each.withColumn("_m_text", F.when(F.col("_m_pass.n_words") == F.col("_m_pass.size"), F.col("_m_text")).otherwise(part))
    new = {text_col: F.col("_m_text")} | ({length_col: F.length("_m_text").cast(docs.schema[length_col].dataType)} if length_col else {})
    ordered = each.select(F.col("_m_pass.shard").alias("_m_shard"), F.col("_m_pass.place").alias("_m_place"), *(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
    return ordered.repartition("_m_shard").sortWithinPartitions("_m_shard", "_m_place").select(*(F.col(f"`{c}`") for c in docs.columns))
