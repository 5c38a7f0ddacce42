"""Exact dedup by content-defined chunk recipes.

Texts are cut where a rolling hash of their bytes says so. Chunks are deduplicated to verified identifiers, a text
becomes the ordered list of its chunks' identifiers, and texts are equal when those lists are. After the one pass that
cuts and hashes, only lists move between tasks and never the texts.

Defined cases: a null text is empty, and empty texts are equal to each other. A null id is smaller than any other.
Rows that repeat id and text are copies like any others, and exactly one of them stays. An empty table gives no rows.
Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adledger.llm.rows import bodies, slices
from adledger.session import saved

WINDOW = 32
BLOCK = 1 << 20


def gear_table() -> np.ndarray:
    """A fixed random number for each byte value, from the splitmix64 rule."""
    z = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def cut_candidates(data: np.ndarray, bits: int) -> list[int]:
    """Places after which a chunk may end: the hash of the last 32 bytes has ``bits`` leading zeros.

    The hash of a window is doubled from that of its halves, so it takes five passes over the bytes.
    """
    found: list[int] = []
    for lo in range(0, len(data), BLOCK):
        start = max(0, lo - WINDOW + 1)
        h = GEAR[data[start:lo + BLOCK]]
        w = 1
        while w < WINDOW:
            h[w:] += h[:-w] << np.uint32(w)
            w *= 2
        hits = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + start
        found.extend((hits[hits >= lo] + 1).tolist())
    return found


def chunk_ends(start: int, end: int, candidates: list[int], least: int, most: int) -> list[int]:
    """Ends of the chunks of one text: the first candidate at least ``least`` bytes on, at most ``most``."""
    ends = []
    while end - start > least:
        k = bisect_left(candidates, start + least)
        cut = min(candidates[k] if k < len(candidates) else end, start + most, end)
        ends.append(cut)
        start = cut
    if start < end or not ends:
        ends.append(end)
    return ends


def cut_batch(batches: Iterator[pa.RecordBatch], mean_bits: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    least, most = 1 << (mean_bits - 2), 1 << (mean_bits + 2)
    for batch in slices(batches, 1024):
        ids, rows = batch.column(0), []
        for body in batch.column(1):
            data = memoryview(body.as_buffer())
            n = len(data)
            candidates = cut_candidates(np.frombuffer(data, np.uint8), mean_bits) if n > least else []
            start, chunks = 0, []
            for end in chunk_ends(0, n, candidates, least, most):
                piece = data[start:end]
                chunks.append({"key": xxhash.xxh3_64_intdigest(piece) - (1 << 63), "n_bytes": end - start, "sha": hashlib.sha256(piece).digest()})
                start = end
            rows.append((n, chunks[0]["sha"].hex() if len(chunks) == 1 else hashlib.sha256(data).hexdigest(), chunks))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(3))], schema=schema)


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean_bits: int = 12) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``text_sha256`` and ``chunks`` (key, n_bytes, sha) of about 2**mean_bits bytes."""
    chunk = pa.struct([("key", pa.int64()), ("n_bytes", pa.int32()), ("sha", pa.binary())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("chunks", pa.list_(chunk))])
    return bodies(docs, id_col, text_col).mapInArrow(
        partial(cut_batch, mean_bits=mean_bits, schema=schema),
        "doc_id long, n_bytes long, text_sha256 string, chunks array<struct<key:long,n_bytes:int,sha:binary>>",
    )


def recipes(rows: DataFrame) -> DataFrame:
    """``rows`` (row_id, chunks, ...) with ``recipe``, the ordered list of verified chunk identifiers.

    An identifier is a chunk's 64-bit key and a variant number. Verifying means that chunks of one key are compared by
    length and SHA-256: those that differ get numbers of their own. Keys with more than one variant are next to none,
    so the rows that hold such a key are the only ones that take part in a join.
    """
    chunks = rows.select("row_id", F.posexplode("chunks").alias("at", "c")).select("row_id", "at", "c.*")
    contents = chunks.select("key", "n_bytes", "sha").distinct()
    of_key = W.partitionBy("key")
    variants = contents.withColumn("n", F.count("*").over(of_key)).withColumn("variant", F.row_number().over(of_key.orderBy("n_bytes", "sha")) - 1)
    doubtful = saved(variants.filter("n > 1").drop("n"), "chunk-variants")
    told = chunks.join(doubtful, ["key", "n_bytes", "sha"]).groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "variant"))).alias("told"))
    told = saved(told, "recipe-variants")
    variant = lambda i: F.coalesce(F.col("told")[i], F.lit(0))
    return rows.join(told, "row_id", "left").withColumn("recipe", F.transform("chunks", lambda c, i: F.struct(c["key"].alias("key"), variant(i).alias("variant")))).drop("told", "chunks")


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean_bits: int = 12) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_bytes, text_sha256, recipe, keep_id, group_size, kept.

    Of rows with equal texts the one with the largest id stays; of several with that id, one.
    """
    cut = saved(chunked(docs, id_col, text_col, mean_bits).withColumn("row_id", F.monotonically_increasing_id()), "chunks")
    rows = recipes(cut)
    groups = rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count("*").alias("group_size"))
    groups = saved(groups.filter("group_size > 1"), "copies")
    kept = F.col("keep").isNull() | (F.col("keep.row_id") == F.col("row_id"))
    return rows.join(groups, "recipe", "left").select(
        "doc_id", "n_bytes", "text_sha256", "recipe",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"),
    )
