"""Ranked lexical search: the best documents of each item, found by groups of documents that match the same terms.

One pass over the documents counts, of each, its terms and those that some item asks for. Sums of these rows give the corpus
counts, and with them every term's weight. A second pass reads the short rows: in a task, a term has a bitmap of the
documents that hold it, and an item's bitmaps, read across, give every document the mask of the terms it matches. Documents
of one mask are a group. No document of a group can score more than the sum, over the mask's terms, of the most that a
document of the batch gets for the term. Groups are evaluated by this bound, highest first, until it falls below the score
of the last document that an item keeps; equality is still evaluated, since smaller ids win ties. A task carries what it has kept
from batch to batch, so later batches mostly stop at once, and gives ``best`` rows per item in the end. Those of all tasks
are ranked in two steps, so no task holds all of an item's.

Items are handled in blocks of ``ITEMS``, and one block's terms and weights travel to the tasks; each block reads the
documents once more. So memory is bounded whatever the number of items or documents.

Defined cases: a null text has no terms, nor has an item without any; such items get no rows. Items that repeat an id are
items of their own, each with its ranks. Rows that repeat a document are documents of their own. Among equal scores null ids
come last. Documents without terms do not count in N. An empty table of either kind gives no rows. Other columns of the
tables are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adledger.llm.rows import bodies, slices
from adledger.session import saved

#: A term in UTF-8 text whose A-Z are lower-cased: digits, letters, and all beyond ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Items of a block, and distinct terms times documents of a batch.
ITEMS, CELLS = 2048, 1 << 22
NO_ID = (1 << 63) - 1


def terms(body: bytes) -> list[bytes]:
    return TERM.findall(body.lower())


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """doc_id, n, and the asked terms with their occurrences, of documents that have terms."""
    for batch in slices(batches, 1024):
        rows: list[tuple] = []
        for i, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = Counter(terms(body.as_py()))
            if not found:
                continue
            held = [(vocabulary[t], tf) for t, tf in found.items() if t in vocabulary]
            rows.append((i, found.total(), [t for t, _ in held], [tf for _, tf in held]))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n", "terms", "tfs"])


class Postings:
    """One batch of documents: what each gets for each asked term, and which documents hold a term."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, offsets: np.ndarray, held: np.ndarray, tf: np.ndarray, weights: np.ndarray, docs: int, words: int):
        self.ids = ids
        doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
        m = 10 + (90 * n * docs) // max(words, 1)
        gain = weights[held] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        self.gain = np.zeros((len(weights), len(ids)), np.int64)
        self.gain[held, doc] = gain
        self.held = np.zeros((len(weights), len(ids)), bool)
        self.held[held, doc] = True
        self.most = self.gain.max(axis=1, initial=0)

    def rank(self, asked: np.ndarray, best: list[tuple[int, int]], most: int) -> int:
        """Puts documents that belong to an item's best into the heap ``best`` of (score, -doc_id); how many were scored."""
        bitmaps = self.held[asked]
        masks = np.packbits(bitmaps, axis=0)
        any_term = np.flatnonzero(masks.any(axis=0))
        if not len(any_term):
            return 0
        keys = np.ascontiguousarray(masks[:, any_term].T).view(np.dtype((np.void, masks.shape[0]))).ravel()
        distinct, first, group = np.unique(keys, return_index=True, return_inverse=True)
        bound = bitmaps[:, any_term[first]].T.astype(np.int64) @ self.most[asked]
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(distinct)))
        begins = ends - np.bincount(group, minlength=len(distinct))
        scored = 0
        for g in np.argsort(-bound, kind="stable").tolist():
            if bound[g] <= 0 or len(best) == most and bound[g] < best[0][0]:
                break
            who = any_term[members[begins[g]:ends[g]]]
            present = asked[bitmaps[:, who[0]]]
            score = self.gain[np.ix_(present, who)].sum(axis=0)
            scored += len(who)
            for s, i in zip(score.tolist(), self.ids[who].tolist(), strict=True):
                if s > 0 and (len(best) < most or (s, -i) > best[0]):
                    heapq.heappush(best, (s, -i))
                    if len(best) > most:
                        heapq.heappop(best)
        return scored


def _ranked(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weights: np.ndarray, docs: int, words: int, most: int) -> Iterator[pa.RecordBatch]:
    best: list[list[tuple[int, int]]] = [[] for _ in items]
    for batch in slices(batches, max(64, min(4096, CELLS // max(1, len(weights))))):
        ids = np.array([NO_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
        held, tf = batch.column(2), batch.column(3)
        offsets = held.offsets.to_numpy()
        rows = Postings(ids, batch.column(1).to_numpy(), offsets - offsets[0], held.flatten().to_numpy(), tf.flatten().to_numpy(), weights, docs, words)
        for asked, own in zip(items, best, strict=True):
            if len(asked):
                rows.rank(asked, own, most)
    out = [(k, -i, s) for k, own in enumerate(best) for s, i in own]
    columns = list(zip(*out, strict=True)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])


def _best_of_block(texts: DataFrame, items: list[tuple], most: int) -> DataFrame:
    """item_id, rank, doc_id and score for one block of items (id, text)."""
    spark = texts.sparkSession
    asked = [sorted(set(terms((t or "").encode()))) for _, t in items]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*asked)))}
    counted = saved(texts.mapInArrow(partial(_counted, vocabulary=vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "asked-terms")
    docs, words = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = {r["t"]: r["df"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
    weights = np.array([int(np.floor(1000 * np.log((2 * docs + 2) / (2 * held.get(k, 0) + 1)))) for k in range(len(vocabulary))], np.int64)
    numbers = [np.array([vocabulary[t] for t in ts], np.int64) for ts in asked]
    found = counted.mapInArrow(partial(_ranked, items=numbers, weights=weights, docs=docs, words=words, most=most), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    found = found.withColumn("part", F.spark_partition_id() % 64)
    some = found.withColumn("rank", F.row_number().over(W.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= most)
    last = some.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= most)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "item int, item_id long")
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return last.join(F.broadcast(names), "item").select("item_id", "rank", doc.alias("doc_id"), "score")


def best_documents(docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text", most: int = 10) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``most`` documents with the highest scores of each item."""
    texts = bodies(docs, id_col, text_col)
    asked = items.select(items[item_col].cast("long").alias("item_id"), items[item_text].cast("string").alias("asked"))
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = -(-asked.count() // ITEMS)
    if blocks > 1:
        asked = saved(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "asked", F.monotonically_increasing_id()), F.lit(blocks))), "items")
    parts = [_best_of_block(texts, [(r["item_id"], r["asked"]) for r in (asked.filter(F.col("block") == b) if blocks > 1 else asked).select("item_id", "asked").collect()], most) for b in range(blocks)]
    for part in parts:
        out = out.unionByName(part) if blocks > 1 else part
    return out
