"""Repeated passages by sharded Aho-Corasick automata over words.

A word goes if a window of ``window`` consecutive words that covers it also starts earlier: in a document with a smaller
id, or earlier in the same one. Windows are judged on the input and never cross documents.

No automaton can hold the passages of a large corpus, so documents are streamed through shards, and each part of a document
only through the one shard that can know it. A window is labelled by the smallest hash of a ``PIECE``-word piece in it; equal
windows have equal labels, and neighbours mostly share theirs, so a run of them travels as one segment of words. A label that
occurs once holds no repeat and goes no further. A shard is a block of labels: it confirms which windows of its segments occur
at two places, compiles these phrases into one automaton over word numbers, and streams all its segments through it. The
automaton compares words, so hashes decide where phrases are looked for but never what is equal. Of a phrase's places the
earliest stays.

Copies of whole texts are repeats of the first in all their words and take no part. Equal segments meet their like before the
automaton. Labels with more than ``hot`` occurrences have their windows travel one by one under their own hashes; a task that
has met a window at an earlier place sends on the place alone, so a passage that a third of all documents share reaches its
shard about once for each task.

Defined cases: a null text has no words; texts of fewer words than a window keep all. A null id comes before all others.
Rows that repeat id and text are one document: they are treated alike. Rows that repeat an id with other texts are in the
order of a hash of the text. An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.llm.rows import bodies, slices
from adledger.session import saved

#: Words of the pieces that label windows, a power of two.
PIECE = 8
#: Windows labelled at once; positions fit into the bits that a hash gives up for them.
STARTS, PLACE_BITS = 1 << 16, 17
#: Most windows of a segment.
LONGEST_RUN = 256
#: Words of a shard's automaton, if its last label does not make it longer.
SHARD = 1 << 17
#: Words whose hashes a task keeps.
KNOWN_WORDS = 1 << 18
FIRST_ID = -(1 << 63)


class Hashes(dict):
    """Hash of each word met, taken once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) | 1
        return value


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values."""
    factor, total = np.uint64(0x9E3779B97F4A7C15), np.zeros(max(0, len(values) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = total * factor + values[k:k + len(total)]
        return (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def labels(values: np.ndarray, window: int) -> np.ndarray:
    """For each window, the smallest hash of a piece in it, the low bits being where the piece stands."""
    h = rolling(values, min(PIECE, window))
    h = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    pieces, w = window - min(PIECE, window) + 1, 1
    while 2 * w <= pieces:
        h, w = np.minimum(h[:-w], h[w:]), 2 * w
    return np.minimum(h[:len(h) - (pieces - w)], h[pieces - w:])


def label_runs(values: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one document's word hashes: the label of each run of windows, and the run: start, number of windows, moves.

    Start and number stand above the lowest bit, which says whether the labelling piece moves within the run; where it
    stays in place, no two windows of the run are equal.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, max(0, len(values) - window + 1), STARTS):
        smallest = labels(values[lo:lo + STARTS + window - 1], window)
        label = smallest >> np.uint64(PLACE_BITS)
        new, moved = np.ones(len(label), bool), np.zeros(len(label), np.int64)
        new[1:], moved[1:] = label[1:] != label[:-1], smallest[1:] != smallest[:-1]
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(label)))
        pieces = -(-length // LONGEST_RUN)
        own = np.repeat(np.arange(len(begin)), pieces)
        k = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, length = begin[own] + k * LONGEST_RUN, np.minimum(length[own] - k * LONGEST_RUN, LONGEST_RUN)
        moves = np.cumsum(moved)
        found.append((label[begin].astype(np.int64), ((begin + lo) << 10) | (length << 1) | (moves[begin + length - 1] > moves[begin])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _label(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for batch in slices(batches):
        runs = [label_runs(np.array([hashes[w] for w in b.as_py().split()], np.uint64), window) for b in batch.column("body")]
        yield pa.RecordBatch.from_arrays([
            batch.column("k"), batch.column("tie"), batch.column("sha"),
            pa.array([x for x, _ in runs], pa.list_(pa.int64())), pa.array([x for _, x in runs], pa.list_(pa.int64())),
        ], names=["k", "tie", "sha", "labels", "runs"])


def later_places(segments: list[bytes], where: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(k, tie, start, words) covered by windows that are also at an earlier place, of segments at ``where`` (k, tie, start)."""
    number: dict[bytes, int] = {}
    split = [tuple(number.setdefault(w, len(number) + 1) for w in s.split()) for s in segments]
    sizes = np.array([len(s) for s in split])
    begin = np.cumsum(sizes) - sizes
    ids = np.concatenate([np.array(s, np.uint64) for s in split])
    own = np.repeat(np.arange(len(split)), sizes)
    h = rolling(ids, window)
    starts = np.flatnonzero(own[:len(h)] == own[window - 1:])
    _, inverse, count = np.unique(h[starts], return_inverse=True, return_counts=True)
    confirmed = starts[count[inverse] > 1]
    if not len(confirmed):
        return []
    phrases = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for at in confirmed.tolist():
        s = int(own[at])
        o = at - int(begin[s])
        phrases.add_word(split[s][o:o + window], at)
    phrases.make_automaton()
    having = np.unique(own[confirmed]).tolist()
    met = [(s, end - window + 1, p) for s in having for end, p in phrases.iter(split[s])]
    seg, off, phrase = (np.array(x, np.int64) for x in zip(*met, strict=True))
    docs = sorted({w[:2] for w in where})
    doc = {d: i for i, d in enumerate(docs)}
    place = (np.array([doc[w[:2]] << 33 | w[2] for w in where])[seg]) + off
    _, phrase = np.unique(phrase, return_inverse=True)
    first = np.full(phrase.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, phrase, place)
    later = np.flatnonzero(place > first[phrase])
    at = begin[seg[later]] + off[later]
    new = np.append(True, at[1:] != at[:-1] + 1) if len(at) else np.zeros(0, bool)
    new[1:] |= seg[later][1:] != seg[later][:-1]
    lead = later[new]
    many = np.diff(np.append(np.flatnonzero(new), len(at)))
    return [(*where[s][:2], where[s][2] + o, n + window - 1) for s, o, n in zip(seg[lead].tolist(), off[lead].tolist(), many.tolist(), strict=True)]


SEGMENTS = pa.schema([("label", pa.int64()), ("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("words", pa.int64()), ("moves", pa.bool_()), ("segment", pa.binary())])
SEGMENTS_SQL = "label long, k long, tie long, start long, words long, moves boolean, segment binary"
SPANS = pa.schema([("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("words", pa.int64())])
SPANS_SQL = "k long, tie long, start long, words long"


def _flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _segments(batches: Iterator[pa.RecordBatch], window: int, remembered: int) -> Iterator[pa.RecordBatch]:
    """Segments of the runs of each document. One seen in this task at an earlier place goes without its words."""
    seen: dict[bytes, tuple[int, int, int]] = {}
    out: list[tuple] = []

    def add(label: int, at: tuple[int, int, int], moves: bool, words: list[bytes]) -> None:
        segment = b" ".join(words)
        known = seen.get(segment)
        if known is not None and known < at:
            out.append((hash(at), *at, len(words), False, None))
            return
        if len(seen) >= remembered:
            seen.clear()
        seen[segment] = at
        out.append((label, *at, len(words), moves, segment))

    for batch in slices(batches, 64):
        for r in batch.to_pylist():
            words, k, tie = r["body"].split(), r["k"], r["tie"]
            for x in r["runs"]:
                at, n = x["run"] >> 10, x["run"] >> 1 & 511
                if x["hot"]:
                    for s in range(at, at + n):
                        own = words[s:s + window]
                        add(xxhash.xxh3_64_intdigest(b" ".join(own)) - (1 << 63), (k, tie, s), False, own)
                else:
                    add(x["label"], (k, tie, at), bool(x["run"] & 1), words[at:at + n + window - 1])
            if len(out) >= 20_000:
                yield _flush(out, SEGMENTS)
    yield _flush(out, SEGMENTS)


def _locate(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated words from segments in the order of their labels, shard by shard."""
    spans: list[tuple[int, int, int, int]] = []
    shard: list[bytes] = []
    where: list[tuple[int, int, int]] = []
    size, current, group, moving = 0, None, {}, False

    def close() -> None:
        """A label is complete: of equal segments the first stays, and segments that may share windows join the shard."""
        nonlocal size
        if len(group) > 1 or moving:
            shard.extend(group)
            where.extend(group.values())
            size += sum(s.count(b" ") + 1 for s in group)

    for batch in slices(batches, 4096):
        for label, k, tie, start, words, moves, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment is None:
                spans.append((k, tie, start, words))
                continue
            if label != current:
                close()
                current, group, moving = label, {}, False
                if size >= SHARD:
                    spans += later_places(shard, where, window)
                    shard, where, size = [], [], 0
            at, known = (k, tie, start), group.get(segment)
            moving |= moves
            if known is None:
                group[segment] = at
            elif at != known:
                group[segment] = min(at, known)
                spans.append((*max(at, known), words))
        if len(spans) >= 20_000:
            yield _flush(spans, SPANS)
    close()
    if shard:
        spans += later_places(shard, where, window)
    yield _flush(spans, SPANS)


def runs_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered words."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches):
        ids, rows = batch.column("doc_id"), []
        for r in batch.to_pylist():
            words = r["body"].split()
            if r["copy"]:
                gone = [(0, len(words))] if len(words) >= window else []
            else:
                gone = runs_of([(s["start"], s["start"] + s["words"]) for s in r["spans"] or []])
            at, kept = 0, []
            for start, end in gone:
                kept += words[at:start]
                at = end
            rows.append((len(words), [{"start": s, "end": e} for s, e in gone], b" ".join(kept + words[at:])))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pair, pa.binary())))], names=["doc_id", "n_words", "removed", "kept"])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, hot: int = 4096, remembered: int = 50_000) -> DataFrame:
    """``doc_id``, ``n_words``, ``removed`` (maximal runs of words: start, end) and ``kept`` (the other words, in UTF-8,
    joined by one space) of every row.

    ``hot`` is the number of occurrences beyond which a label's windows travel one by one; ``remembered`` how many segments
    a task keeps to recognise equal ones early. Neither changes the result. The two steps that need the texts again join
    them by the same key and columns in one job, so Spark deals the texts out once and uses that exchange twice.
    """
    texts = bodies(docs, id_col, text_col).withColumn("sha", F.sha2("body", 256))
    texts = texts.select(F.coalesce("doc_id", F.lit(FIRST_ID)).alias("k"), F.xxhash64("sha").alias("tie"), "doc_id", "sha", "body")
    marked = texts.select("k", "tie", "sha", "body").mapInArrow(partial(_label, window=window), "k long, tie long, sha string, labels array<long>, runs array<long>")
    marked = saved(marked, "word-runs")
    many = marked.groupBy("sha").agg(F.min("k").alias("first"), F.max("k").alias("most")).filter("first < most").select("sha", "first")
    copies = saved(marked.select("k", "tie", "sha").join(saved(many, "equal-word-texts"), "sha").filter("k > first").select("k", "tie").distinct(), "copied-texts")
    runs = marked.select("k", "tie", "labels", "runs").join(copies, ["k", "tie"], "left_anti")
    runs = runs.select("k", "tie", F.explode(F.arrays_zip("labels", "runs")).alias("r")).select("k", "tie", F.col("r.labels").alias("label"), F.col("r.runs").alias("run"))
    seen = runs.groupBy("label").agg(F.count("*").alias("n"), F.max(F.col("run") % 2).alias("moves")).filter("n > 1 OR moves = 1")
    seen = saved(seen.select("label", (F.col("n") > hot).alias("hot")), "recurring-labels")
    lists = runs.join(seen, "label").groupBy("k", "tie").agg(F.collect_set(F.struct("label", "run", "hot")).alias("runs"))
    texts = texts.drop("sha")
    segments = texts.join(saved(lists, "recurring-runs"), ["k", "tie"]).mapInArrow(partial(_segments, window=window, remembered=remembered), SEGMENTS_SQL)
    spans = segments.repartition("label").sortWithinPartitions("label").mapInArrow(partial(_locate, window=window), SPANS_SQL)
    spans = spans.groupBy("k", "tie").agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    judged = texts.join(spans, ["k", "tie"], "left").join(copies.withColumn("copy", F.lit(True)), ["k", "tie"], "left")
    judged = judged.withColumn("copy", F.coalesce("copy", F.lit(False)))
    return judged.mapInArrow(partial(_cut, window=window), "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept binary")
