"""Repeated substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if it lies in a string of ``least`` bytes that also starts earlier: in a document with a smaller id, or earlier
in the same one. Strings are judged on the input and never cross documents.

The transform cannot be one for all texts on one machine, so texts are first dealt so that equal strings meet. The strings
of ``least`` bytes are labelled by the smallest hash of a ``SEED``-byte piece in them; equal strings have equal labels, and
neighbouring strings mostly share theirs, so a run of them travels as one window of bytes. A label that occurs once has no
repeats and goes no further. In a task, the distinct windows of its labels are put end to end in blocks. A block is sorted
into its transform, and intervals are expanded breadth-first by prepending symbols: the intervals of strings of one length
give the places where neighbouring rows share just that many symbols, then those of one more, up to ``least``. Rows that
are not parted by then share ``least`` symbols, and all but the earliest of such a class are repeats.

Copies of whole texts are repeats of the first in all their bytes and take no part. Equal windows meet their like before
the transform. A label with very many occurrences has its strings travel one by one under their own hashes, where those
that are equal meet in classes again, so a block never exceeds what ``hot`` windows hold.

Defined cases: a null text is empty; texts shorter than ``least`` keep all. A null id comes before all others. Rows that
repeat id and text are one document: they are treated alike. Rows that repeat an id with other texts are in the order of
a hash of the text. An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

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

#: Bytes of the pieces that label strings.
SEED = 16
#: Starts handled at once when labelling; positions fit into the bits that a hash gives up for them.
STARTS, PLACE_BITS = 1 << 16, 17
#: Most strings in a window.
LONGEST_RUN = 256
#: Symbols of a block, if its last label does not make it longer.
BLOCK = 1 << 16
#: Stands between windows; texts have symbols 0 to 255.
END = 256
FIRST_ID = -(1 << 63)


def _byte_hashes() -> np.ndarray:
    z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) | np.uint64(1)


BYTE_HASHES = _byte_hashes()


def _places(data: np.ndarray, least: int) -> np.ndarray:
    """For each string of ``least`` bytes, the smallest hash of a piece in it, its low bits being where the piece stands."""
    with np.errstate(over="ignore"):
        h, factor, w = BYTE_HASHES[data], np.uint64(0x9E3779B97F4A7C15), 1
        while w < SEED:
            h, factor, w = h[:-w] * factor + h[w:], factor * factor, 2 * w
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    window, w = least - SEED + 1, 1
    while 2 * w <= window:
        h, w = np.minimum(h[:-w], h[w:]), 2 * w
    return np.minimum(h[:len(h) - (window - w)], h[window - w:])


def label_runs(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings of one label: document number, start in it, strings, label, and whether the piece moves.

    ``data`` holds documents end to end, ``offsets`` where they begin and the last ends. Where the piece with the smallest
    hash stays in place throughout a run, no two strings of the run are equal.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, len(data), STARTS):
        if len(segment := data[lo:lo + STARTS + least - 1]) < least:
            break
        smallest = _places(segment, least)
        at = np.arange(lo, lo + len(smallest))
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + least <= offsets[doc + 1]
        label = smallest >> np.uint64(PLACE_BITS)
        moved = np.append(False, smallest[1:] != smallest[:-1])
        new = np.append(True, (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])) & inside
        begin = np.flatnonzero(new)
        if not len(begin):
            continue
        stops = np.flatnonzero(np.append(new | ~inside, True))
        length = stops[np.searchsorted(stops, begin, "right")] - begin
        pieces = -(-length // LONGEST_RUN)
        own = np.repeat(np.arange(len(begin)), pieces)
        k = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, length = begin[own] + k * LONGEST_RUN, np.minimum(length[own] - k * LONGEST_RUN, LONGEST_RUN)
        moves = np.cumsum(moved)
        parts.append((doc[begin], at[begin] - offsets[doc[begin]], length, label[begin].astype(np.int64), moves[begin + length - 1] > moves[begin]))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _label(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        bodies_ = [memoryview(b.as_buffer()) for b in batch.column("body")]
        offsets = np.cumsum([0, *(len(b) for b in bodies_)])
        doc, at, n, label, moves = label_runs(np.frombuffer(b"".join(bodies_), np.uint8), offsets, least)
        keys = [batch.column(batch.schema.get_field_index(c)).to_numpy()[doc] for c in ("k", "tie")]
        for lo in range(0, len(doc), 1 << 17):
            s = slice(lo, lo + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(x[s]) for x in (*keys, label, (at << 10) | (n << 1) | moves)], names=["k", "tie", "label", "run"])


def rotations(text: np.ndarray, depth: int) -> np.ndarray:
    """The order of the cyclic rotations of a text by their first ``depth`` symbols (or more)."""
    n, key, got = len(text), np.zeros(len(text), np.uint64), 7
    for k in range(7):
        key = (key << np.uint64(9)) | np.roll(text, -k).astype(np.uint64)
    bits = max(1, (n - 1).bit_length())
    while True:
        order = np.argsort(key)
        in_order = key[order]
        new = np.append(False, in_order[1:] != in_order[:-1])
        if got >= depth or new.sum() == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        together = min(64 // bits, -(-depth // got))
        key = rank
        for k in range(1, together):
            key = (key << np.uint64(bits)) | np.roll(rank, -k * got)
        got *= together


def parted(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether row i and the row before it differ within their first ``least`` symbols, by interval expansion.

    An interval is all rows that begin with some string. Level by level, each interval is expanded by every symbol that
    stands before its rows; where the new interval ends at a place not parted yet, the rows around that place share as many
    symbols as the string had, and the interval lives on. So a place is found once, in the order of what its rows share.
    """
    n = len(text)
    before = text[order - 1].astype(np.uint16)
    ahead = np.empty(n, np.int64)
    ahead[np.argsort(before, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(least):
        single = lo == hi
        begins = [ahead[lo[single]]]
        ends = begins[:]
        a, b = lo[~single], hi[~single]
        if len(a):
            size = b - a + 1
            rows = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
            key = np.repeat(np.arange(len(a)) << 9, size) | before[rows]
            by = np.argsort(key, kind="stable")
            key = key[by]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            last = np.append(first[1:], len(key)) - 1
            begins.append(ahead[rows[by[first]]])
            ends.append(ahead[rows[by[last]]])
        lo, hi = np.concatenate(begins), np.concatenate(ends)
        found = ~known[hi + 1]
        lo, hi = lo[found], hi[found]
        if not len(lo):
            break
        known[hi + 1] = True
    return known


def repeats(windows: list[bytes], where: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int, int]]:
    """(k, tie, start, length) of the runs of bytes that repeats cover, in windows at ``where`` (k, tie, start)."""
    sizes = np.array([len(w) for w in windows])
    text = np.full(int(sizes.sum()) + len(windows), END, np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.ones(len(text), bool)
    symbols[begin + sizes] = False
    text[symbols] = np.frombuffer(b"".join(windows), np.uint8)
    order = rotations(text, least + 1)
    classes = np.flatnonzero(parted(text, order, least)[:-1])
    own = np.repeat(np.arange(len(windows)), sizes + 1)
    offset = np.arange(len(text)) - begin[own]
    whole = offset + least <= sizes[own]
    docs = sorted({w[:2] for w in where})
    number = {d: i for i, d in enumerate(docs)}
    place = np.array([number[w[:2]] << 33 | w[2] for w in where])[own] + offset
    place[~whole] = np.iinfo(np.int64).max
    earliest = np.minimum.reduceat(place[order], classes)
    again = np.zeros(len(text), bool)
    again[order] = place[order] > np.repeat(earliest, np.diff(np.append(classes, len(text))))
    again &= whole
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(*where[own[s]][:2], where[own[s]][2] + int(offset[s]), int(t - s) + least - 1) for s, t in zip(starts.tolist(), stops.tolist(), strict=True)]


WINDOWS = pa.schema([("label", pa.int64()), ("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("moves", pa.bool_()), ("window", pa.binary())])
SPANS = pa.schema([("k", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
WINDOWS_SQL = "label long, k long, tie long, start long, length long, moves boolean, window binary"


def _windows(batches: Iterator[pa.RecordBatch], least: int, remembered: int) -> Iterator[pa.RecordBatch]:
    """Windows of bytes for the runs of each document. One seen in this task at an earlier place goes without its bytes.

    All of such a window is a repeat, so only its place has to travel on.
    """
    seen: dict[bytes, tuple[int, int, int]] = {}
    out: list[tuple] = []

    def add(label: int, at: tuple[int, int, int], moves: bool, window: bytes) -> None:
        known = seen.get(window)
        if known is not None and known < at:
            out.append((hash(at), *at, len(window), False, None))
            return
        if len(seen) >= remembered:
            seen.clear()
        seen[window] = at
        out.append((label, *at, len(window), moves, window))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[] for _ in WINDOWS]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WINDOWS, strict=True)], schema=WINDOWS)

    for batch in slices(batches, 64):
        for r in batch.to_pylist():
            body, k, tie = r["body"], r["k"], r["tie"]
            for x in r["runs"]:
                at, n = x["run"] >> 10, x["run"] >> 1 & 511
                if x["hot"]:
                    for s in range(at, at + n):
                        string = body[s:s + least]
                        add(xxhash.xxh3_64_intdigest(string) - (1 << 63), (k, tie, s), False, string)
                elif at + least <= len(body):
                    add(x["label"], (k, tie, at), bool(x["run"] & 1), body[at:at + n + least - 1])
            if len(out) >= 20_000:
                yield flush()
    yield flush()


def _compare(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeats from windows in the order of their labels."""
    spans: list[tuple[int, int, int, int]] = []
    windows: list[bytes] = []
    where: list[tuple[int, int, int]] = []
    symbols, current, group, moving = 0, None, {}, False

    def close() -> None:
        """A label is complete: of equal windows the first stays, and windows that may share strings join the block."""
        nonlocal symbols
        if len(group) > 1 or moving:
            windows.extend(group)
            where.extend(group.values())
            symbols += sum(map(len, group)) + len(group)

    def flush() -> pa.RecordBatch:
        columns = list(zip(*spans, strict=True)) or [[] for _ in SPANS]
        spans.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SPANS, strict=True)], schema=SPANS)

    for batch in slices(batches, 4096):
        for label, k, tie, start, length, moves, window in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if window is None:
                spans.append((k, tie, start, length))
                continue
            if label != current:
                close()
                current, group, moving = label, {}, False
                if symbols >= BLOCK:
                    spans += repeats(windows, where, least)
                    windows, where, symbols = [], [], 0
            at, known = (k, tie, start), group.get(window)
            moving |= moves
            if known is None:
                group[window] = at
            elif at != known:
                group[window] = min(at, known)
                spans.append((*max(at, known), length))
        if len(spans) >= 20_000:
            yield flush()
    close()
    if windows:
        spans += repeats(windows, where, least)
    yield flush()


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _cut(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches):
        ids, rows = batch.column(batch.schema.get_field_index("doc_id")), []
        for r in batch.to_pylist():
            body = r["body"]
            if r["copy"]:
                gone = [(0, len(body))] if len(body) >= least else []
            else:
                gone = merge([(s["start"], s["start"] + s["length"]) for s in r["spans"] or []])
            at, kept = 0, []
            for start, end in gone:
                kept.append(body[at:start])
                at = end
            rows.append((len(body), [{"start": s, "end": e} for s, e in gone], b"".join([*kept, body[at:]])))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pair, pa.binary())))], names=["doc_id", "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 100, hot: int = 32_768, remembered: int = 50_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (maximal runs of bytes: start, end) and ``kept`` (the other bytes) of every row.

    ``hot`` is the number of occurrences beyond which a label's strings travel one by one; ``remembered`` how many windows
    a task keeps to recognise equal ones early. Neither changes the result. All three steps that need the texts join them by
    the same key and columns in one job, so Spark deals the texts out once and uses that exchange again.
    """
    texts = bodies(docs, id_col, text_col).withColumn("sha", F.sha2("body", 256))
    texts = texts.select(F.coalesce("doc_id", F.lit(FIRST_ID)).alias("k"), F.xxhash64("sha").alias("tie"), "doc_id", "sha", "body")
    keys = saved(texts.select("k", "tie", "sha"), "text-keys")
    many = keys.groupBy("sha").agg(F.min("k").alias("first"), F.max("k").alias("most")).filter("first < most").select("sha", "first")
    copies = saved(keys.join(saved(many, "equal-texts"), "sha").filter("k > first").select("k", "tie").distinct(), "text-copies")
    texts = texts.drop("sha")
    runs = texts.join(copies, ["k", "tie"], "left_anti").mapInArrow(partial(_label, least=least), "k long, tie long, label long, run long")
    runs = runs.withColumn("n", F.count("*").over(W.partitionBy("label"))).filter((F.col("n") > 1) | (F.col("run") % 2 == 1))
    lists = runs.groupBy("k", "tie").agg(F.collect_set(F.struct("label", "run", (F.col("n") > hot).alias("hot"))).alias("runs"))
    windows = texts.join(lists, ["k", "tie"]).mapInArrow(partial(_windows, least=least, remembered=remembered), WINDOWS_SQL)
    spans = windows.repartition("label").sortWithinPartitions("label").mapInArrow(partial(_compare, least=least), "k long, tie long, start long, length long")
    spans = spans.groupBy("k", "tie").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    marked = texts.join(spans, ["k", "tie"], "left").join(copies.withColumn("copy", F.lit(True)), ["k", "tie"], "left")
    marked = marked.withColumn("copy", F.coalesce("copy", F.lit(False)))
    return marked.mapInArrow(partial(_cut, least=least), "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
