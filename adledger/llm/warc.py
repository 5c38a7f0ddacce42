"""WARC archives: records written in segments, revisits for equal payloads, and segment reassembly on reading.

Writing: each page is one record. The first of equal payloads is a response whose block is an HTTP message in chunked
transfer framing; the others are revisits without a payload. A block above ``segment_bytes`` is cut: the record holds
segment 1, and continuation records name its id and their segment number, the last one the total length. Chunks end
inside any text that could be read as a record's version line, so no block contains one.

Reading: archives of versions 1.0 and 1.1, by whatever writer. Spark's own reader cuts the files where a version line may
stand, and the pieces of a file, in order, are framed by Content-Length: a block that holds version lines is put together
again. A stated length that ends nowhere near a record's end is damage; the record is given up and its later pieces are
framed anew. Continuation records are grouped by the id of their origin and put in the order of their segment numbers. A record is whole if its segments are numbered from 1
without a gap, each has its stated length, and together they have the total length. Then the chunked framing is decoded,
the digest verified, and revisits get the size of their payload from the response they name.

Defined cases: a null page is an empty payload, and empty payloads equal each other. Null ids and addresses are left out
of the headers and read back as null; a null id is never the least. Rows that repeat an id and payload are all responses
if that id is the least, and all come back. An empty table gives an archive without records. Other columns are not
looked at. On reading, a damaged record comes back with ``complete`` false, and so does one whose header states
more than ``MOST_BYTES``, which no cell can hold. Records of other writers have no page id. Digests other than SHA-1 are
not verified. Compressed files are read whole by one task each. In a plain file that Spark splits, a record that holds a
version line and crosses a split's border comes back in pieces, not complete.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.llm.rows import slices
from adledger.session import saved, scratch_dir

#: Fixed values of the format.
VERSION = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
#: Where the reader cuts: the start of the version lines of both versions, and what may follow it.
CUT, MINORS = b"WARC/1.", (b"0\r\n", b"1\r\n")
LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t\r]*$")
#: No record above this is put together; a cell of a table holds less than 2**31 bytes.
MOST_BYTES = 1 << 30
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(body: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: eight characters for each ten hex digits."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    sha = F.sha1(body)
    return F.concat(*(F.translate(F.lpad(F.conv(F.substring(sha, 10 * k + 1, 10), 16, 32), 8, "0"), digits, BASE32) for k in range(4)))


def to_chunks(payload: bytes, chunk_bytes: int) -> bytes:
    """Chunked transfer framing; version lines are cut after their first letter."""
    version, out, at = VERSION.encode(), [], 0
    while at < len(payload):
        end = min(at + chunk_bytes, len(payload))
        found = payload.find(version, at, end + len(version))
        end = min(end, found + 1) if found >= 0 else end
        out += [b"%x\r\n" % (end - at), payload[at:end], b"\r\n"]
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def from_chunks(block: bytes) -> bytes | None:
    """The payload of an HTTP message in chunked framing (extensions and trailers allowed); None if it is damaged."""
    head = block.find(b"\r\n\r\n")
    if head < 0:
        return None
    if not re.search(rb"\r\ntransfer-encoding:[^\r\n]*chunked", block[:head].lower()):
        return block[head + 4:]
    out, at = [], head + 4
    while True:
        line = block.find(b"\r\n", at)
        size = re.match(rb"[0-9a-fA-F]+(?=[ \t]*(;|$))", block[at:line]) if line >= 0 else None
        if not size:
            return None
        n, at = int(size[0], 16), line + 2
        if not n:
            return b"".join(out) if block.startswith(b"\r\n", at) or block.find(b"\r\n\r\n", at) >= 0 else None
        if block[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(block[at:at + n])
        at += n + 2


def _frame(batches: Iterator[pa.RecordBatch], segment_bytes: int, chunk_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for r in batch.to_pylist():
            revisit = r["body"] is None
            block = b"" if revisit else HTTP + to_chunks(r["body"], chunk_bytes)
            digest = f"WARC-Payload-Digest: sha1:{r['digest']}\r\n"
            about = f"WARC-Target-URI: {r['url']}\r\n" if r["url"] else ""
            about += f"Page-Id: {r['page_id']}\r\n" if r["page_id"] is not None else ""
            about += f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nRefers-To-Page-Id: {r['first']}\r\n" if revisit else "Content-Type: application/http; msgtype=response\r\n"
            cuts = range(0, max(len(block), 1), segment_bytes)
            origin = f"<urn:uuid:{r['uuid']}>"
            for k, at in enumerate(cuts, 1):
                part = block[at:at + segment_bytes]
                head = f"WARC-Type: {'continuation' if k > 1 else 'revisit' if revisit else 'response'}\r\nWARC-Date: {date}\r\nContent-Length: {len(part)}\r\n"
                if k > 1:
                    own = hashlib.md5(f"{r['uuid']}/{k}".encode()).hexdigest()
                    head += f"WARC-Record-ID: <urn:uuid:{own[:8]}-{own[8:12]}-{own[12:16]}-{own[16:20]}-{own[20:]}>\r\nWARC-Segment-Origin-ID: {origin}\r\n"
                else:
                    head += f"WARC-Record-ID: {origin}\r\n{about}{digest}"
                head += f"WARC-Segment-Number: {k}\r\n" if len(cuts) > 1 else ""
                head += f"WARC-Segment-Total-Length: {len(block)}\r\n" if len(cuts) > 1 and k == len(cuts) else ""
                out.append((VERSION + head + "\r\n").encode() + part)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least_bytes: int = 0,
    segment_bytes: int = 1 << 14, chunk_bytes: int = 1 << 13, records_per_file: int = 50_000, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row as gzip files below ``path``. Payloads of fewer than ``least_bytes`` bytes are never revisits.

    Equal payloads are found by their SHA-256 on narrow rows. What comes back is a row per payload that occurs twice or
    more, written to the shared folder, so that Spark sends it to the tasks if it is small and else joins.
    """
    text = F.coalesce(pages[body_col].cast("string"), F.lit(""))
    url = F.regexp_replace(pages[url_col].cast("string"), r"[\p{Cntrl}\s]", "")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), url.alias("url"), text.cast("binary").alias("body")).withColumn("same", F.sha2("body", 256))
    many = rows.filter(F.octet_length("body") >= least_bytes).groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    many = saved(many.filter("n > 1").select("same", "first"), "equal-payloads")
    typed = rows.join(many, "same", "left").withColumn("digest", base32_sha1(F.col("body")))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.md5(F.concat_ws("/", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "same", F.monotonically_increasing_id().cast("string")))
    uuid = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    framed = typed.select("page_id", "url", F.when(again, F.lit(None)).otherwise(F.col("body")).alias("body"), "first", "digest", uuid.alias("uuid"))
    records = framed.mapInArrow(partial(_frame, segment_bytes=segment_bytes, chunk_bytes=chunk_bytes, date=date), "record binary")
    files = records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", GAP).option("compression", "gzip")
    files.option("maxRecordsPerFile", records_per_file).text(path)


def _settled(held: list[bytes], ended: bool) -> tuple[list[tuple[bytes, bytes, bool]], list[bytes]]:
    """(head, block, fits) of the records that the pieces decide, and the pieces that wait for more of their file."""
    gap, out, at = GAP.encode(), [], 0
    while at < len(held):
        head, _, block = held[at].partition(gap)
        found = LENGTH.search(head) if held[at].startswith(MINORS) else None
        length, size, k = int(found[1]) if found else -1, len(block), at + 1
        fits = bool(found) and length <= MOST_BYTES
        while fits and size < length and k < len(held):
            size, k = size + len(CUT) + len(held[k]), k + 1
        if fits and size < length and not ended:
            break
        if fits and length <= size <= length + len(gap):
            block = CUT.join([block, *held[at + 1:k]])
            fits = gap.startswith(block[length:])
        else:
            fits = False
        out.append((head, block[:length] if fits else block, fits))
        at = k if fits else at + 1
    return out, held[at:]


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (part of a file, raw) in their order in it to records (head, block, fits)."""

    def batch_of(records: list[tuple[bytes, bytes, bool]]) -> pa.RecordBatch:
        heads = pa.array([h.decode("utf-8", "replace") for h, _, _ in records], pa.string())
        blocks, fits = pa.array([b for _, b, _ in records], pa.binary()), pa.array([f for _, _, f in records], pa.bool_())
        return pa.RecordBatch.from_arrays([heads, blocks, fits], names=["head", "block", "fits"])

    part, held = None, []
    for batch in slices(batches):
        records = []
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != part:
                records += _settled(held, True)[0]
                part, held = name, []
            if held or raw:
                held.append(raw)
        done, held = _settled(held, False)
        yield batch_of(records + done)
    yield batch_of(_settled(held, True)[0])


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = batch.to_pylist()
        payloads = [from_chunks(r["block"]) if r["fits"] and r["record_type"] == "response" else None for r in rows]
        sha = [None if p is None else base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads]
        ok = [r["fits"] and (r["record_type"] != "response" or p is not None and r["digest"] in (None, s)) for r, p, s in zip(rows, payloads, sha, strict=True)]
        names = ["record_id", "record_type", "page_id", "url", "refers_to"]
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        digest = pa.array([s or r["digest"] for r, s in zip(rows, sha, strict=True)], pa.string())
        yield pa.RecordBatch.from_arrays([*columns, digest, pa.array(payloads, pa.binary()), pa.array(ok, pa.bool_())], names=[*names, "payload_digest", "payload", "complete"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: record_id, record_type, page_id, url, refers_to, payload_digest, payload, complete.

    Records in one segment are decoded where they are read. Only segmented ones are grouped, by their origin's id; a
    group is one record, and no larger than that.
    """
    pieces = spark.read.option("lineSep", CUT.decode()).text(path).select(F.concat_ws(" ", "_metadata.file_path", F.col("_metadata.file_block_start").cast("string")).alias("part"), F.col("value").cast("binary").alias("raw"))
    records = pieces.mapInArrow(_framed, "head string, block binary, fits boolean")
    field = lambda name: F.nullif(F.regexp_extract(F.col("head"), rf"(?im)^{name}:[ \t]*(.*?)[ \t\r]*$", 1), F.lit(""))
    digest = field("WARC-Payload-Digest")
    parsed = records.select(
        field("WARC-Record-ID").alias("record_id"), F.lower(field("WARC-Type")).alias("record_type"), field("Page-Id").try_cast("long").alias("page_id"),
        F.regexp_replace(field("WARC-Target-URI"), "^<(.*)>$", "$1").alias("url"), field("Refers-To-Page-Id").try_cast("long").alias("refers_to"),
        F.when(digest.rlike("(?i)^sha1:"), F.substr(digest, F.lit(6))).alias("digest"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"), field("WARC-Segment-Number").try_cast("int").alias("segment"),
        field("WARC-Segment-Total-Length").try_cast("long").alias("total"), "block", "fits",
    )
    fits = F.coalesce("fits", F.lit(False))
    plain = parsed.filter("segment IS NULL AND record_type <> 'continuation'").withColumn("fits", fits)
    first = lambda n: F.max(F.when(F.col("segment") == 1, F.col(n))).alias(n)
    parts = parsed.filter("segment IS NOT NULL OR record_type = 'continuation'").withColumn("fits", fits)
    part = F.struct("segment", "total", "fits", "block")
    joined = parts.groupBy("origin").agg(*(first(n) for n in ("record_id", "record_type", "page_id", "url", "refers_to", "digest")), F.sort_array(F.collect_set(part)).alias("s"))
    body = F.array_join(F.transform("s", lambda x: x["block"].cast("string")), "").cast("binary")
    numbered = F.transform("s", lambda x: x["segment"]) == F.sequence(F.lit(1), F.size("s"))
    whole = F.forall("s", lambda x: x["fits"]) & numbered & (F.element_at("s", -1)["total"] == F.octet_length("block"))
    joined = joined.withColumn("block", body).withColumn("fits", F.coalesce(whole, F.lit(False))).withColumn("record_id", F.coalesce("record_id", "origin"))
    names = ["record_id", "record_type", "page_id", "url", "refers_to", "digest", "block", "fits"]
    out = "record_id string, record_type string, page_id long, url string, refers_to long, payload_digest string, payload binary, complete boolean"
    return plain.select(*names).unionByName(joined.select(*names)).mapInArrow(_decode, out)


def catalogue(records: DataFrame) -> DataFrame:
    """``records`` of ``read_archive`` without payloads, but with ``payload_bytes``: a revisit has that of its response."""
    narrow = saved(records.select("record_id", "record_type", "page_id", "url", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("n"), "complete"), "records")
    known = narrow.filter("record_type = 'response' AND complete").groupBy(F.col("page_id").alias("k_id"), F.col("payload_digest").alias("k_digest")).agg(F.max("n").alias("k_n"))
    asked = narrow.filter("record_type = 'revisit'").select(F.col("refers_to").alias("k_id"), F.col("payload_digest").alias("k_digest")).distinct()
    known = saved(known.join(asked, ["k_id", "k_digest"], "left_semi"), "revisited")
    same = (F.col("refers_to") == F.col("k_id")) & (F.col("payload_digest") == F.col("k_digest"))
    return narrow.join(known, same, "left").select("record_id", "record_type", "page_id", "url", "refers_to", "payload_digest", F.coalesce("n", "k_n").alias("payload_bytes"), "complete")


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder of the shared scratch space, read the archive back and list its records."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    return catalogue(read_archive(pages.sparkSession, path))
