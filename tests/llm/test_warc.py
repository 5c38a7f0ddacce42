"""Archives against brute force: framing, segments, revisits, damage, and the round trip of odd pages."""

import base64
import gzip
import hashlib

import pytest

from adledger.llm import warc
from adledger.session import scratch_dir


@pytest.fixture()
def pages(spark):
    def make(rows):
        full = [(i, u, h, "x", "y", 1) for i, u, h in rows]
        return spark.createDataFrame(full, "page_id long, url string, html string, body string, first string, same int").repartition(3)

    return make


def brute(rows, least_bytes=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        body, ids = (h or "").encode(), [x for x in groups[h or ""] if x is not None]
        again = len(groups[h or ""]) > 1 and len(body) >= least_bytes and ids and i != min(ids)
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def got(records):
    assert all(r.complete for r in records)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str)


ROWS = [
    (5, "http://a/\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>" * 30), (3, None, "same"), (9, "u", "same"), (9, "u", "same"), (3, "u2", "same"),
    (None, "u", "same"), (1, "u", None), (2, "u", ""), (7, "u", "WARC/1.1\r\n" * 50), (8, "u", "z" * 100_000), (None, None, "alone"), (11, "u", "0\r\n\r\n" * 9), (12, "u", "\n\n"),
]


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 7, "chunk_bytes": 5}, {"segment_bytes": 100, "records_per_file": 2}, {"least_bytes": 5}])
def test_round_trip_of_odd_pages(pages, options):
    rows = [r for r in ROWS if len(r[2] or "") < 5000] if options.get("segment_bytes") == 7 else ROWS
    assert got(warc.archived(pages(rows), **options).collect()) == brute(rows, options.get("least_bytes", 0))


def test_empty_table(pages):
    assert warc.archived(pages(ROWS).filter("page_id > 99")).count() == 0


def test_payloads_come_back(spark, pages):
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(pages(ROWS), path, segment_bytes=64)
    back = {r.page_id: r.payload.decode() for r in warc.read_archive(spark, path).filter("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert back == {i: h or "" for i, _, h in ROWS if i not in (None, 2, 9)}


def test_chunk_framing():
    body = b"abc" * 100
    assert warc.from_chunks(warc.HTTP + warc.to_chunks(body, 7)) == body
    assert warc.from_chunks(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=y\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    assert warc.from_chunks(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"
    for bad in (b"no head", warc.HTTP, warc.HTTP + b"5\r\nabc\r\n0\r\n\r\n", warc.HTTP + b"zz\r\n", warc.HTTP + b"3\r\nabc\r\n"):
        assert warc.from_chunks(bad) is None


def test_damaged_segments_are_told(spark):
    def record(kind, name, block, **more):
        head = {"WARC-Type": kind, "WARC-Record-ID": name, "Content-Length": len(block), **more}
        return warc.VERSION + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n" + block

    message = "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    segment = lambda i, k: {"WARC-Segment-Origin-ID": i, "WARC-Segment-Number": k}
    n = len(message)
    records = [
        record("response", "<ok>", message[:50], **{"WARC-Segment-Number": 1}), record("continuation", "<ok2>", message[50:], **segment("<ok>", 2), **{"WARC-Segment-Total-Length": n}),
        record("response", "<gap>", message[:50], **{"WARC-Segment-Number": 1}), record("continuation", "<gap3>", message[50:], **segment("<gap>", 3), **{"WARC-Segment-Total-Length": n}),
        record("response", "<total>", message[:50], **{"WARC-Segment-Number": 1}), record("continuation", "<total2>", message[50:], **segment("<total>", 2), **{"WARC-Segment-Total-Length": n + 1}),
        record("response", "<open>", message[:50], **{"WARC-Segment-Number": 1}), record("continuation", "<lone2>", "x", **segment("<lone>", 2), **{"WARC-Segment-Total-Length": 1}),
        record("response", "<short>", message).replace(f"Content-Length: {n}", f"Content-Length: {n + 9}"), record("response", "<digest>", message, **{"WARC-Payload-Digest": "sha1:" + "A" * 32}),
        record("response", "<plain>", message), record("warcinfo", "<info>", "software: x"),
    ]
    path = scratch_dir(spark, "warc-damaged")
    spark.createDataFrame([(r,) for r in records], "value string").repartition(4).write.option("lineSep", warc.GAP).text(path)
    back = {r.record_id: (r.complete, r.payload) for r in warc.read_archive(spark, path).collect()}
    assert {k for k, v in back.items() if v[0]} == {"<ok>", "<plain>", "<info>"}
    assert back["<ok>"][1] == back["<plain>"][1] == b"abc" and len(back) == 9


BODIES = {
    "<plain>": b"<p>no version line</p>", "<line>": b"a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n", "<ends>": b"x WARC/1.",
    "<cuts>": b"WARC/1.WARC/1.0\r\nWARC/1.1\r\n" * 400, "<empty>": b"", "<bytes>": bytes(range(256)) * 40,
}


def foreign(version, name, block, kind="response", **more):
    head = {"WARC-Type": kind, "WARC-Record-ID": name, "Content-Type": "application/http; msgtype=response", "Content-Length": len(block), **more}
    return f"WARC/{version}\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    message = lambda body: b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    for version in ("1.0", "1.1"):
        info = foreign(version, f"<info>{version}", b"software: other\r\n", kind="warcinfo")
        records = [foreign(version, n + version, message(b), **{"WARC-Target-URI": f"<http://{n[1:-1]}/>", "WARC-Payload-Digest": "sha256:abc"}) for n, b in BODIES.items()]
        with open(tmp_path / f"members-{version}.warc.gz", "wb") as f:
            f.writelines(gzip.compress(r) for r in [info, *records])
    (tmp_path / "plain.warc").write_bytes(b"".join(foreign("1.0", n + "plain", message(b)) for n, b in BODIES.items()))
    back = {r.record_id: r for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert len(back) == 3 * len(BODIES) + 2 and all(r.complete for r in back.values())
    for n, body in BODIES.items():
        assert {back[n + v].payload for v in ("1.0", "1.1", "plain")} == {body}
    assert back["<plain>1.0"].url == "http://plain/" and back["<plain>plain"].url is None
    assert back["<plain>1.0"].payload_digest == base64.b32encode(hashlib.sha1(BODIES["<plain>"]).digest()).decode()


def test_wrong_lengths_lose_only_their_own_record():
    good = [foreign("1.0", f"<{k}>", b"block %d" % k) for k in range(6)]
    for wrong in (b"0", b"6", b"8", b"40", b"99999999", b"9" * 30, b"x"):
        records = list(good)
        records[2] = records[2].replace(b"Content-Length: 7", b"Content-Length: " + wrong)
        pieces = b"".join(records).split(warc.CUT)[1:]
        whole, left = warc._settled(pieces, True)
        assert not left and [b for _, b, f in whole if f] == [b"block %d" % k for k in (0, 1, 3, 4, 5)], wrong


@pytest.mark.parametrize("step", [1, 2, 3, 1000])
def test_framing_does_not_depend_on_batches(step):
    data = b"".join(foreign("1.1", n, b) for n, b in BODIES.items())
    pieces, held, got_blocks = data.split(warc.CUT)[1:], [], []
    for at in range(0, len(pieces), step):
        done, held = warc._settled(held + pieces[at:at + step], False)
        got_blocks += done
    got_blocks += warc._settled(held, True)[0]
    assert [b for _, b, f in got_blocks if f] == list(BODIES.values())
