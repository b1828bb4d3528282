"""The archive as another reader of the format sees it: every file and every record, by a small parser."""

import glob
import gzip
import hashlib
import os

from pitchcast import session
from pitchcast.llm import warc


def records(raw: bytes):
    """(headers, block) of each record; fails where the format is not kept."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        headers = dict(line.split(b": ", 1) for line in lines[1:])
        size = int(headers[b"Content-Length"])
        block = raw[end + 4:end + 4 + size]
        assert len(block) == size and raw[end + 4 + size:end + 8 + size] == b"\r\n\r\n"
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"WARC-Target-URI"} <= set(headers) or b"WARC-Target-URI" not in headers
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date"} <= set(headers)
        yield headers, block
        at = end + 8 + size


def test_every_file_and_record_parses(spark, tmp_path):
    big = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>" + "é" * 100
    rows = [(3, "u3", big), (1, "u1", big), (2, "u2", "small"), (5, "u5", "small"), (6, "u6", None), (7, "u7", "x" * 300_000), (8, "u8", "\r\n" * 80)]
    path = str(tmp_path / "a")
    boundary = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path, date="2026-03-01T00:00:00Z")
    stored = [r for f in glob.glob(f"{path}/payloads/part-*") for r in records(gzip.open(f).read())]
    payloads = {(t or "").encode() for _, _, t in rows}
    assert {b for _, b in stored} == payloads and len(stored) == len(payloads)
    for headers, block in stored:
        digest = hashlib.sha256(block).hexdigest().encode()
        assert headers[b"WARC-Type"] == b"resource" and headers[b"WARC-Payload-Digest"] == b"sha256:" + digest
        assert headers[b"WARC-Record-ID"] == b"<urn:sha256:" + digest + b">" and headers[b"WARC-Date"] == b"2026-03-01T00:00:00Z"

    out = {r["page_id"]: r for r in warc.read_records(spark, path, boundary).collect()}
    for i, uri, t in rows:
        r = out[str(i)]
        (headers, block), = records(bytes(r["record"]))
        assert headers[b"WARC-Target-URI"] == uri.encode() and headers[b"WARC-Date"] == b"2026-03-01T00:00:00Z"
        if i == 3:
            assert headers[b"WARC-Type"] == b"revisit" and block == b"" and headers[b"WARC-Profile"] == warc.SAME_PAYLOAD.encode()
            assert headers[b"WARC-Refers-To"] == b"<urn:page:1>" and bytes(r["payload"]) == big.encode()
        else:
            assert headers[b"WARC-Type"] == b"response" and block == (t or "").encode()


def test_the_querys_archive_is_released(spark, tmp_path):
    spark.createDataFrame([(1, "u", "x" * 200), (2, "v", "x" * 200)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    before = list(session._SCRATCH)
    assert warc.query(spark, str(tmp_path)).count() == 2
    mine = [p for p in session._SCRATCH if p not in before]
    assert mine and all(os.path.isdir(p) for p in mine)
    session.release_materialized(spark, mine)
    assert not any(os.path.exists(p) for p in mine)
