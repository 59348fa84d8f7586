import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull

from playrank.llm.warc import WarcReader, archive_pages, page_records, read_warc, write_warc

BIG = "<p>" + "é" * 600 + "</p>"
PAGES = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (3, "http://a/3\r\nX: y", BIG),
    (4, "http://a/4", "small"),
    (5, None, "small"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", "x" * 999),
    (9, "http://a/9", "x" * 999),
    (10, "http://a/10", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" + "y" * 3_000_000),
    (None, "http://a/none", "z" * 2000),
    (12, "http://a/12", "z" * 2000),
    (13, "http://a/13", "\x00\r\n\r\n" * 400),
    (13, "http://a/13", "\x00\r\n\r\n" * 400),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return rows.withColumns({c: F.lit("clash") for c in ("payload", "record_id", "first", "n", "same")})


def expected():
    result = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == raw]
        known = [p for p in same if p is not None]
        first = max(known) if known and len(raw) >= 1000 else page
        again = len(same) > 1 and page != first
        result.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(result, key=str)


def test_round_trip(pages):
    got = archive_pages(pages)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected()


@pytest.mark.parametrize("compress", [False, True])
def test_files_and_payloads(spark, pages, tmp_path, compress):
    folder = str(tmp_path / "out")
    manifest = write_warc(page_records(pages), folder, compress, file_bytes=100 if compress else 3000)
    assert manifest.count() > 2 and manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    back = read_warc(spark, folder)
    assert back.count() == len(PAGES)
    bodies = {r["record_id"]: bytes(r["payload"]) for r in back.where("warc_type = 'response'").collect()}
    assert bodies["urn:page:10"] == PAGES[9][2].encode() and bodies["urn:page:6"] == b""
    assert all(r["payload"] is None for r in read_warc(spark, folder, payload=False).collect())
    if compress:  # members of their own: any gzip reader sees whole records
        name = manifest.first()["file"]
        assert gzip.open(name).read().startswith(b"WARC/1.1\r\n")


def test_filters_reach_the_reader(spark, pages, tmp_path):
    folder = str(tmp_path / "out")
    write_warc(page_records(pages), folder)
    found = read_warc(spark, folder, payload=False).where("warc_type = 'revisit' AND refers_to = 'urn:page:3'")
    assert sorted(r["record_id"] for r in found.collect()) == ["urn:page:1", "urn:page:2"]
    assert read_warc(spark, folder).where("target_uri IS NULL").count() == 1
    reader = WarcReader({"path": folder})
    left = list(reader.pushFilters([EqualTo(("warc_type",), "revisit"), IsNull(("target_uri",)), GreaterThan(("payload_length",), 5)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"] and len(reader.tests) == 2


def test_unwanted_payloads_are_not_read(tmp_path, monkeypatch):
    import playrank.llm.warc as module

    raw = module.record_bytes("urn:page:1", "response", None, "0" * 40, 50_000_000, None, b"x" * 50_000_000)
    (tmp_path / "a.warc").write_bytes(raw * 2)
    read = []
    more = module._Input._more
    monkeypatch.setattr(module._Input, "_more", lambda self: read.append(1) or more(self))
    reader = WarcReader({"path": str(tmp_path), "payload": "skip"})
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in batches) == 2 and len(read) <= 6


def record(kind, block, **header):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"Content-Length: {len(block)}", *[f"{k.replace('_', '-')}: {v}" for k, v in header.items()]]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others_are_read(tmp_path, packed):
    """HTTP heads without a length, foreign digests, blocks without a blank line, records that are no HTTP."""
    http = "application/http; msgtype=response"
    sha = "sha1:" + __import__("base64").b32encode(hashlib.sha1(b"body").digest()).decode()
    raw = b"".join(
        [
            record("warcinfo", b"software: x\r\n"),
            record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nbody", Content_Type=http, WARC_Payload_Digest=sha, WARC_Record_ID="<urn:a>"),
            record("response", b"HTTP/1.1 200 OK\r\nContent-Length: 999\r\n\r\nshort", Content_Type=http, WARC_Payload_Digest="md5:0123456789abcdef", WARC_Record_ID="<urn:b>"),
            record("response", b"no blank line here", Content_Type=http, WARC_Payload_Digest="sha1:notbase32!", WARC_Record_ID="<urn:c>"),
            record("response", b"", Content_Type=http, WARC_Record_ID="<urn:d>"),
            record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 77\r\n\r\n", Content_Type=http, WARC_Record_ID="<urn:e>", WARC_Refers_To="<urn:a>"),
            record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: many\r\n\r\n", Content_Type=http, WARC_Record_ID="<urn:f>"),
            record("resource", b"\x00\r\n\r\n\xff", WARC_Record_ID="<urn:g>"),
            record("response", b"HTTP/1.1 200 OK\r\n\r\nlast", Content_Type=http, WARC_Record_ID="<urn:h>"),
        ]
    )
    name = tmp_path / ("x.warc.gz" if packed else "x.warc")
    name.write_bytes(gzip.compress(raw) if packed else raw)
    for payload in ("read", "skip"):
        reader = WarcReader({"path": str(tmp_path), "payload": payload})
        rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["record_id"], r["payload_length"], r["payload_digest"]) for r in rows] == [
            (None, 13, None),
            ("urn:a", 4, hashlib.sha1(b"body").hexdigest()),
            ("urn:b", 5, "md5:0123456789abcdef"),
            ("urn:c", 18, "sha1:notbase32!"),
            ("urn:d", 0, None),
            ("urn:e", 77, None),
            ("urn:f", 0, None),
            ("urn:g", 6, None),
            ("urn:h", 4, None),
        ]
        if payload == "read":
            assert [r["payload"] for r in rows] == [b"software: x\r\n", b"body", b"short", b"no blank line here", b"", None, None, b"\x00\r\n\r\n\xff", b"last"]


def test_a_record_without_a_length_is_an_error(tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nx")
    reader = WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="without a length"):
        list(reader.read(reader.partitions()[0]))


def test_a_payload_that_many_pages_share(spark, monkeypatch):
    import playrank.llm.runs as module

    monkeypatch.setattr(module, "HOT", 4)
    rows = [(k, f"u{k}", "shared" * 300 if k % 3 == 0 else f"pair {k // 20}" * 200 if k % 3 == 1 else f"own {k}" * 300) for k in range(120)]
    got = page_records(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    last = {}
    for k, _, html in rows:
        last[html] = max(last.get(html, k), k)
    assert sorted((r["record_id"], r["warc_type"], r["refers_to"]) for r in got) == sorted(
        (f"urn:page:{k}", "response" if last[h] == k else "revisit", None if last[h] == k else f"urn:page:{last[h]}") for k, _, h in rows
    )


def test_a_broken_archive_is_an_error(tmp_path):
    import playrank.llm.warc as module

    raw = module.record_bytes("urn:page:1", "response", None, "0" * 40, 10, None, b"x" * 10)
    (tmp_path / "a.warc").write_bytes(raw[:-20])
    reader = WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="breaks off"):
        list(reader.read(reader.partitions()[0]))


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
