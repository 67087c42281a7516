"""WARC: round trips, revisits, pushed-down header predicates, payloads left unread, lost attempts."""

import base64
import gzip
import hashlib
import json

import pytest
from pyarrow import fs as pafs

from kitchenlens.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/4\r\nX: y", "é ü \r\n\r\n WARC/1.1"), (5, "http://a/5", None), (6, "http://a/6", ""),
         (7, "http://b/7", "big " * 300_000), (None, "http://b/n", "only"), (8, "http://b/8", "twice"), (8, "http://b/8", "twice"), (None, "u", "same")]


@pytest.mark.parametrize("max_broadcast", [0, 1000])
def test_round_trip(spark, tmp_path, max_broadcast):
    warc.use_warc(spark)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string")
    path = f"file://{tmp_path}/w"
    warc.page_records(pages, max_broadcast=max_broadcast).write.format("warc").mode("append").option("file_bytes", 500).save(path)
    back = spark.read.format("warc").load(path)
    got = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_length, r.payload and bytes(r.payload)) for r in back.collect()), key=str)
    largest = {}
    for i, _, h in PAGES:
        h = (h or "").encode()
        largest[h] = max(largest.get(h, -1), -1 if i is None else i)
    want = []
    for i, _, h in PAGES:
        h = (h or "").encode()
        again = largest[h] != (-1 if i is None else i)
        want.append((f"urn:page:{'' if i is None else i}", "revisit" if again else "response", f"urn:page:{largest[h]}" if again else None, digest(h), len(h), None if again else h or b""))
    norm = lambda rows: sorted(((*r[:5], r[5] or None) for r in rows), key=str)
    assert norm(got) == norm(want)
    assert {r.target_uri for r in back.collect()} == {None if u is None else u.replace("\r\n", "%0D%0A") for _, u, _ in PAGES}


def test_push_down_and_skipping(spark, tmp_path, monkeypatch):
    warc.use_warc(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.page_records(pages).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path)
    some = back.where("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert sorted(r.record_id for r in some.collect()) == ["urn:page:1", "urn:page:2", "urn:page:5"]
    assert "Filter (" not in some._jdf.queryExecution().executedPlan().toString()
    assert back.where("record_id in ('urn:page:7', 'urn:page:2') and payload_length > 100").count() == 1
    assert spark.read.format("warc").option("payload", "false").load(path).where("payload is not null").count() == 0
    passed = []
    monkeypatch.setattr(warc._Stream, "skip", lambda self, n, f=warc._Stream.skip: (passed.append(n), f(self, n))[1])
    system = pafs.LocalFileSystem()
    rows = [r for x in sorted((tmp_path / "w").glob("*.warc.gz")) for r in warc.read_records(system, str(x), warc.Wanted(values={"record_id": ["urn:page:1"]}), True)]
    assert len(rows) == 1 and max(passed) > 1_000_000


def test_only_committed_files_count(spark, tmp_path):
    warc.use_warc(spark)
    path = f"file://{tmp_path}/w"
    pages = spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")
    warc.page_records(pages).write.format("warc").mode("append").save(path)
    (tmp_path / "w/part-lost.warc.gz").write_bytes(b"half a rec")
    assert spark.read.format("warc").load(path).count() == 2
    warc.page_records(pages.limit(1)).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 1
    warc.page_records(pages.limit(0)).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 0


def test_foreign_archives(spark, tmp_path):
    warc.use_warc(spark)
    head = "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    block = "HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    page = f"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((head + page).encode())
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(head.encode()) + gzip.compress(page.encode()))
    (tmp_path / "notes.json").write_text(json.dumps({}))
    got = sorted((r.record_type, r.record_id, bytes(r.payload)) for r in spark.read.format("warc").load(str(tmp_path)).collect())
    assert got == [("response", "urn:uuid:2", b"body")] * 2 + [("warcinfo", "urn:uuid:1", b"abcde")] * 2
    assert spark.read.format("warc").load(str(tmp_path / "a.warc")).count() == 2
