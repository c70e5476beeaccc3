"""Archives as other tools write them, and what revisits say to other readers."""

import base64
import gzip
import hashlib
import zlib

import pytest

from tidebook.llm import warc


def member(fields, block, version="WARC/1.0"):
    head = version + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n")


def read(data, at_once=7):
    held = [data]

    def take(n):
        out, held[0] = held[0][:at_once], held[0][at_once:]
        return out

    return list(warc.records(take))


BODY = b"<html>hello</html>"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_of_other_tools():
    archive = b"".join([
        member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:1>"), ("Content-Type", "application/warc-fields")], b"software: some crawler\r\n"),
        member([("WARC-Type", "request"), ("Content-Type", "application/http; msgtype=request"), ("WARC-Target-URI", "http://h/")], b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        member([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:2>"), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", sha1(BODY)), ("WARC-Block-Digest", sha1(HTTP + BODY))], HTTP + BODY),
        member([("WARC-Type", "revisit"), ("WARC-Refers-To", "<urn:uuid:2>"), ("Content-Type", "application/http"), ("WARC-Payload-Digest", sha1(BODY))], HTTP),
        member([("WARC-Type", "resource"), ("Content-Type", "text/plain"), ("WARC-Block-Digest", "blake9:xyz")], b"plain"),
        member([("WARC-Type", "metadata")], b""),
    ])
    for step in (1, 7, 100_000):
        found = read(archive, step)
        assert [r["record_type"] for r in found] == ["warcinfo", "request", "response", "revisit", "resource", "metadata"]
        assert [r["payload"] for r in found] == [b"software: some crawler\r\n", b"", BODY, None, b"plain", b""]
        assert found[2]["payload_digest"] == hashlib.sha256(BODY).hexdigest() and found[3]["payload_digest"] is None
        assert found[3]["refers_to_record"] == found[2]["record_id"] == "<urn:uuid:2>" and all(r["page_id"] is None for r in found)


@pytest.mark.parametrize("wrong", [
    [("WARC-Type", "response"), ("Content-Type", "application/http"), ("WARC-Payload-Digest", sha1(b"other"))],
    [("WARC-Type", "response"), ("Content-Type", "application/http"), ("WARC-Block-Digest", sha1(b"other"))],
    [("Content-Type", "application/http")],
])
def test_what_does_not_hold_is_found(wrong):
    with pytest.raises(warc.WarcError):
        read(member(wrong, HTTP + BODY))


def test_revisits_name_the_record_they_revisit():
    digest = hashlib.sha256(BODY).hexdigest()
    first, again = warc.record(-4, "http://h/a", BODY, digest, None), warc.record(9, None, BODY, digest, -4, "http://h/a")
    a, b = read(first + again)
    assert (a["page_id"], b["page_id"], b["refers_to"]) == (-4, 9, -4) and b["refers_to_record"] == a["record_id"]
    assert b"WARC-Refers-To-Target-URI: http://h/a\r\n" in zlib.decompress(again, 31) and b"WARC-Refers-To-Date: " in zlib.decompress(again, 31)


def test_pages_of_a_hot_payload(spark, monkeypatch):
    from tidebook.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = [(k, f"http://h/{k}", "same " * 40 if k % 3 else f"own {k} " * 30) for k in range(120)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    want = {k: (None if k % 3 == 0 or k == 1 else 1) for k, *_ in rows}
    for most in (500_000, 5):  # broadcast, and joined in a shuffle
        monkeypatch.setattr(warc, "BROADCAST_REVISITS", most)
        assert {r.page_id: r.refers_to for r in warc.read_archives(warc.write_archives(pages)).collect()} == want
