import base64
import gzip
import hashlib
import os
from collections import Counter

import pytest

from lookback.llm.warc import archived_pages, assemble, parse_warc, read_warc, write_warc


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}.test/p{i}", f"<p>page {i % 7} é</p>") for i in range(30)]
    rows += [
        (None, None, None),
        (None, "x", "<p>page 1 é</p>"),
        (50, "http://a b\r\nX-Evil: y/é", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
        (51, "", ""),
        (51, "", ""),
        (52, "http://long.test", "y" * 300_000),
    ]
    rows = [(*r, "clash", 1) for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, capture int")


def expected(rows, least=0):
    seen, out = {}, Counter()
    for r in sorted(rows, key=lambda r: (r.page_id is None, r.page_id or 0)):
        body = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = body in seen and len(body) >= least
        kind = "revisit" if again else "response"
        out[r.page_id, len(body), digest, kind, seen[body] if again else None] += 1
        seen.setdefault(body, r.page_id)
    return out


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip_equals_brute_force(pages, least):
    got = archived_pages(pages, min_bytes=least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == expected(pages.collect(), least)


def test_no_pages(spark, pages):
    assert archived_pages(pages.limit(0)).count() == 0


def test_captures_nest_their_records_and_payloads(spark, pages, folder):
    write_warc(pages.where("page_id < 3"), f"{folder}/a")
    captures = assemble(read_warc(spark, f"{folder}/a")).collect()
    assert len(captures) == 3
    for c in captures:
        assert [r.record_type for r in c.requests] == ["request"]
        assert [r.record_type for r in c.metadata] == ["metadata"]
        assert c.response.declared_digest == c.response.payload_digest
        assert c.response.http_status == "200"
        assert bytes(c.response.payload).startswith(b"<p>page")


def record(kind, ident, block, **headers):
    lines = {"WARC-Type": kind, "WARC-Record-ID": ident, "Content-Length": len(block), **headers}
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in lines.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_parser_reads_plain_and_gzip_members():
    a = record("resource", "<a>", b"one")
    b = record("metadata", "<b>", b"f: 1\r\n", WARC_Concurrent_To="<a>")
    for data in (a + b, gzip.compress(a + b), gzip.compress(a) + gzip.compress(b)):
        one, two = parse_warc(data, True)
        assert (one["payload"], one["payload_bytes"]) == (b"one", 3)
        assert two["concurrent_to"] == ["<a>"] and two["fields"] == "f: 1\r\n"
    with pytest.raises(ValueError):
        list(parse_warc(a[:-6], True))
    with pytest.raises(ValueError):
        list(parse_warc(b"junk\r\n", True))


def test_links_count_both_ways_and_over_one_record(spark, folder):
    data = (
        record("response", "<r>", b"x", WARC_Concurrent_To="<q>")
        + record("request", "<q>", b"GET")
        + record("metadata", "<m>", b"k", WARC_Concurrent_To="<q>")
        + record("metadata", "<lone>", b"k", WARC_Concurrent_To="<nowhere>")
        + record("revisit", "<v>", b"", WARC_Refers_To="<missing>")
    )
    with open(f"{folder}/a.gz", "wb") as f:
        f.write(gzip.compress(data))
    rows = {c.capture_id: c for c in assemble(read_warc(spark, folder)).collect()}
    assert set(rows) == {"<r>", "<v>"}
    assert [r.record_id for r in rows["<r>"].requests] == ["<q>"]
    assert [r.record_id for r in rows["<r>"].metadata] == ["<m>"]
    assert rows["<v>"].original is None and rows["<v>"].requests == []


def test_folder_of_plain_and_gzip_files(spark, folder):
    def record(name):
        return f"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <{name}>\r\nContent-Length: 1\r\n\r\nx\r\n\r\n".encode()

    os.makedirs(f"{folder}/both")
    for name, data in (("a.warc", record("a")), ("b.warc.gz", gzip.compress(record("b"))), ("_SUCCESS", b"")):
        with open(f"{folder}/both/{name}", "wb") as f:
            f.write(data)
    assert sorted(r.record_id for r in read_warc(spark, f"{folder}/both").collect()) == ["<a>", "<b>"]
