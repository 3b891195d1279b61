import gzip
import glob
import hashlib
import base64

from tideline.llm import warc
from tideline.llm.queries import CRAWL_DATE, op8_warc


def read_all(data):
    """A plain reader: header lines, block of Content-Length bytes, two line ends."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines[1:])
        n = int(headers["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
        data = rest[n + 4 :]
    return out


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def test_linked_records(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    responses = warc.response_records(pages, "page_id", "url", "html", CRAWL_DATE)
    source = {r["page_id"]: read_all(bytes(r["record"]))[0] for r in responses.collect()}
    rows = warc.derive(responses, "page_id").collect()
    assert len(rows) == 2 * len(source)
    plain = {r["page_id"]: r for r in pages.collect()}
    for r in rows:
        ((headers, block),) = read_all(bytes(r["record"]))
        original, body = source[r["page_id"]]
        payload = plain[r["page_id"]]["html"].encode()
        assert headers["WARC-Refers-To"] == original["WARC-Record-ID"] == r["refers_to"]
        assert headers["WARC-Target-URI"] == plain[r["page_id"]]["url"]
        assert headers["WARC-Block-Digest"] == sha1(block) == r["block_digest"]
        assert (r["source_block_digest"], r["source_payload_digest"]) == (sha1(body), sha1(payload))
        if r["record_type"] == "metadata":
            fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line)
            assert fields["source-payload-digest"] == sha1(payload)
            assert fields["http-content-type"] == "text/html; charset=utf-8"
        else:
            assert b"<p>" not in block and b"track(" not in block
    assert len({r["record_id"] for r in rows}) == len(rows)


def test_files_read_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/ü", "<p>x\n y</p>é"), (2, None, None), (3, "u\r\nX: y", "")], "p long, u string, h string")
    derived = warc.derive(warc.response_records(pages, "p", "u", "h", CRAWL_DATE), "p")
    warc.write_files(derived, str(tmp_path / "w"))
    found = [x for f in glob.glob(f"{tmp_path}/w/*.gz") for x in read_all(gzip.open(f).read())]
    assert len(found) == 6
    assert sorted(b for h, b in found if h["WARC-Type"] == "conversion") == [b"", b"", "x y\né".encode()]
    assert sum("WARC-Target-URI" in h for h, _ in found) == 4
    assert all("X" not in h for h, _ in found)


def test_odd_records():
    html = warc.response("http://a", "<title>t</title>b", "1", CRAWL_DATE)
    assert [d["record_type"] for d in warc.derivatives(html)] == ["metadata", "conversion"]
    for record in (None, b"", b"WARC/1.1", html[:-30], html.replace(b"Type: response", b"Type: request"), b"x" * 100):
        assert warc.derivatives(record) == []
    block = b"HTTP/1.1 404 No\r\nContent-Type: text/plain;\r\n charset=latin-1\r\n\r\n\xe9 <b>"
    given = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Payload-Digest": "sha1:GIVEN", "Content-Length": str(len(block))}
    meta, text = warc.derivatives(warc.serialized(given, block))
    assert text["record"].endswith("é <b>\r\n\r\n".encode()) and text["refers_to"] == "<urn:x>"
    assert meta["source_payload_digest"] == "sha1:GIVEN" and b"http-status: HTTP/1.1 404 No" in meta["record"]
    binary = warc.serialized(given | {"Content-Length": "24"}, b"HTTP/1.1 200 OK\r\n\r\n\0\1\2\3\4")
    assert [d["record_type"] for d in warc.derivatives(binary)] == ["metadata"]
    bad = block.replace(b"latin-1", b"no-such")
    assert len(warc.derivatives(warc.serialized(given | {"Content-Length": str(len(bad))}, bad))) == 2


def test_query_and_empty_table(spark):
    found = op8_warc(spark, "/root/testdata/sf0.001")
    assert "record" not in found.columns and found.filter("record_sha256 is null").count() == 0
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert found.count() == 2 * pages.count()
    assert warc.derive(warc.response_records(pages.limit(0), "page_id", "url", "html", CRAWL_DATE), "page_id").collect() == []
    twice = warc.derive(warc.response_records(pages.limit(1).union(pages.limit(1)), "page_id", "url", "html", CRAWL_DATE), "page_id")
    assert twice.count() == 4 and twice.distinct().count() == 2


def test_headers_are_preserved():
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nContent-Type: text/plain\r\nSet-Cookie: b=2;\r\n path=/\r\n\r\nx"
    lines = ["WARC/1.1", "WARC-Type: response", "WARC-Record-ID: <urn:x>", "WARC-IP-Address: 1.2.3.4", "WARC-Concurrent-To: <urn:y>",
             "WARC-Concurrent-To: <urn:z>", f"Content-Length: {len(block)}", "", ""]
    meta, _ = warc.derivatives("\r\n".join(lines).encode() + block + b"\r\n\r\n")
    fields = meta["record"].partition(b"\r\n\r\n")[2].decode().split("\r\n")
    kept = [f for f in fields if f.startswith(("http-set-cookie", "source-warc"))]
    assert kept == ["source-warc-ip-address: 1.2.3.4", "source-warc-concurrent-to: <urn:y>", "source-warc-concurrent-to: <urn:z>",
                    "http-set-cookie: a=1", "http-set-cookie: b=2; path=/"]
