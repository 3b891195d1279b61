"""WARC derivatives: a metadata and a plain-text conversion record for every response record."""

import base64
import hashlib
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.html_blocks import parse

VERSION = "WARC/1.1"
#: Name space of the record ids that are derived from other ids.
_NAMES = uuid.NAMESPACE_URL
_SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_block_digest string, source_payload_digest string, record binary"
)
#: Source headers that the metadata record has under names of its own.
_CARRIED = {"warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-block-digest", "warc-payload-digest",
            "content-type", "content-length"}
_FIELDS = [part.split(" ")[0] for part in _SCHEMA.split(", ")]


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    """A record id that the parts decide, so a recomputed task gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, chr(0).join(parts))}>"


def serialized(headers: Mapping[str, str | None], block: bytes) -> bytes:
    """One record: named headers that have a value, a blank line, the block and two line ends."""
    lines = [f"{name}: {' '.join(value.split())}" for name, value in headers.items() if value is not None]
    return "\r\n".join([VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def _headers(text: str) -> list[tuple[str, str]]:
    """Header lines in their order, names in lower case; a line that starts with white space goes on with the one before."""
    found: list[tuple[str, str]] = []
    for line in text.split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            name, value = found.pop()
            found.append((name, f"{value} {line.strip()}"))
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def _firsts(headers: list[tuple[str, str]]) -> dict[str, str]:
    """The first value of each name."""
    return dict(reversed(headers))


def read_record(record: bytes | None) -> tuple[list[tuple[str, str]], bytes] | None:
    """(headers, block) of a record, or None if it isn't a whole one."""
    head, blank, rest = (record or b"").partition(b"\r\n\r\n")
    text = head.decode("utf-8", "replace")
    if not blank or not text.startswith("WARC/"):
        return None
    headers = _headers(text.partition("\r\n")[2])
    size = _firsts(headers).get("content-length", "")
    if not size.isdecimal() or int(size) > len(rest):
        return None
    return headers, rest[: int(size)]


def _charset(content_type: str) -> str:
    name = content_type.lower().partition("charset=")[2].partition(";")[0].strip(" \"'") or "utf-8"
    try:
        "".encode(name)
    except LookupError:
        return "utf-8"
    return name


def derivatives(record: bytes | None) -> list[dict]:
    """The records derived from a response: metadata, and for HTML and plain text a conversion.

    Both name the response in WARC-Refers-To and repeat its target URI and date. The metadata block keeps the
    response's digests, computed if its headers have none, all its other headers, and its HTTP status and headers, each
    in their order and repeated ones as often as they are there. The conversion is the text
    of all blocks of the page, one per line. Anything but a whole response record gives none.
    """
    read = read_record(record)
    if read is None or _firsts(read[0]).get("warc-type") != "response":
        return []
    every, block = read
    headers = _firsts(every)
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, lines = head.decode("latin-1").partition("\r\n")
    http = _headers(lines)
    kind = _firsts(http).get("content-type", "application/octet-stream")
    source = headers.get("warc-record-id") or record_id("response", digest(block))
    uri, date = headers.get("warc-target-uri"), headers.get("warc-date")
    own_digest = headers.get("warc-block-digest") or digest(block)
    payload_digest = headers.get("warc-payload-digest") or digest(payload)
    text = None
    fields = [
        ("source-block-digest", own_digest),
        ("source-payload-digest", payload_digest),
        ("source-content-length", str(len(block))),
        ("payload-length", str(len(payload))),
        ("http-status", status),
        *((f"source-{name}", value) for name, value in every if name not in _CARRIED),
        *((f"http-{name}", value) for name, value in http),
    ]
    if "html" in kind.lower():
        page = parse(payload.decode(_charset(kind), "replace"))
        text = "\n".join(b.text for b in page.blocks)
        fields.append(("title", page.title))
    elif kind.lower().startswith("text/plain"):
        text = payload.decode(_charset(kind), "replace")
    blocks = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode())]
    if text is not None:
        blocks.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    out = []
    for name, content_type, content in blocks:
        own, its = record_id(name, source), digest(content)
        written = serialized(
            {
                "WARC-Type": name,
                "WARC-Record-ID": own,
                "WARC-Refers-To": source,
                "WARC-Target-URI": uri,
                "WARC-Date": date,
                "WARC-Block-Digest": its,
                "Content-Type": content_type,
                "Content-Length": str(len(content)),
            },
            content,
        )
        values = (name, own, source, uri, date, content_type, len(content), its, own_digest, payload_digest, written)
        out.append(dict(zip(_FIELDS, values, strict=True)))
    return out


def response(uri: str | None, html: str | None, key: str, date: str) -> bytes:
    """A response record of a page: the HTTP answer with the page as its payload."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        + payload
    )
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id("page", key, uri or ""),
        "WARC-Target-URI": uri,
        "WARC-Date": date,
        "WARC-Block-Digest": digest(block),
        "WARC-Payload-Digest": digest(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return serialized(headers, block)


def response_records(pages: DataFrame, id_column: str, url: str, html: str, date: str) -> DataFrame:
    """(id, record) for every page. A null URL has no WARC-Target-URI, a null page an empty payload.

    Repeated rows give equal records with equal ids.
    """

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, urls, sources = (batch.column(i).to_pylist() for i in range(3))
            records = [response(u, h, str(k), date) for k, u, h in zip(keys, urls, sources, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], names=[id_column, "record"])

    rows = pages.select(id_column, url, html)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(built, f"`{id_column}` {kind}, record binary")


def derive(records: DataFrame, id_column: str, record: str = "record") -> DataFrame:
    """The derivatives of the response records in column `record`, one row each, beside the row's id.

    Rows whose record is null, cut off or no response give none; an empty table gives none. Only the two columns are
    read.
    """
    rows = records.select(id_column, record)
    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, *_FIELDS]

    def derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, d) for i, r in enumerate(batch.column(1).to_pylist()) for d in derivatives(r)]
            own = batch.column(0).take(pa.array([i for i, _ in found], pa.int64()))
            types = {"content_length": pa.int64(), "record": pa.binary()}
            columns = [pa.array([d[f] for _, d in found], types.get(f, pa.string())) for f in _FIELDS]
            yield pa.RecordBatch.from_arrays([own, *columns], names=names)

    return rows.mapInArrow(derived, f"`{id_column}` {kind}, {_SCHEMA}")


def write_files(derived: DataFrame, folder: str) -> None:
    """Writes the records as gzipped WARC files below `folder`, one per partition.

    Records are text in UTF-8 that ends in two line ends, which is what the writer puts between rows.
    """
    body = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string").alias("value")
    derived.select(body).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
