"""WARC derivatives: metadata and plain-text conversion records made from response records.

A record here is its bytes without the two line ends that follow it in a file; those are
the line ends of Spark's text writer, so files of records need no writer of their own.
"""

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

END = "\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: name space of URLs in RFC 4122

#: Headers of a response that its derivatives keep as they are.
KEPT = ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID")

_GONE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_HEAD = re.compile(r"<head\b.*?</head\s*>", re.S | re.I)
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main"
    r"|nav|ol|option|p|pre|section|table|td|th|tr|ul)\b[^>]*>", re.I,
)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>?")
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, *parts: bytes) -> str:
    """The same record gets the same id in every run, so a task that is run again changes nothing."""
    named = hashlib.sha256(kind.encode())
    for part in parts:
        named.update(len(part).to_bytes(8, "big") + part)
    return f"<urn:uuid:{uuid.uuid5(_SPACE, named.hexdigest())}>"


def make(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def split(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of a record; a ValueError says what is wrong with it."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no record header")
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("a header without a colon")
        headers.append((name.strip(), value.strip()))
    size = value_of(headers, "Content-Length")
    if not (size or "").isdigit() or int(size) > len(rest):
        raise ValueError("wrong length")
    return headers, rest[: int(size)]


def value_of(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def plain_text(page: str) -> str:
    """Text of a page: no scripts, styles, comments or head; a line per block; single spaces."""
    body = _TAG.sub("", _BLOCK.sub("\n", _HEAD.sub("", _GONE.sub("", page))))
    lines = (" ".join(line.split()) for line in html.unescape(body).split("\n"))
    return "\n".join(line for line in lines if line)


def _one_line(text: str) -> str:
    return " ".join(text.split())


def derive_record(record: bytes) -> tuple[dict | None, dict | None, str | None]:
    """(metadata, conversion, reason why there are none) of one response record."""
    try:
        headers, block = split(record)
    except ValueError as wrong:
        return None, None, str(wrong)
    if (value_of(headers, "WARC-Type") or "").lower() != "response":
        return None, None, "not a response"
    source = value_of(headers, "WARC-Record-ID")
    if not source:
        return None, None, "no record id"
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        http, payload = b"", block
    http_lines = http.decode("latin-1").split("\r\n")
    http_headers = [tuple(x.strip() for x in line.split(":", 1)) for line in http_lines[1:] if ":" in line]
    content_type = value_of(http_headers, "Content-Type") or ""
    named = _CHARSET.search(content_type) or _CHARSET.search(payload[:1024].decode("latin-1"))
    try:
        page = payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    said = value_of(headers, "WARC-Payload-Digest")
    actual = digest(payload)
    body = plain_text(page).encode("utf-8", "replace")
    kept = [(k, v) for k, v in headers if k in KEPT]
    conversion_id = record_id("conversion", source.encode(), body)
    links = [html.unescape(next(x for x in m if x is not None and x != "") if any(m) else "") for m in _LINK.findall(page)]
    title, lang = _TITLE.search(page), _LANG.search(page)
    fields = [
        ("title", _one_line(html.unescape(title[1])) if title else ""),
        ("language", lang[1] if lang else ""),
        ("http-status", http_lines[0].split(" ")[1] if len(http_lines[0].split(" ")) > 1 else ""),
        ("http-content-type", content_type),
        ("conversion", conversion_id),
        ("source-payload-digest", said or actual),
        ("source-digest-checked", "none" if said is None else str(said == actual).lower()),
        *(("outlink", _one_line(x)) for x in links),
        *((f"source-header-{k}", _one_line(v)) for k, v in headers),
    ]
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    metadata_id = record_id("metadata", source.encode(), about)
    made = []
    for kind, own, block_type, content in (
        ("metadata", metadata_id, "application/warc-fields", about),
        ("conversion", conversion_id, "text/plain; charset=utf-8", body),
    ):
        head = [
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), *kept,
            ("WARC-Block-Digest", digest(content)), ("Content-Type", block_type),
        ]
        if kind == "conversion":
            head.append(("WARC-Concurrent-To", metadata_id))
        made.append(
            {
                "record_type": kind, "record_id": own, "refers_to": source,
                "target_uri": value_of(headers, "WARC-Target-URI"), "warc_date": value_of(headers, "WARC-Date"),
                "content_type": block_type, "content_length": len(content), "block_digest": digest(content),
                "source_digest": said or actual, "source_digest_ok": None if said is None else said == actual,
                "record": make(head, content),
            }
        )
    return made[0], made[1], None


_COLUMNS = pa.schema(
    [
        ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
        ("target_uri", pa.string()), ("warc_date", pa.string()), ("content_type", pa.string()),
        ("content_length", pa.int64()), ("block_digest", pa.string()), ("source_digest", pa.string()),
        ("source_digest_ok", pa.bool_()), ("record", pa.binary()), ("reason", pa.string()),
    ]
)
_SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_digest string, source_digest_ok boolean, record binary, reason string"
)


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows, source = [], []
            for k, record in enumerate(part.column(batch.num_columns - 1)):
                metadata, conversion, reason = derive_record(record.as_py() or b"")
                made = [metadata, conversion] if reason is None else [{"record_type": "rejected", "reason": reason}]
                rows += made
                source += [k] * len(made)
            keys = part.select(list(range(batch.num_columns - 1))).take(pa.array(source, pa.int64()))
            table = pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)
            yield pa.RecordBatch.from_arrays([*keys.columns, *table.columns], names=[*keys.schema.names, *_COLUMNS.names])


def derivatives(responses: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response record: its metadata record and its plain-text conversion record.

    Both refer to the response's id, keep its target, date and address, and carry digests of their own block;
    the metadata names the conversion, the page's title, language and links, all headers of the source
    and whether the source's payload digest is right. A record that cannot be read, null included, gives
    one row of type ``rejected`` with the reason. Repeated records give equal rows with equal ids; a page without text
    gives an empty conversion. Columns in ``keep`` are passed on under their names, others are ignored.
    """
    kept = [f"_{k}" for k in range(len(keep))]
    frame = responses.select(*[F.col(c).alias(n) for c, n in zip(keep, kept)], F.col(record).alias("source_record"))
    kinds = "".join(f"{n} {frame.schema[n].dataType.simpleString()}, " for n in kept)
    out = frame.mapInArrow(_derive, kinds + _SCHEMA)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, kept)], *_COLUMNS.names)


def _respond(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, url, page in zip(*(batch.column(k) for k in range(3))):
                key, url, payload = str(key.as_py()), _one_line(url.as_py() or ""), (page.as_py() or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                block = http.encode() + payload
                made.append(
                    make(
                        [
                            ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key.encode(), url.encode(), payload)),
                            ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Block-Digest", digest(block)),
                            ("WARC-Payload-Digest", digest(payload)), ("Content-Type", "application/http; msgtype=response"),
                        ],
                        block,
                    )
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["page_id", "record"])

    return run


def responses_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): a response record for every page; null pages have an empty payload."""
    kind = pages.schema[page_id].dataType.simpleString()
    frame = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
    return frame.mapInArrow(_respond(date), f"page_id {kind}, record binary")


def write_records(records: DataFrame, folder: str, record: str = "record", file_records: int = 20_000) -> None:
    """Records as WARC files of at most ``file_records`` records; null records are left out."""
    rows = records.where(F.col(record).isNotNull()).select(F.col(record).cast("string"))
    rows.write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            data, at, out, places = content.as_buffer().to_pybytes(), 0, [], []
            while at < len(data):
                head = data.find(b"\r\n\r\n", at)
                size = re.search(rb"(?im)^content-length:\s*(\d+)", data[at : max(head, at)])
                if head < 0 or not size:
                    raise ValueError(f"no record at byte {at} of {path.as_py()}")
                stop = head + 4 + int(size[1])
                out.append(data[at:stop])
                places.append(at)
                at = stop + 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([path.as_py()] * len(out)), pa.array(places, pa.int64()), pa.array(out, pa.binary())],
                names=["path", "at", "record"],
            )


def read_records(spark, folder: str) -> DataFrame:
    """(path, at, record) of WARC files without compression, of less than 2 GB each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(_read, "path string, at long, record binary")
