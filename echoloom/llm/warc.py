"""WARC records, and the builder of derivative records.

From each response record two linked records are made: a metadata record (a JSON envelope of the
source's headers, title, metas and links) and a conversion record (the plain text).  Both refer to
the response by WARC-Refers-To, and keep its target, date, and digests; their own identifiers are
derived from the response's, so that a rebuild gives the same records.  Headers that stand several
times keep all their values.  A payload is unchunked, inflated and decoded by its declared character
set before it is read; digests are of the payload as it stands in the record.

Files are read as streams, record by record; a damaged record is passed over and counted.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.llm.bytehash import to_bytes
from echoloom.llm.page_text import lines_of

VERSION = b"WARC/1.0"
#: The date of responses made from a table of pages, which has none.
EPOCH = "1970-01-01T00:00:00Z"
DERIVED = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string,"
    " content_length long, block_digest string, source_payload_digest string, n_links long, block string"
)


class Record(NamedTuple):
    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_record(record: Record) -> bytes:
    """The bytes of a record; Content-Length is set from the block."""
    head = [(k, v) for k, v in record.headers if k.lower() != "content-length"]
    lines = [VERSION, *(f"{k}: {_one_line(v)}".encode("utf-8", "surrogatepass") for k, v in head), b"Content-Length: %d" % len(record.block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + record.block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


GZIP = b"\x1f\x8b\x08"
#: Bytes that are read of a file at once.
CHUNK = 1 << 20


class Inflated(io.RawIOBase):
    """The plain bytes of gzip members on end; what is damaged is left out up to the next member."""

    def __init__(self, source: BinaryIO) -> None:
        self.source, self.raw, self.ready, self.member, self.damaged = source, b"", b"", None, 0

    def readable(self) -> bool:
        return True

    def _more(self) -> bool:
        data = self.source.read(CHUNK)
        self.raw += data
        return bool(data)

    def _fill(self) -> bool:
        """Puts some plain bytes into `ready`; false at the end."""
        while not self.ready:
            if not self.raw and not self._more():
                return False
            if self.member is None:
                at = self.raw.find(GZIP)
                if at < 0:
                    self.damaged += bool(self.raw[:-2].strip(b"\x00"))
                    self.raw = self.raw[-2:]
                    if not self._more():
                        return False
                    continue
                self.damaged += at > 0
                self.raw, self.member = self.raw[at:], zlib.decompressobj(31)
            try:
                taken = self.raw
                self.raw = b""
                self.ready = self.member.decompress(taken)
                if self.member.eof:
                    self.raw, self.member = self.member.unused_data, None
            except zlib.error:
                self.damaged += 1
                self.raw, self.member = taken[1:], None
        return True

    def readinto(self, out) -> int:
        if not self._fill():
            return 0
        some = self.ready[: len(out)]
        out[: len(some)], self.ready = some, self.ready[len(some) :]
        return len(some)


class Records:
    """The records of a WARC stream, plain or gzipped; `broken` counts what was passed over."""

    def __init__(self, source: BinaryIO | bytes) -> None:
        source = io.BytesIO(source) if isinstance(source, bytes) else source
        peeked = source.read(3)
        source = _Joined(peeked, source)
        self.inflated = Inflated(source) if peeked == GZIP else None
        self.stream = io.BufferedReader(self.inflated or source, CHUNK)
        self.broken, self.back = 0, b""

    def _line(self) -> bytes:
        if self.back:
            line, end, self.back = self.back.partition(b"\n")
            return line + end if end else line + self.stream.readline()
        return self.stream.readline()

    def _take(self, size: int) -> bytes:
        some, self.back = self.back[:size], self.back[size:]
        return some + self.stream.read(size - len(some))

    def __iter__(self) -> Iterator[Record]:
        lost = False
        while line := self._line():
            if not line.startswith(b"WARC/"):
                if line.strip() and not lost:
                    self.broken, lost = self.broken + 1, True
                continue
            headers: list[tuple[str, str]] = []
            while (line := self._line()).strip():
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text[0] in " \t" and headers:  # a folded line
                    headers[-1] = (headers[-1][0], headers[-1][1] + " " + text.strip())
                else:
                    name, _, value = text.partition(":")
                    headers.append((name.strip(), value.strip()))
            size = next((int(v) for k, v in headers if k.lower() == "content-length" and v.isdigit()), None)
            if size is None:
                self.broken, lost = self.broken + 1, True
                continue
            block = self._take(size)
            after = self._take(4) if len(block) == size else b""
            if len(block) < size or after.strip(b"\r\n") and not after.startswith(b"\r\n\r\n"):
                # The record is cut short: what follows it may have been taken for its block.
                self.broken, lost = self.broken + 1, True
                self.back = block + after + self.back
                at = re.search(rb"(?=WARC/[0-9]\.[0-9]\r?\n)", self.back)
                self.back = self.back[at.end() :] if at else b""
                continue
            if not after.startswith(b"\r\n\r\n"):  # fewer line ends than there should be
                self.back = after + self.back
            lost = False
            yield Record(headers, block)
        if self.inflated is not None:
            self.broken += self.inflated.damaged


class _Joined(io.RawIOBase):
    """Bytes that were read ahead, and the stream that they came from."""

    def __init__(self, head: bytes, rest: BinaryIO) -> None:
        self.head, self.rest = head, rest

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        some = self.head[: len(out)]
        self.head = self.head[len(some) :]
        some = some or self.rest.read(len(out))
        out[: len(some)] = some
        return len(some)


def read_records(data: bytes) -> Iterator[Record]:
    """The records of a WARC file in memory."""
    return iter(Records(data))


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; without a head all is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, [(n.strip(), v.strip()) for n, _, v in (x.partition(":") for x in lines)], payload


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while (end := data.find(b"\r\n", at)) >= 0:
        try:
            size = int(data[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return data if not out else b"".join(out)  # it was not chunked, or is cut
        if size == 0:
            break
        out.append(data[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out) if out or data.startswith(b"0") else data


def _inflated(data: bytes, kinds: list[str]) -> bytes:
    for kind in reversed(kinds):
        for bits in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(kind, ()):
            try:
                data = zlib.decompressobj(bits).decompress(data)
                break
            except zlib.error:
                continue  # stored plain in spite of the header, or another variant
    return data


def values_of(headers: list[tuple[str, str]], name: str) -> list[str]:
    return [v for k, v in headers if k.lower() == name]


_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([^\s\"';/>]+)", re.I)


def text_of(payload: bytes, headers: list[tuple[str, str]]) -> str:
    """The payload as text: unchunked, inflated, and decoded as its headers, its marks or itself say."""
    if any("chunked" in v.lower() for v in values_of(headers, "transfer-encoding")):
        payload = _unchunked(payload)
    payload = _inflated(payload, [x.strip().lower() for v in values_of(headers, "content-encoding") for x in v.split(",")])
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if payload.startswith(mark):
            return payload[len(mark) :].decode(name, "replace")
    said = [m[1] for v in values_of(headers, "content-type") if (m := _CHARSET.search(v))]
    if not said and (inside := _CHARSET.search(payload[:4096].decode("iso-8859-1"))):
        said = [inside[1]]
    for name in said:
        try:
            name = codecs.lookup(name).name
            return payload.decode("cp1252" if name in ("iso8859-1", "ascii") else name, "replace")
        except (LookupError, ValueError):
            continue
    try:
        return payload.decode("utf-8")
    except UnicodeDecodeError:
        return payload.decode("cp1252", "replace")


def named_values(headers: list[tuple[str, str]]) -> dict[str, str | list[str]]:
    """Headers as a mapping; one that stands several times has the list of its values, in order."""
    out: dict[str, str | list[str]] = {}
    for name, value in headers:
        if name not in out:
            out[name] = value
        else:
            out[name] = [*out[name], value] if isinstance(out[name], list) else [out[name], value]
    return out


def response_of_page(page_id: int | None, url: str | None, page: str | None, date: str = EPOCH) -> Record:
    """The response record that a page would have come from."""
    payload = to_bytes(page)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\x1f{url}\x1f{digest(payload)}")
    return Record(
        [
            ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", url or ""),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
        ],
        block,
    )


_HREF = re.compile(r"<(a|area|link|img|script|iframe|form)\b[^>]*?\s(href|src|action)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_PAIR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def _linked(source: Record, kind: str, content_type: str, block: bytes) -> Record:
    own = source.get("WARC-Record-ID") or ""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{own}\x1f{kind}")
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Refers-To", own)]
    for header in ("WARC-Date", "WARC-Target-URI", "WARC-IP-Address", "WARC-Warcinfo-ID", "WARC-Identified-Payload-Type"):
        if source.get(header) is not None:
            headers.append((header, source.get(header)))
    for header in ("WARC-Payload-Digest", "WARC-Block-Digest"):
        if source.get(header) is not None:
            headers.append((header.replace("WARC-", "WARC-Refers-To-"), source.get(header)))
    return Record([*headers, ("Content-Type", content_type), ("WARC-Block-Digest", digest(block))], block)


def derive(source: Record) -> tuple[Record, Record, int]:
    """The metadata and the conversion record of a response, and how many links it has."""
    status, http, payload = split_http(source.block)
    page = text_of(payload, http)
    links = [{"path": f"{t.lower()}@/{a.lower()}", "url": html.unescape(x or y or z)} for t, a, x, y, z in _HREF.findall(page)]
    title = _TITLE.search(page)
    metas = [{k.lower(): html.unescape(x or y or z) for k, x, y, z in _PAIR.findall(m)} for m in _META.findall(page)]
    envelope = {
        "Envelope": {
            "WARC-Header-Metadata": named_values(source.headers),
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status,
                    "Headers": named_values(http),
                    "Entity-Length": len(payload),
                    "Entity-Digest": digest(payload),
                    "HTML-Metadata": {"Head": {"Title": " ".join(html.unescape(title[1]).split()) if title else None, "Metas": metas}, "Links": links},
                }
            },
        }
    }
    metadata = _linked(source, "metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace"))
    text = "\n".join(line for line, _ in lines_of(page))
    return metadata, _linked(source, "conversion", "text/plain", text.encode("utf-8", "replace")), len(links)


def _rows(page_id, source: Record) -> list[tuple]:
    metadata, conversion, links = derive(source)
    return [
        (
            page_id, r.get("WARC-Type"), r.get("WARC-Record-ID"), r.get("WARC-Refers-To"), r.get("WARC-Target-URI"), r.get("WARC-Date"), r.get("Content-Type"),
            len(r.block), r.get("WARC-Block-Digest"), source.get("WARC-Payload-Digest"), links, r.block.decode("utf-8"),
        )
        for r in (metadata, conversion)
    ]


_KINDS = {"long": pa.int64(), "string": pa.string()}
_FIELDS = [f.split() for f in DERIVED.split(",")]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _KINDS[kind]) for i, (_, kind) in enumerate(_FIELDS)], names=[n for n, _ in _FIELDS])


#: Derived rows, and characters of their blocks, that are held at once.
ROWS, CHARACTERS = 512, 8 << 20


def _derived(sources) -> Iterator[pa.RecordBatch]:
    """(page_id, response) pairs to batches of derived rows."""
    held: list[tuple] = []
    for page_id, source in sources:
        held += _rows(page_id, source)
        if len(held) >= ROWS or sum(len(r[-1]) for r in held[-2:]) * len(held) > CHARACTERS:
            yield _table(held)
            held = []
    if held:
        yield _table(held)


def derivatives_of_pages(pages: DataFrame) -> DataFrame:
    """The metadata and conversion records of every row of (page_id, url, html), two rows each.

    Null html is an empty payload, a null url an empty target, a null id stays null; repeated rows
    each get theirs, with the same identifiers.  Other columns are not looked at; an empty table has
    no records.  One narrow pass; `write_record` makes files of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((i.as_py(), u.as_py(), h.as_py()) for i, u, h in zip(*batch.columns))
            yield from _derived((i, response_of_page(i, u, h)) for i, u, h in rows)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, DERIVED)


RECORDS = "path string, record_type string, record_id string, target_uri string, headers array<struct<name:string,value:string>>, block binary, broken long"
_HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(path, record_type, record_id, target_uri, headers, block, broken) of the WARC files under a path.

    Files are listed by Spark and streamed by the tasks, a record at a time.  A file in which records
    had to be passed over has one more row, of the record_type "unreadable", with their number.
    """

    def rows_of(name: str) -> Iterator[tuple]:
        place, inside = pyarrow.fs.FileSystem.from_uri(name)
        with place.open_input_stream(inside, compression=None, buffer_size=CHUNK) as source:
            records = Records(source)
            for r in records:
                yield name, r.get("WARC-Type"), r.get("WARC-Record-ID"), r.get("WARC-Target-URI"), [{"name": k, "value": v} for k, v in r.headers], r.block, None
            if records.broken:
                yield name, "unreadable", None, None, None, None, records.broken

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [_HEADERS, pa.binary(), pa.int64()]
        names = ["path", "record_type", "record_id", "target_uri", "headers", "block", "broken"]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows_of(re.sub(r"^file:/(?!/)", "file:///", name)):
                    held.append(row)
                    size += len(row[5] or b"")
                    if len(held) >= ROWS or size >= CHARACTERS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    files = spark.read.format("binaryFile").load(path).select("path")  # the content is not read here
    return files.repartition(max(1, min(files.count(), 1 << 16)), "path").mapInArrow(run, RECORDS)


def derivatives_of_records(records: DataFrame) -> DataFrame:
    """As derivatives_of_pages, from the response records that `read_warc` returns; page_id is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*batch.columns)
            yield from _derived((None, Record([(h["name"], h["value"]) for h in headers.as_py() or []], block.as_py() or b"")) for headers, block in rows)

    return records.where("record_type = 'response'").select("headers", "block").mapInArrow(run, DERIVED)
