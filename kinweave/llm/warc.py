"""Legacy ARC archives to WARC, and back to rows.

ARC files are parsed by their version's header line and the declared lengths (a payload may
hold anything). Each record becomes a WARC record with an identifier, date, type and digests
made from it; large payloads that several records share are written once and the others refer to
them. Archives are gzip files cut by their bytes (``FILE_BYTES`` and the record that reaches it), written
and read by Spark, so that any file system Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.skew import spread_join
from kinweave.runtime import materialize, shared_path

#: Bytes, before compression, at which an archive file is closed.
FILE_BYTES = 8 << 20
#: Bytes of the table of shared payloads up to which it is broadcast; an entry takes ``ENTRY`` bytes.
SHARED_BYTES, ENTRY = 16 << 20, 44
#: Field names of a record's header line, by the version block's version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
NAMESPACE = uuid.UUID("5b1a0c1e-6a55-5c5d-9f0f-0d5f0a7d6c11")
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def _quoted(url: str | None) -> str:
    return _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", version: int = 1,
              date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> None:
    """Write rows as ARC files: HTTP responses whose body is the column in UTF-8 (null: empty)."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = f"{version} 0 kinweave\n{' '.join(ARC_FIELDS[version])}\n".encode()
        tail = b"200 - - 0 -" if version == 2 else b""
        head = b"filedesc://pages.arc 0.0.0.0 %s text/plain " % date.encode()
        opening = head + (tail + b" " if tail else b"") + b"%d\n%s\n" % (len(block), block)

        def records() -> Iterator[bytes]:
            for b in batches:
                for i, url, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(body)
                    http += (b"X-Page-Id: %d\r\n" % i if i is not None else b"") + b"\r\n"
                    line = b" ".join([_quoted(url).encode(), b"0.0.0.0", date.encode(), b"text/html", *([tail] if tail else []), b"%d" % (len(http) + len(body))])
                    yield line + b"\n" + http + body

        for archive in _archives(records(), b"\n", file_bytes):  # each file begins with the version block
            yield pa.record_batch([pa.array([opening + archive], pa.binary())], ["value"])

    _write(rows.mapInArrow(run, "value binary"), path, "\n")


def _archives(records: Iterator[bytes], sep: bytes, file_bytes: int) -> Iterator[bytes]:
    """Records joined to archives, each closed by the record that reaches ``file_bytes``."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= file_bytes:
            yield sep.join(held)
            held, size = [], 0
    if held:
        yield sep.join(held)


def _write(archives: DataFrame, path: str, end: str) -> None:
    """A gzip file of each row of ``value``, at the fastest level: compressing takes most of the time, and the best level saves an eighth."""
    text = archives.select(F.col("value").cast("string"))
    text.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)


def unpack(content: bytes) -> bytes:
    """A gzip file, of one or many members; anything else as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        one = zlib.decompressobj(31)
        out.append(one.decompress(content) + one.flush())
        content = one.unused_data
    return b"".join(out)


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes
    offset: int


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block. Raises ValueError where a header or length is wrong."""
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        words = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r").split(" ")
        if end < 0 or not words[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {at}")
        block = data[end + 1 : end + 1 + int(words[-1])]
        if len(block) < int(words[-1]):
            raise ValueError(f"the record at byte {at} declares {words[-1]} bytes, {len(block)} follow")
        if fields is None:
            if not words[0].startswith("filedesc:"):
                raise ValueError("no version block")
            lines = block.decode("utf-8", "replace").splitlines()
            version = int(lines[0].split(" ")[0])
            fields = tuple(lines[1].split(" ")) if len(lines) > 1 and lines[1] else ARC_FIELDS[version]
            if fields != ARC_FIELDS.get(version):
                raise ValueError(f"version {version} with fields {fields}")
        elif len(words) < len(fields):
            raise ValueError(f"{len(words)} fields at byte {at}, not {len(fields)}")
        else:  # a URL with blanks makes more words than fields
            extra = len(words) - len(fields) + 1
            yield ArcRecord(dict(zip(fields, [" ".join(words[:extra]), *words[extra:]], strict=True)), block, at)
        at = end + 1 + len(block)


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """(header with its blank line, body); no header if the block isn't an HTTP response."""
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if block.startswith(b"HTTP/") and end >= 0 else (b"", block)


def http_field(header: bytes, name: str) -> str | None:
    for line in header.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def record_key(path: str, offset: int, url: str, digest: str) -> bytes:
    """What identifies a record: 16 bytes from its place in its archive, its URL and its payload; the same whenever the archive is converted."""
    return uuid.uuid5(NAMESPACE, f"{path.rpartition('/')[2]} {offset} {url} {digest}").bytes


def record_id(key: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=key)}>"


def _base32(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def warc_record(record: ArcRecord, key: bytes, digest: str, refers_to: tuple[int, bytes] | None = None) -> bytes:
    """A WARC record without the two line ends that close it: a response, or a revisit of the page and record ``refers_to``."""
    header, body = http_parts(record.block)
    url, d = record.fields["URL"], record.fields["Archive-date"]
    block = record.block if refers_to is None else header
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(key)), ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
        ("WARC-Target-URI", url), ("WARC-IP-Address", record.fields["IP-address"]), ("WARC-Payload-Digest", _base32(digest)),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest()))]
    if refers_to is not None:
        page, first = refers_to
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(first)),
                  ("X-Refers-To-Page", str(page)), ("X-Payload-Length", str(len(body)))]
    lines += [("Content-Type", "application/http; msgtype=response" if header else record.fields["Content-type"]), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines) + b"\r\n" + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} declares {size} bytes, which don't end there")
        yield fields, block
        at = end + 8 + size


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def _contents(b: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Paths and contents, one archive at a time."""
    return ((path.as_py(), content.as_py()) for path, content in zip(b.column(0), b.column(1), strict=True))


def _page(header: bytes) -> int | None:
    found = http_field(header, "X-Page-Id")
    return int(found) if found is not None else None


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 1000, shared_bytes: int = SHARED_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Convert ARC files to WARC files.

    Of records with equal payloads of at least ``least`` bytes that with the largest page number
    is a response and the others, where theirs is smaller, are revisits of it; records of equal
    number are all responses, as are those without a number. Shorter payloads are all responses.

    Numbers, keys and digests are shuffled. The payloads found under several numbers are a table, each with the page and record to refer
    to; up to ``shared_bytes`` it is broadcast and no archive moves. A larger one is cut by archive, and each archive is
    shuffled to the list of its revisits.
    """

    def parsed(path: str, content: bytes) -> Iterator[tuple[ArcRecord, int | None, bytes, str]]:
        for r in parse_arc(unpack(content)):
            header, body = http_parts(r.block)
            yield r, _page(header), body, path

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in _contents(b):
                rows = [(path, r.offset, page, (d := hashlib.sha1(body)).digest(), record_key(path, r.offset, r.fields["URL"], d.hexdigest()))
                        for r, page, body, path in parsed(path, content) if len(body) >= least and page is not None]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["path", "at", "page", "digest", "key"])

    def write(refers):
        """``refers``: from a batch and a row of it to the function that names what a record refers to."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def records() -> Iterator[bytes]:
                for b in batches:
                    for i, (path, content) in enumerate(_contents(b)):
                        found = refers(b, i)
                        for r, page, body, _ in parsed(path, content):
                            digest = hashlib.sha1(body)
                            to = found(r.offset, page, digest.digest()) if len(body) >= least and page is not None else None
                            yield warc_record(r, record_key(path, r.offset, r.fields["URL"], digest.hexdigest()), digest.hexdigest(), to)

            for archive in _archives(records(), b"\r\n\r\n", file_bytes):
                yield pa.record_batch([pa.array([archive], pa.binary())], ["value"])

        return run

    arcs = _files(spark, arc_path)
    seen = materialize(arcs.mapInArrow(keys, "path string, at long, page long, digest binary, key binary"), "arc-keys")
    shared = seen.groupBy("digest").agg(F.max(F.struct("page", "key")).alias("m"), F.min("page").alias("low")).where("low < m.page").select("digest", "m.page", "m.key")
    shared = materialize(shared, "shared-payloads")
    if shared.count() * ENTRY <= shared_bytes:
        table = shared.toArrow()
        known = spark.sparkContext.broadcast(dict(zip(table.column("digest").to_pylist(), zip(table.column("page").to_pylist(), table.column("key").to_pylist(), strict=True), strict=True)))

        def by_digest(b: pa.RecordBatch, i: int):
            def found(at: int, page: int, digest: bytes):
                to = known.value.get(digest)
                return to if to is not None and page < to[0] else None

            return found

        archives = arcs.mapInArrow(write(by_digest), "value binary")
    else:
        def by_place(b: pa.RecordBatch, i: int):
            rows = b.column(2)[i].as_py() or []
            listed = {x["at"]: (x["page"], x["key"]) for x in rows}
            return lambda at, page, digest: listed.get(at)

        first = shared.select("digest", F.col("page").alias("to_page"), F.col("key").alias("to_key"))
        again = spread_join(seen, first, ["digest"], ["path", "at"]).where("page < to_page")
        listed = again.groupBy("path").agg(F.collect_list(F.struct("at", F.col("to_page").alias("page"), F.col("to_key").alias("key"))).alias("revisits"))  # of one archive
        archives = arcs.join(listed, "path", "left").select("path", "content", "revisits").mapInArrow(write(by_place), "value binary")
    _write(archives, warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """``(page_id, target_uri, date, record_id, record_type, payload_bytes, payload_digest, refers_to[, block])`` of WARC files.

    The digest is bare lower-case hex; length and digest are those of the full payload, also of revisits: those of
    ``convert`` record the length, for others it is that of the HTTP header, or null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "target_uri", "date", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "block"]
        kinds = (pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.binary())
        for b in batches:
            for _, content in _contents(b):
                out: list[tuple] = []
                for f, block in parse_warc(unpack(content)):
                    header, body = http_parts(block)
                    revisit = f["warc-type"] == "revisit"
                    told = f.get("x-payload-length") or http_field(header, "Content-Length")
                    size = (int(told) if told and told.isdigit() else None) if revisit else len(body)
                    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                    out.append((_page(header), f["warc-target-uri"], f["warc-date"], f["warc-record-id"], f["warc-type"], size, digest, int(f["x-refers-to-page"]) if "x-refers-to-page" in f else None, block if blocks else None))
                columns = list(zip(*out, strict=True)) or [()] * len(names)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    schema = "page_id long, target_uri string, date string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long, block binary"
    rows = _files(spark, path).mapInArrow(run, schema)
    return rows if blocks else rows.drop("block")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", version: int = 1) -> DataFrame:
    """Pages written as ARC files, converted to WARC files in the shared folder and read back (see ``read_warc``).

    A null body is an empty payload; null or odd URLs are written quoted (``urn:none`` for null); rows
    with a null id come back with a null id. Every row is a record, repeated rows too. Other
    columns are not read. No rows give no rows.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, body_col, version)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
