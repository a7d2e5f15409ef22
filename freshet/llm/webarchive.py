"""Converter from the legacy ARC format to WARC, with payload deduplication.

ARC: a version block names the version (1 or 2) and the fields of all later header lines; each record is such a line,
whose last field declares the length, and so many bytes. WARC: for each ARC record the converter makes an identifier
(name-based UUID of archive name and record number), an ISO timestamp from the 14-digit date, a type (``filedesc`` ->
warcinfo, HTTP answers -> response, all else -> resource) and SHA-256 digests of block and payload. Of records with equal
payloads of ``LEAST_BYTES`` or more, one stays a response; the others become revisits that refer to it and hold the
HTTP header only.

Archives are compressed record by record and closed at ``FILE_BYTES``, so that a task reads and writes bounded
files as streams. A file gets its name when it is whole and the name depends on the partition only.

Defined results: null html counts as an empty payload; null or blank URLs are written as ``-``, blanks within URLs are escaped; a null
page_id is written without the header that carries it and is a response only if no other page has its payload; of
rows with equal page_id and payload one is the response and the others revisit it; empty tables give no files and no
rows; a payload of any length is one record; extra columns are ignored. A damaged length or header raises ValueError.
"""

from __future__ import annotations

import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import shared_dir, stored, table
from freshet.llm.files import reading, writing

FILE_BYTES = 32 << 20
LEAST_BYTES = 100
LEVEL = 1  # of compression
#: Fixed values of the ARC format: the fields of a header line by version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
#: Fixed value of the WARC format.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER, LENGTH_HEADER, REFERS_HEADER = "X-Page-Id", "X-Payload-Length", "X-Refers-To-Page-Id"


class ArcRecord(NamedTuple):
    fields: dict[str, str]
    block: bytes


# ---- ARC


def escaped(url: str | None) -> str:
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]|") if url and url.strip() else "-"


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n".encode()
    own = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain", "Archive-length": str(len(body))}
    return f"{' '.join(own.get(f, '-') for f in ARC_FIELDS[version])}\n".encode() + body + b"\n"


def arc_record(version: int, block: bytes, **fields: str) -> bytes:
    own = {k.replace("_", "-"): v for k, v in fields.items()} | {"Archive-length": str(len(block))}
    return f"{' '.join(own.get(f, '-') for f in ARC_FIELDS[version])}\n".encode() + block + b"\n"


def read_arc(f) -> Iterator[ArcRecord]:
    """Records of an uncompressed stream, the version block included."""
    fields: tuple[str, ...] | None = None
    while line := f.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8").rstrip("\r\n")
        if fields is None and not text.startswith("filedesc://"):
            raise ValueError("an ARC file begins with its version block")
        # blanks may stand in the URL, the first field, only
        parts = text.rsplit(" ", len(fields) - 1) if fields else text.split(" ")
        if fields and len(parts) != len(fields) or not parts[-1].isdigit():
            raise ValueError(f"damaged ARC header: {text[:200]}")
        length = int(parts[-1])
        block = f.read(length)
        if len(block) < length:
            raise ValueError("ARC record ends before its declared length")
        if fields is None:
            version, names = block.decode("utf-8").split("\n")[:2]
            if (known := int(version.split(" ")[0])) not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version: {version[:50]}")
            fields = tuple(names.split()) or ARC_FIELDS[known]
            if len(parts) != len(fields):
                raise ValueError("the version block doesn't have the fields that it declares")
        yield ArcRecord(dict(zip(fields, parts, strict=True)), block)


# ---- HTTP blocks


def http_block(page_id: int | None, payload: bytes) -> bytes:
    own = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}\r\n".encode() + payload


def http_parts(block: bytes) -> tuple[bytes, bytes, int | None]:
    """Header with its blank line, payload, page_id."""
    head, blank, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not blank:
        return b"", block, None
    page = next((x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(PAGE_HEADER.lower().encode() + b":")), None)
    return head + blank, payload, None if page is None else int(page)


# ---- WARC


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def timestamp(date: str) -> str:
    """ARC dates have 14 digits; older writers cut them short."""
    if not date.isdigit() or len(date) < 4:
        raise ValueError(f"damaged ARC date: {date[:50]}")
    d = date[:14] + "00000101000000"[len(date[:14]) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_type(record: ArcRecord) -> str:
    if record.fields["URL"].startswith("filedesc://"):
        return "warcinfo"
    return "response" if record.block.startswith(b"HTTP/") else "resource"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in (headers | {"Content-Length": str(len(block))}).items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def convert(record: ArcRecord, archive: str, number: int, refers: tuple[int | None, str, int] | None = None) -> bytes:
    """One ARC record as a WARC record. ``refers``: page_id, archive and number of the response to revisit."""
    kind, head, payload = warc_type(record), *http_parts(record.block)[:2]
    headers = {
        "WARC-Type": "revisit" if refers else kind,
        "WARC-Record-ID": record_id(archive, number),
        "WARC-Date": timestamp(record.fields["Archive-date"]),
        "WARC-Target-URI": record.fields["URL"],
        "WARC-IP-Address": record.fields["IP-address"],
        "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type": "application/http; msgtype=response" if kind == "response" else record.fields["Content-type"],
    }
    if kind == "warcinfo":
        headers["WARC-Filename"] = headers.pop("WARC-Target-URI").removeprefix("filedesc://")
        headers["Content-Type"] = "application/warc-fields"
        return warc_record(headers, f"software: converter\r\nformat: WARC File Format 1.1\r\noriginal-version: {record.block.split(b' ')[0].decode()}\r\n".encode())
    if refers:
        headers |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": record_id(*refers[1:]), LENGTH_HEADER: str(len(payload))}
        if refers[0] is not None:
            headers[REFERS_HEADER] = str(refers[0])
    block = head if refers else record.block
    headers["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(block).hexdigest()}"
    return warc_record(headers, block)


def read_warc(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed stream."""
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("damaged WARC record")
        headers = {}
        while (line := f.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name] = value.strip()
        block = f.read(int(headers["Content-Length"]))
        if len(block) < int(headers["Content-Length"]) or f.read(4) != b"\r\n\r\n":
            raise ValueError("WARC record ends before its declared length")
        yield headers, block


def member(data: bytes) -> bytes:
    """A record as a gzip member of its own; the header has no time, so that equal records give equal files."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ---- Spark


def write_arcs(pages: DataFrame, folder: str, date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes page_id, url, html as ARC archives, versions 1 and 2 in turn; one row an archive: archive, n_records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            archive, version, n, at = f"{folder}/part-{part:06d}-{seq:04d}.arc.gz", 1 + (part + seq) % 2, 0, 0
            with writing(archive) as f:
                f.write(member(arc_version_block(archive.rpartition("/")[2], version, date)))
                while row is not None and at < file_bytes:
                    page_id, url, html = row
                    block = http_block(page_id, (html or "").encode())
                    data = member(arc_record(version, block, URL=escaped(url), IP_address="0.0.0.0", Archive_date=date, Content_type="text/html", Result_code="200"))
                    f.write(data)
                    n, at, row = n + 1, at + len(data), next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([n], pa.int64())], names=["archive", "n_records"])
            seq += 1

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    return rows.mapInArrow(run, "archive string, n_records long")


@contextmanager
def _opened(archive: str) -> Iterator:
    with reading(archive) as f, gzip.GzipFile(fileobj=f, mode="rb") as plain:
        yield plain


def index_arcs(archives: DataFrame, tasks: int) -> DataFrame:
    """One row an ARC record: archive, number, page_id, payload_bytes, payload_digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in (a for b in batches for a in b.column(0).to_pylist()):
            rows = []
            with _opened(archive) as f:
                for number, record in enumerate(read_arc(f)):
                    if warc_type(record) != "warcinfo":
                        _, payload, page_id = http_parts(record.block)
                        rows.append((archive, number, page_id, len(payload), hashlib.sha256(payload).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["archive", "number", "page_id", "payload_bytes", "payload_digest"])

    return archives.select("archive").repartition(tasks).mapInArrow(run, "archive string, number long, page_id long, payload_bytes long, payload_digest string")


def revisits(spark: SparkSession, index: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The index with first_page, first_archive and first_number of the response, null where the record is one."""
    large = index.where(F.col("payload_bytes") >= least_bytes)
    first = large.groupBy("payload_digest", "payload_bytes").agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "number")).alias("first"))
    first = stored(spark, first.where("n > 1").select("payload_digest", F.col("first.page_id").alias("first_page"), F.col("first.archive").alias("first_archive"), F.col("first.number").alias("first_number")), "first-payloads")
    same = (F.col("archive") == F.col("first_archive")) & (F.col("number") == F.col("first_number"))
    columns = ("first_page", "first_archive", "first_number")
    got = large.join(first, "payload_digest", "left").select("archive", "number", *(F.when(~same, F.col(c)).alias(c) for c in columns))
    # small payloads have no key and pass by the join
    small = index.where(F.col("payload_bytes") < least_bytes).select("archive", "number", *(F.lit(None).cast(first.schema[c].dataType).alias(c) for c in columns))
    return got.unionByName(small)


def convert_arcs(decisions: DataFrame, folder: str, tasks: int) -> DataFrame:
    """Converts every archive with its records' decisions; one row a WARC archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            archive = row[0]
            out = f"{folder}/{archive.rpartition('/')[2].removesuffix('.arc.gz')}.warc.gz"
            with _opened(archive) as f, writing(out) as to:
                for number, record in enumerate(read_arc(f)):
                    refers = None
                    if row is not None and row[:2] == (archive, number):
                        refers = row[2:] if row[3] is not None else None
                        row = next(rows, None)
                    to.write(member(convert(record, archive, number, refers)))
            if row is not None and row[0] == archive:
                raise ValueError(f"{archive} has fewer records than decisions")
            yield pa.RecordBatch.from_arrays([pa.array([out])], names=["archive"])

    rows = decisions.select("archive", "number", "first_page", "first_archive", "first_number")
    return rows.repartitionByRange(tasks, "archive").sortWithinPartitions("archive", "number").mapInArrow(run, "archive string")


def read_warcs(archives: DataFrame, tasks: int) -> DataFrame:
    """One row a response or revisit, from the archives alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in (a for b in batches for a in b.column(0).to_pylist()):
            rows = []
            with _opened(archive) as f:
                for headers, block in read_warc(f):
                    kind = headers["WARC-Type"]
                    _, payload, page_id = http_parts(block)
                    if kind == "revisit":
                        refers = headers.get(REFERS_HEADER)
                        rows.append((page_id, int(headers[LENGTH_HEADER]), headers["WARC-Payload-Digest"].partition(":")[2], kind, None if refers is None else int(refers)))
                    elif kind != "warcinfo":
                        if (digest := hashlib.sha256(payload).hexdigest()) != headers["WARC-Payload-Digest"].partition(":")[2]:
                            raise ValueError("payload and digest differ")
                        rows.append((page_id, len(payload), digest, kind, None))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.select("archive").repartition(tasks).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "archives")
    arcs = stored(spark, write_arcs(table(spark, sf_dir, "pages"), f"{folder}/arc"), "arc-files")
    tasks = max(1, min(10_000, arcs.count()))
    index = stored(spark, index_arcs(arcs, tasks), "arc-index")
    warcs = stored(spark, convert_arcs(revisits(spark, index), f"{folder}/warc", tasks), "warc-files")
    return read_warcs(warcs, tasks)


ORACLE_SQL = {
    "op9_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) >= {LEAST_BYTES} AS long FROM pages),
             n AS (SELECT *, row_number() OVER (PARTITION BY payload ORDER BY page_id) AS nth, min(page_id) OVER (PARTITION BY payload) AS least FROM p)
        SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN long AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN long AND nth > 1 THEN least END AS refers_to
        FROM n"""
}
