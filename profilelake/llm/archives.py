"""Legacy web archives (ARC 1 and 2) converted to WARC, and WARC files read.

The converter reads an ARC file's version block, takes the header fields that its
version declares and trusts each record's declared length. From them it makes the
WARC fields: a record id derived from the record's key, the 14-digit date as an
ISO time, the type from the block (an HTTP answer or other content), and SHA-256
digests. Payloads seen before become revisits: records are indexed first (key,
digest, length), equal payloads of at least ``least`` bytes are grouped in Spark,
and each file's revisits are handed to the task that writes it. Payloads are never
shuffled, and one record at a time is in memory.

Cases: a null page body is empty; null and odd addresses are escaped; rows that
share a key are one response and revisits of it; a null key is always a response
of its own; an empty table gives no files and no rows. A header that does not fit
its version, or a record shorter than declared, fails with file and place.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm import files
from profilelake.llm.common import scratch, staged

LEAST = 100
FILE_BYTES = 32_000_000
DATE = "20240101000000"

# The header fields of the two versions.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY_FIELD = "X-Archive-Key"

WRITTEN = "file string, version int, records bigint"
INDEX = "file string, place bigint, key bigint, digest string, bytes bigint"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, record_id string, url string, date string"
)


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    kind: str
    block: bytes

    @property
    def http(self) -> tuple[bytes, bytes]:
        """(header, payload) of the block; a block without a header is all payload."""
        head, mark, body = self.block.partition(b"\r\n\r\n")
        return (head + mark, body) if mark and head.startswith(b"HTTP/") else (b"", self.block)

    @property
    def key(self) -> int | None:
        for line in self.http[0].split(b"\r\n"):
            name, _, value = line.partition(b": ")
            if name == KEY_FIELD.encode() and value != b"none":
                return int(value)
        return None


def escaped(url: str | None) -> str:
    return quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~-._") or "about:blank"


def arc_header(version: int, url: str, date: str, kind: str, name: str, block: bytes, at: int) -> bytes:
    digest = hashlib.md5(block, usedforsecurity=False).hexdigest()
    middle = [] if version == 1 else ["200", digest, "-", str(at), name]
    return (" ".join([url, "0.0.0.0", date, kind, *middle, str(len(block))]) + "\n").encode()


def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 pages\n{' '.join(FIELDS[version])}\n".encode()
    return arc_header(version, f"filedesc://{name}", date, "text/plain", name, body, 0) + body + b"\n"


def read_arc(stream, name: str = "") -> Iterator[ArcRecord]:
    """The records of an ARC file after its version block."""
    first = stream.readline().decode().split(" ")
    if not first[0].startswith("filedesc://"):
        raise ValueError(f"{name}: no version block")
    body = stream.read(int(first[-1]))
    version = int(body.split(b" ", 1)[0])
    if version not in FIELDS:
        raise ValueError(f"{name}: version {version} is unknown")
    names = FIELDS[version]
    stream.readline()
    while line := stream.readline():
        if line == b"\n":
            continue
        values = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"{name}: header {line[:80]!r} does not fit version {version}")
        field = dict(zip(names, values))
        block = stream.read(int(field["Archive-length"]))
        if len(block) != int(field["Archive-length"]):
            raise ValueError(f"{name}: {field['URL']} is shorter than declared")
        yield ArcRecord(
            field["URL"], field["IP-address"], field["Archive-date"], field["Content-type"], block
        )


def warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def record_id(key: object) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'archive-record/{key}')}"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    digest = hashlib.sha256(block).hexdigest()
    lines = [*fields, ("WARC-Block-Digest", f"sha256:{digest}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def converted(record: ArcRecord, place: str, revisits: dict | None = None) -> bytes:
    """The WARC record of an ARC record; ``revisits`` has the key that it repeats."""
    head, payload = record.http
    page = bool(head)
    own = record_id(record.key if record.key is not None else place)
    fields = [
        ("WARC-Type", "response" if page else "resource"),
        ("WARC-Record-ID", f"<{own}>"),
        ("WARC-Date", warc_date(record.date)),
        ("WARC-Target-URI", record.url),
        ("WARC-IP-Address", record.ip),
        ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response" if page else record.kind),
    ]
    if revisits is None:
        return warc_record(fields, record.block)
    fields[0] = ("WARC-Type", "revisit")
    fields += [
        ("WARC-Profile", IDENTICAL),
        ("WARC-Refers-To", f"<{record_id(revisits['refers_to'])}>"),
        ("X-Refers-To-Key", str(revisits["refers_to"])),
    ]
    return warc_record(fields, head)


def read_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of a WARC file's records."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            fields[name] = value
        yield fields, stream.read(int(fields["Content-Length"]))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.record_batch(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], names=[n for n, _ in names]
    )


def write_arc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Legacy archives of (key, url, body); every second file is of version 2.

    Gives one row per file.
    """
    files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*(batch[k] for k in ("key", "url", "body")))
        )
        number, row = 0, next(rows, None)
        while row is not None:
            name = f"{TaskContext.get().partitionId():06d}-{number:04d}.arc.gz"
            version, size, count = 1 + number % 2, 0, 0
            if TaskContext.get().partitionId() % 2:
                version = 3 - version
            with files.writing(f"{folder}/{name}") as out:
                out.write(gzip.compress(version_block(version, name, DATE), 1, mtime=0))
                while row is not None and size < file_bytes:
                    key, url, body = (x.as_py() for x in row)
                    payload = (body or "").encode()
                    shown = "none" if key is None else str(key)
                    head = (
                        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
                        f"Content-Length: {len(payload)}\r\n{KEY_FIELD}: {shown}\r\n\r\n"
                    )
                    block = head.encode() + payload
                    line = arc_header(version, escaped(url), DATE, "text/html", name, block, size)
                    out.write(gzip.compress(line + block + b"\n", 1, mtime=0))
                    size, count = size + len(block), count + 1
                    row = next(rows, None)
            yield _batch([(name, version, count)], WRITTEN)
            number += 1

    return staged(pages.select("key", "url", "body").mapInArrow(write, WRITTEN), "arc-files")


def index_arc(written: DataFrame, folder: str) -> DataFrame:
    """(file, place, key, digest, bytes) of every record."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                rows = []
                with files.reading(f"{folder}/{name}") as raw, gzip.open(raw) as stream:
                    for place, record in enumerate(read_arc(stream, name)):
                        payload = record.http[1]
                        digest = hashlib.sha256(payload).hexdigest()
                        rows.append((name, place, record.key, digest, len(payload)))
                        if len(rows) == 10_000:
                            yield _batch(rows, INDEX)
                            rows = []
                yield _batch(rows, INDEX)

    return written.select("file").mapInArrow(index, INDEX)


def convert(written: DataFrame, folder: str, out: str, least: int = LEAST) -> DataFrame:
    """WARC files of ARC files, repeated payloads as revisits; one row per file."""
    files.make_folder(out)
    index = staged(index_arc(written, folder), "arc-index")
    large = index.filter((F.col("bytes") >= least) & F.col("key").isNotNull())
    first = (
        large.groupBy("digest", "bytes")
        .agg(F.min(F.struct("key", "file", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    again = large.join(first, ["digest", "bytes"]).filter(
        F.struct("key", "file", "place") != F.col("first")
    )
    lists = again.groupBy("file").agg(
        F.collect_list(F.struct("place", F.col("first.key").alias("refers_to"))).alias("revisits")
    )
    work = written.join(lists, "file", "left").select("file", "revisits")
    work = work.repartition(max(1, written.count()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, revisits in zip(batch["file"].to_pylist(), batch["revisits"].to_pylist()):
                known = {r["place"]: r for r in revisits or ()}
                target, count = name.replace(".arc.gz", ".warc.gz"), 0
                with (
                    files.reading(f"{folder}/{name}") as raw,
                    gzip.open(raw) as stream,
                    files.writing(f"{out}/{target}") as sink,
                ):
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(target)}>"),
                            ("WARC-Date", warc_date(DATE)), ("WARC-Filename", target),
                            ("Content-Type", "application/warc-fields")]
                    sink.write(gzip.compress(warc_record(info, b"format: WARC/1.1\r\n"), 1, mtime=0))
                    for place, record in enumerate(read_arc(stream, name)):
                        made = converted(record, f"{name}/{place}", known.get(place))
                        sink.write(gzip.compress(made, 1, mtime=0))
                        count += 1
                yield _batch([(target, 1, count)], WRITTEN)

    return staged(work.mapInArrow(write, WRITTEN), "warc-files")


def read_archives(written: DataFrame, folder: str) -> DataFrame:
    """One row per page record of the WARC files; payloads are checked by digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                rows = []
                with files.reading(f"{folder}/{name}") as raw, gzip.open(raw) as stream:
                    for fields, block in read_warc(stream):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = ArcRecord("", "", "", "", block).http
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = len(payload)
                        if kind == "revisit":
                            lines = dict(
                                x.split(": ", 1) for x in head.decode().split("\r\n") if ": " in x
                            )
                            size = int(lines["Content-Length"])
                        elif hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: {fields['WARC-Record-ID']} is damaged")
                        refers = fields.get("X-Refers-To-Key")
                        rows.append((
                            ArcRecord("", "", "", "", block).key, size, digest, kind,
                            None if refers is None else int(refers), fields["WARC-Record-ID"],
                            fields["WARC-Target-URI"], fields["WARC-Date"],
                        ))
                        if len(rows) == 10_000:
                            yield _batch(rows, RECORDS)
                            rows = []
                yield _batch(rows, RECORDS)

    return written.select("file").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written as ARC files, converted to WARC files and read back."""
    folder = folder or scratch(pages.sparkSession, "archives")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("key"), "url", F.col("html").alias("body")
    )
    legacy = write_arc(rows, f"{folder}/arc")
    made = convert(legacy, f"{folder}/arc", f"{folder}/warc")
    spread = made.repartition(max(1, made.count()))
    return read_archives(spread, f"{folder}/warc")
