"""WARC records in ZIP packages: write them, and range-read them back.

A package is a ZIP file whose members are stored, not deflated:
``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (a line a record with its offset and length in the
archive). The reader never extracts: it reads the end of the file, the ZIP64
locator and end record where there are any, and the central directory;
locates the stored members; reads the index; and then range-reads each
record's bytes, so records of one package spread over many tasks. An archive
without an index is walked record by record.

Files are opened through ``pyarrow.fs`` by URI, on any storage that every
executor reaches; the driver only lists tables. Each task writes packages
under names of their own, and only packages in the written table are read, so
a retried task leaves nothing behind that counts.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with
the largest id is a response and the others revisit it; the revisit keeps the
payload's digest and length and no payload. Rows that repeat both id and
payload of the response are responses too. A null payload is empty, a null id
or URL is left out of the headers and read back as null; characters that no
URI may hold are percent-encoded in it. Empty tables make no
package and no record.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.llm.scratch import shared_folder, written

# Fixed values of the ZIP and WARC formats.
END_RECORD, END64_RECORD, END64_LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL_ENTRY, LOCAL_ENTRY, ZIP64_EXTRA = b"PK\x01\x02", b"PK\x03\x04", 1
URI_CHARACTERS = "!#$%&'()*+,/:;=?@[]~"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 1 << 28
READ_AHEAD = 1 << 22       # neighbouring records read at once, at most this many bytes
RECORD_BATCH = 1 << 24     # payload bytes in an output batch

PACKAGES = "path string, n_records bigint"
RECORDS = ("record_id string, uri string, record_type string, payload_digest string, payload_bytes bigint, "
           "refers_to string")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# -- writing ---------------------------------------------------------------

def _record(record_id, uri, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Date", "2024-01-01T00:00:00Z")]
    head += [("WARC-Record-ID", f"<urn:record:{record_id}>")] if record_id is not None else []
    head += [("WARC-Target-URI", quote(uri, safe=URI_CHARACTERS))] if uri is not None else []
    head += [("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:record:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write_package(path: str, records: Iterator[tuple], most: int) -> int:
    """One package from the next records, until ``most`` bytes; the records written."""
    system, at = _opened(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    lines, offset = [], 0
    with system.open_output_stream(at) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        with package.open(ARCHIVE, "w", force_zip64=True) as archive:
            for record_id, uri, payload, digest, refers_to in records:
                data = _gzip(_record(record_id, uri, payload, digest, refers_to))
                archive.write(data)
                lines.append(json.dumps({"offset": offset, "length": len(data)}))
                offset += len(data)
                if offset >= most:
                    break
        with package.open(INDEX, "w", force_zip64=True) as index:
            index.write("".join(f"{line}\n" for line in lines).encode())
    return len(lines)


def write_packages(pages: DataFrame, folder: str, id_column: str = "page_id", uri: str = "url", payload: str = "html",
                   min_revisit: int = 1000, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes the packages under ``folder``; the table of their paths and record counts."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("bigint").alias("id"), F.col(uri).cast("string").alias("uri"),
                        body.alias("payload"), F.sha1(body).alias("digest"))
    groups = (rows.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
              .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper"))
    refers = F.when(F.col("id").eqNullSafe(F.col("keeper")), None).otherwise(F.col("keeper"))
    records = rows.join(groups, "digest", "left").select("id", "uri", "payload", "digest", refers.alias("refers_to"))

    def write(batches):
        def each():
            for batch in batches:
                cols = batch.columns
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in cols)

        records = each()
        while (first := next(records, None)) is not None:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            n = _write_package(path, chain([first], records), package_bytes)
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    return written(records.mapInArrow(write, PACKAGES), "warc-packages")


# -- reading ---------------------------------------------------------------

@dataclass
class Member:
    """A stored member: where its bytes lie in the package."""

    name: str
    start: int
    size: int


def _range(file, start: int, size: int) -> bytes:
    data = file.read_at(size, start)
    if len(data) < size:
        raise ValueError("the package ends early")
    return data


def central_directory(file) -> list[Member]:
    """The stored members of an open ZIP or ZIP64 file, by its central directory."""
    size = file.size()
    tail = _range(file, max(0, size - 65557), min(size, 65557))
    end = tail.rfind(END_RECORD)
    if end < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
    if n == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        at = max(0, size - len(tail) + end - 20)
        locator = _range(file, at, 20)
        if locator[:4] != END64_LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = _range(file, struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != END64_RECORD:
            raise ValueError("no ZIP64 end of central directory")
        n, length, start = struct.unpack("<QQQ", record[32:56])
    directory, at, members = _range(file, start, length), 0, []
    for _ in range(n):
        if directory[at:at + 4] != CENTRAL_ENTRY:
            raise ValueError("bad central directory")
        flags, method = struct.unpack("<HH", directory[at + 8:at + 12])
        packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[at + 20:at + 34])
        local, = struct.unpack("<I", directory[at + 42:at + 46])
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, k = struct.unpack("<HH", extra[:4])
            if kind == ZIP64_EXTRA:
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[4:4 + k // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + k:]
        at += 46 + n_name + n_extra + n_comment
        if method == 0 and not flags & 1 and packed == plain:
            head = _range(file, local, 30)
            if head[:4] != LOCAL_ENTRY:
                raise ValueError("bad local entry")
            members.append(Member(name, local + 30 + sum(struct.unpack("<HH", head[26:30])), packed))
    return members


def _walk(file, member: Member) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a gzipped archive that has no index."""
    at = 0
    while at < member.size:
        z, start = zlib.decompressobj(31), at
        while not z.eof and at < member.size:
            data = _range(file, member.start + at, min(1 << 20, member.size - at))
            z.decompress(data)
            at += len(data) - len(z.unused_data)
        yield start, at - start


def record_ranges(packages: DataFrame) -> DataFrame:
    """``path, start, size``: the place of every record's bytes in its package."""
    def locate(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at = _opened(path)
                with system.open_input_file(at) as file:
                    members = {m.name: m for m in central_directory(file)}
                    for name, member in members.items():
                        if not (name.startswith("archive/") and name.endswith(".warc.gz")):
                            continue
                        index = members.get(INDEX) if name == ARCHIVE else None
                        if index is not None:
                            lines = _range(file, index.start, index.size).decode().splitlines()
                            found = [(x["offset"], x["length"]) for x in map(json.loads, lines)]
                        else:
                            found = list(_walk(file, member))
                        yield pa.RecordBatch.from_pydict({
                            "path": [path] * len(found), "start": [member.start + o for o, _ in found],
                            "size": [n for _, n in found]})

    return packages.select("path").mapInArrow(locate, "path string, start bigint, size bigint")


def parse_record(data: bytes) -> dict:
    """Headers and payload of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    kind = fields["WARC-Type"]
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    return {
        "record_id": _bare(fields.get("WARC-Record-ID")), "uri": fields.get("WARC-Target-URI"),
        "record_type": kind, "payload_digest": digest if kind == "revisit" else hashlib.sha1(payload).hexdigest(),
        "payload_bytes": int(lengths[0]) if kind == "revisit" and lengths else len(payload),
        "refers_to": _bare(fields.get("WARC-Refers-To")), "payload": payload if kind != "revisit" else None}


def _bare(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:record:").removesuffix(">") if urn else None


def read_records(packages: DataFrame, with_payload: bool = False, tasks: int | None = None) -> DataFrame:
    """Every record of the packages: ``RECORDS`` and, if asked for, ``payload``."""
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"] * with_payload
    schema = RECORDS + (", payload binary" if with_payload else "")
    spark = packages.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stretches of neighbouring records, dealt out evenly
    ranges = (record_ranges(packages).withColumn("stretch", F.floor(F.col("start") / READ_AHEAD))
              .repartition(tasks, "path", "stretch").sortWithinPartitions("path", "start"))

    def read(batches):
        types = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        rows, held = [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

        for path, start, sizes in _stretches(batches):
            system, at = _opened(path)
            with system.open_input_file(at) as file:
                data = _range(file, start, sum(sizes))
            done = 0
            for size in sizes:
                rows.append(parse_record(zlib.decompress(data[done:done + size], 31)))
                done += size
                held += (rows[-1]["payload_bytes"] if with_payload else 0) + 200
                if held >= RECORD_BATCH:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return ranges.select("path", "start", "size").mapInArrow(read, schema)


def _stretches(batches) -> Iterator[tuple[str, int, list[int]]]:
    """Neighbouring records of one package, up to READ_AHEAD bytes: path, start, sizes."""
    path, start, end, sizes = None, 0, 0, []
    for batch in batches:
        for p, s, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sizes and p == path and s == end and end + n - start <= READ_AHEAD:
                sizes.append(n)
            else:
                if sizes:
                    yield path, start, sizes
                path, start, sizes = p, s, [n]
            end = s + n
    if sizes:
        yield path, start, sizes


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes every page's record into packages in the shared folder and reads them all back."""
    packages = write_packages(pages, shared_folder(spark, "warc"))
    return read_records(packages)
