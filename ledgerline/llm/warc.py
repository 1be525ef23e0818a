"""Operator 6: WARC records in ZIP-packaged archives, read by byte ranges.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``
(one gzip member per WARC record) and ``indexes/index.cdxj`` (a line per
record with its offset and length).  Writing: each task streams its pages into
archives of bounded size in the shared folder, under names of its own attempt;
the manifest, a table committed by Spark, lists only the archives of finished
tasks, so lost or repeated attempts leave no trace in it.  Reading: the end
record, the ZIP64 records and the central directory locate the stored members;
the index gives byte ranges, dealt over the cluster in chunks; each chunk is
one range read, and nothing is extracted.

Files are opened through ``pyarrow.fs`` from their URI (local, HDFS, object
stores), as Spark has no writer for binary files.

Records of equal payload of at least ``least`` bytes: the smallest page_id is
the response, the others are revisits of it.

Defined cases: null html is an empty payload; null url leaves out the target
header; a null page_id has an empty record id and is a revisit where another
page has its payload (a response if no page with an id has); rows that repeat
the smallest page_id are all responses; extra columns are ignored; an empty
table writes no archive and reads back as no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.runtime import broadcast_if_small, saved, shared_folder, ship_code

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 256 << 20
CHUNK_BYTES = 8 << 20
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


# -- records ------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP head without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="/:?#[]@!$&'()*+,;=-._~"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one WARC record; raises if its payload isn't what it says."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")

    def page(name: str | None) -> int | None:
        number = name and name.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return {"page_id": page(fields["WARC-Record-ID"]), "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
            "payload": payload if kind == "response" else None, "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": page(fields.get("WARC-Refers-To"))}


# -- the ZIP package ------------------------------------------------------------

class ArchiveWriter:
    """Streams records into one archive; the index waits in memory."""

    def __init__(self, folder: str):
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        self.uri = f"{folder}/archive-{uuid.uuid4().hex}.zip"
        self.out = system.open_output_stream(_open(self.uri)[1])
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, page_id: int | None, kind: str, data: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.member.write(packed)
        self.lines.append(f"urn:page:{'' if page_id is None else page_id} {DATE} " + json.dumps({"offset": self.at, "length": len(packed), "type": kind}))
        self.at += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines)


def _range(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends within {size} bytes at {start}")
    return data


def stored_members(f, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (first byte, bytes) of a ZIP's stored members, from its central
    directory; ``f`` is any seekable file.  Members stored otherwise are left out."""
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = _range(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    count, _, at = struct.unpack("<HII", tail[end + 10:end + 20])
    length = struct.unpack("<I", tail[end + 12:end + 16])[0]
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":  # ZIP64 locator
        end64 = _range(f, struct.unpack("<Q", tail[end - 12:end - 4])[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where its locator points")
        count, length, at = struct.unpack("<QQQ", end64[32:56])
    directory = _range(f, at, length)
    found, p = {}, 0
    for _ in range(count):
        if directory[p:p + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack("<HH", directory[p + 8:p + 12])
        packed, plain, n, extra_n, comment_n = struct.unpack("<IIHHH", directory[p + 20:p + 34])
        local = struct.unpack("<I", directory[p + 42:p + 46])[0]
        name = directory[p + 46:p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[p + 46 + n:p + 46 + n + extra_n]
        while len(extra) >= 4:  # ZIP64 sizes stand here for those that read all ones
            kind, k = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[4:4 + k // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + k:]
        if method == 0:
            head = _range(f, local, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            name_n, local_extra_n = struct.unpack("<HH", head[26:30])
            found[name] = (local + 30 + name_n + local_extra_n, packed)
        p += 46 + n + extra_n + comment_n
    return found


def chunks(f, size: int, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """(first byte, bytes, record lengths) of runs of records, from the index."""
    members = stored_members(f, size)
    data_at, _ = members[DATA]
    index = _range(f, *members[INDEX]).decode()
    start, total, lengths = None, 0, []
    for line in index.split("\n") if index else []:
        entry = json.loads(line.split(" ", 2)[2])
        at, n = data_at + entry["offset"], entry["length"]
        if start is not None and (at != start + total or total + n > chunk_bytes):
            yield start, total, lengths
            start = None
        if start is None:
            start, total, lengths = at, 0, []
        total += n
        lengths.append(n)
    if start is not None:
        yield start, total, lengths


# -- tables -----------------------------------------------------------------------

def plan_records(spark: SparkSession, pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, digest, revisit, refers_to) of each page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = (rows.filter(F.octet_length("payload") >= least).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1 AND first IS NOT NULL").select("digest", "first"))
    first = broadcast_if_small(saved(spark, first, "first-pages"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(first, "digest", "left").withColumn("revisit", revisit)
            .select("page_id", "url", "payload", "digest", "revisit", F.when(F.col("revisit"), F.col("first")).alias("refers_to")))


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages into archives below ``folder`` -> manifest (path, records)."""
    ship_code(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("records", pa.int64())])
        writer = None
        for batch in batches:
            for r in batch.to_pylist():
                writer = writer or ArchiveWriter(folder)
                kind = "revisit" if r["revisit"] else "response"
                writer.add(r["page_id"], kind, record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"]))
                if writer.at >= archive_bytes:
                    path, n = writer.close()
                    writer = None
                    yield pa.RecordBatch.from_pylist([{"path": path, "records": n}], schema)
        if writer:
            path, n = writer.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": n}], schema)

    manifest = plan_records(spark, pages, least).mapInArrow(write, "path string, records long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema("path string, records long").parquet(f"{folder}/manifest")


def read_archives(spark: SparkSession, paths: DataFrame, chunk_bytes: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """The records of the archives in ``paths`` (path), read by byte ranges."""
    ship_code(spark)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("bytes", pa.int64()), ("lengths", pa.list_(pa.int64()))])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, own = _open(path)
                with system.open_input_file(own) as f:
                    for at, n, lengths in chunks(f, f.size(), chunk_bytes):
                        yield pa.RecordBatch.from_pylist([{"path": path, "at": at, "bytes": n, "lengths": lengths}], schema)

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    fields = [x for x in fields if payload or x[0] != "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(fields)
        for batch in batches:
            for c in batch.to_pylist():
                system, own = _open(c["path"])
                with system.open_input_file(own) as f:
                    data = memoryview(_range(f, c["at"], c["bytes"]))
                rows, p = [], 0
                for n in c["lengths"]:
                    r = parse_record(zlib.decompress(data[p:p + n], 31))
                    rows.append({k: r[k] for k, _ in fields})
                    p += n
                yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = paths.select("path").mapInArrow(locate, "path string, at long, bytes long, lengths array<long>").repartition(n, "path", "at")
    return ranges.mapInArrow(read, ", ".join(f"{k} {kinds[t]}" for k, t in fields))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    manifest = write_archives(spark, pages, shared_folder(spark, "warc"))
    return read_archives(spark, manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


OP6_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to, url
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest
"""
