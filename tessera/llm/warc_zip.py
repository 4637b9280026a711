"""WARC records in ZIP-packaged archives: a writer, and a reader that never unpacks an archive.

Each archive is a ZIP file with two stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (a JSON line per record with its offset and length). The reader parses the end record, the
ZIP64 end record where there is one, and the central directory; finds where the stored members start; reads the index;
and then reads the ranges of the records alone. Archives are written to and read from the shared folder through
``pyarrow.fs``, so local, HDFS and object stores work alike. A file gets its final name only when it is whole, and a
task that runs again writes the same names again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, ensure_checkpoint_dir, read, text_of

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ReadAt = Callable[[int, int], bytes]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        uri = "file://" + uri
    return pafs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- records


def warc_record(page_id, url, kind: str, digest: str, refers_to, payload: bytes | None, n_bytes: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    uri = " ".join((url or "").split())
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers of a WARC record, its HTTP Content-Length and payload; a response's digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">") or -1) if x not in (None, "<urn:page:>") else None
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": length,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": payload if fields["WARC-Type"] == "response" else None}


# ---------------------------------------------------------------- writing


class ArchiveWriter:
    """One archive, streamed to a temporary name and moved to its own when closed."""

    def __init__(self, base: str, name: str):
        self.fs, root = filesystem(base)
        self.path, self.uri = f"{root}/{name}", f"{base.rstrip('/')}/{name}"
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.tmp)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.offset, self.index = 0, []

    def add(self, page_id, record: bytes) -> None:
        packed = gzip.compress(record, compresslevel=5, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.offset, "length": len(packed)}))
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return self.uri, len(self.index), size


def write_archives(pages: DataFrame, base: str, archive_bytes: int = 64 << 20) -> DataFrame:
    """Write the records (page_id as text, url, html, digest hex, n_bytes, refers as text) and return the written list of archives."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n, out, done = TaskContext.get().partitionId(), 0, None, []
        for pdf in batches:
            for page_id, url, html, digest, n_bytes, refers in pdf.itertuples(index=False):
                if out is None:
                    out = ArchiveWriter(base, f"part-{part:06d}-{n:04d}.wacz")
                page_id = None if page_id is None else int(page_id)
                revisit = refers is not None
                code = base64.b32encode(bytes.fromhex(digest)).decode()
                out.add(page_id, warc_record(page_id, url, "revisit" if revisit else "response", code,
                                             int(refers) if revisit else None, None if revisit else html.encode(), int(n_bytes)))
                if out.offset >= archive_bytes:
                    done.append(out.close())
                    out, n = None, n + 1
        if out is not None:
            done.append(out.close())
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    return cut_lineage(pages.mapInPandas(write, "path string, records long, bytes long"))


# ---------------------------------------------------------------- reading


def zip_members(read_at: ReadAt, size: int) -> dict[str, dict]:
    """Members of a ZIP file by name: method, stored size, start of their data; from the (ZIP64) directories alone."""
    tail_at = max(0, size - 65_557)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    where = tail_at + end - 20
    locator = read_at(where, 20) if where >= 0 else b""
    if locator[:4] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", locator, 8)[0]
        record = read_at(at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where its locator points")
        n, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read_at(start, length), 0, {}
    for _ in range(n):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        raw = directory[at + 46 : at + 46 + n_name]
        extra, k = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n_field = struct.unpack_from("<HH", extra, k)
            if tag == 1:  # wide values, in this order, for those that are all ones
                wide = k + 4
                values = []
                for v in (plain, packed, header):
                    if v == 0xFFFFFFFF:
                        v = struct.unpack_from("<Q", extra, wide)[0]
                        wide += 8
                    values.append(v)
                plain, packed, header = values
            k += 4 + n_field
        local = read_at(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("no local header where the directory points")
        begin = header + 30 + sum(struct.unpack_from("<HH", local, 26))
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        members[name] = {"method": method, "packed": packed, "size": plain, "begin": begin}
        at += 46 + n_name + n_extra + n_comment
    return members


def member_bytes(read_at: ReadAt, member: dict) -> bytes:
    raw = read_at(member["begin"], member["packed"])
    if member["method"] == 8:
        return zlib.decompress(raw, -15)
    if member["method"]:
        raise ValueError(f"unknown compression method {member['method']}")
    return raw


def archive_records(read_at: ReadAt, size: int, stretch: int = 4 << 20) -> Iterator[dict]:
    """The records of one archive, by range reads of at most ``stretch`` bytes (or one record)."""
    members = zip_members(read_at, size)
    data = members[DATA]
    if data["method"]:
        raise ValueError("records can only be read from a stored member")
    entries = [json.loads(x) for x in member_bytes(read_at, members[INDEX]).decode().split("\n") if x]
    k = 0
    while k < len(entries):
        last = k
        begin = entries[k]["offset"]
        while last + 1 < len(entries) and entries[last + 1]["offset"] == entries[last]["offset"] + entries[last]["length"] and entries[last + 1]["offset"] + entries[last + 1]["length"] - begin <= stretch:
            last += 1
        raw = read_at(data["begin"] + begin, entries[last]["offset"] + entries[last]["length"] - begin)
        for e in entries[k : last + 1]:
            yield parse_record(gzip.decompress(raw[e["offset"] - begin : e["offset"] - begin + e["length"]]))
        k = last + 1


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of a table of archives (path); payloads only on request."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [x.split(" ")[0] for x in schema.split(", ")] + ["payload"] * payloads

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uri in pdf["path"]:
                store, path = filesystem(uri)
                with store.open_input_file(path) as f:
                    rows, held = [], 0
                    for r in archive_records(lambda at, n, f=f: f.read_at(n, at), f.size()):
                        rows.append([r[n] for n in names])
                        held += len(r["payload"] or b"") if payloads else 100
                        if held > 8 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                    yield _frame(rows, names)

    paths = archives.select("path")
    spread = paths.repartition(max(1, paths.count()))  # a task an archive: the rows are too small for AQE to judge
    return spread.mapInPandas(scan, schema + ", payload binary" * payloads)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to", "payload_bytes"):
        out[c] = out[c].astype("Int64")
    return out


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in the shared folder; return the table of archives.

    Of records with equal payloads of at least ``min_bytes``, that with the smallest page_id is a response; others
    revisit it. Null html: empty payload. A null page_id sorts last, so it revisits a record that has one; where
    all records of a payload lack it, all are responses. Rows that repeat the smallest page_id are all responses.
    Empty input: no archive.
    """
    spark = pages.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    rows = pages.select("page_id", "url", text_of("html").alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    first = (rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = rows.join(first, "digest", "left").select(
        F.col("page_id").cast("string"), "url", F.when(~revisit, F.col("html")).alias("html"), "digest",
        F.octet_length("html").cast("long").alias("n_bytes"), F.when(revisit, F.col("first")).cast("string").alias("refers"))
    return write_archives(records, base)


def op6_zip_warc(spark, sf_dir):
    return read_archives(archive_pages(read(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex),
w AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((v >> (15 - 5 * s)) & 31 AS BIGINT) + 1, 1), '' ORDER BY k, s) AS code
  FROM (SELECT hex, k, CAST('0x' || substr(hex, 5 * k + 1, 5) AS BIGINT) AS v
        FROM (SELECT DISTINCT hex FROM p), (SELECT unnest(range(8)) AS k)), (SELECT unnest(range(4)) AS s)
  GROUP BY hex
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, w.code AS payload_digest,
       CASE WHEN p.page_id = g.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> g.first THEN g.first END AS refers_to
FROM p JOIN g USING (hex) JOIN w USING (hex)
"""
