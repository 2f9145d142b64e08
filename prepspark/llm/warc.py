"""WARC archives as a PySpark data source: writer, reader with pushed predicates.

Writing: each task writes files of its own, one gzip member per record, rolled at
``roll_mb``.  A member's header carries its compressed and full length (the "sl" extra
field of the WARC standard's annex on gzip).  The commit writes a manifest with the files
of the successful tasks and the offsets at which they may be cut; files of lost or repeated
task attempts are in no manifest and are never read.

Reading: partitions are ranges of files from the manifests, or whole files of a folder
without a manifest.  Of each record the headers are decoded first; predicates on record
type, id, target, length and digest that Spark pushes down are tested on them, and a
record that fails, or whose payload is not wanted, is skipped by its length without being
decompressed further.  ``payload`` says what is wanted: ``skip``, ``verify`` (decode, compare
the digest, drop the bytes) or ``bytes``.

``archive_pages`` writes one record per page: of pages with equal payloads of at least
``min_bytes`` bytes the one with the largest id is a response, the others are revisits that
name it.  Payloads are matched by SHA-1 as WARC does; only digests are shuffled unless the
list of repeated ones is above the session's broadcast threshold.

Results for odd input: a null html is an empty payload; a null url gives no target; null ids
are written as such, a group's response is its largest non-null id, and pages that share the
response's id (or all ids null) are responses too; extra columns are ignored; an empty table
gives an archive without records and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import query, scratch, table

SCHEMA = (
    "page_id bigint, target_uri string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, digest_ok boolean, payload binary"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FIRST_BYTES = 4096


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; executors need the same store mounted or its credentials."""
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri("file://" + path)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id_of(urn: str | None) -> int | None:
    text = (urn or "").rstrip(">").rpartition(":")[2]
    return int(text) if text.lstrip("-").isdigit() else None


def record_bytes(page_id, url, payload: bytes, size: int, digest: str, kind: str, refers_to) -> bytes:
    """One uncompressed record.  A revisit has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127))) + "%"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 3) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.roll = int(options.get("roll_mb", 256)) << 20
        self.cut = int(options.get("cut_mb", 16)) << 20

    def write(self, iterator) -> Written:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for row in iterator:
            payload = (row.payload or b"") if row.record_type == "response" else b""
            member = gzip_member(
                record_bytes(row.page_id, row.target_uri, bytes(payload), row.payload_bytes, row.payload_digest, row.record_type, row.refers_to)
            )
            if out is None or size + len(member) > self.roll and size:
                if out is not None:
                    out.close()
                    files[-1]["size"] = size
                files.append({"name": f"part-{uuid.uuid4().hex}.warc.gz", "cuts": [0]})
                out, size = store.open_output_stream(f"{root}/{files[-1]['name']}", compression=None), 0
            if size - files[-1]["cuts"][-1] >= self.cut:
                files[-1]["cuts"].append(size)
            out.write(member)
            size += len(member)
        if out is not None:
            out.close()
            files[-1]["size"] = size
        return Written(files)

    def commit(self, messages) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        """Files of a failed job are in no manifest."""


#: Tests of the predicates that a record's headers decide.
_TESTS = {
    EqualTo: lambda v, x: v is not None and v == x,
    GreaterThan: lambda v, x: v is not None and v > x,
    GreaterThanOrEqual: lambda v, x: v is not None and v >= x,
    LessThan: lambda v, x: v is not None and v < x,
    LessThanOrEqual: lambda v, x: v is not None and v <= x,
    In: lambda v, x: v is not None and v in x,
    StringStartsWith: lambda v, x: v is not None and v.startswith(x),
    IsNotNull: lambda v, _: v is not None,
    IsNull: lambda v, _: v is None,
}
_HEADER_COLUMNS = ("page_id", "target_uri", "record_type", "payload_bytes", "payload_digest", "refers_to")


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "skip")
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _HEADER_COLUMNS:
                self.tests.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Range]:
        store, root = _open(self.path)
        found = [f for f in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.is_file]
        manifests = [f for f in found if f.base_name.startswith("_manifest-")]
        if not manifests:
            return [Range(f.path, 0, f.size) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        out = []
        for m in sorted(manifests, key=lambda f: f.base_name):
            with store.open_input_stream(m.path) as src:
                for f in json.loads(src.read()):
                    ends = [*f["cuts"][1:], f["size"]]
                    out += [Range(f"{root}/{f['name']}", a, b) for a, b in zip(f["cuts"], ends)]
        return out

    def read(self, part: Range):
        if part is None:
            return
        store, _ = _open(self.path)
        with store.open_input_file(part.file) as src:
            at = part.start
            while at < part.end:
                row, at = self._record(src, at)
                if row is not None:
                    yield row

    def _record(self, src, at: int):
        """(row or None, offset of the next record)."""
        data = src.read_at(FIRST_BYTES, at)
        packed = data[:2] == b"\x1f\x8b"
        length = None
        if packed:
            flag, extra = data[3], 10
            if flag & 4:
                size = struct.unpack_from("<H", data, 10)[0]
                if data[12:14] == b"sl":
                    length = struct.unpack_from("<I", data, 16)[0]
                extra = 12 + size
            inflate = zlib.decompressobj(-15)
            if flag & ~4:  # names or comments: leave the header to zlib
                inflate, extra = zlib.decompressobj(31), 0
            text = inflate.decompress(data[extra:])
        else:
            text = data
        read = at + len(data)
        while b"\r\n\r\n" not in text:  # long headers
            more = src.read_at(FIRST_BYTES, read)
            if not more:
                raise ValueError(f"record at {at} has no end of headers")
            text += inflate.decompress(more) if packed else more
            read += len(more)
        head, _, block = text.partition(b"\r\n\r\n")
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        http_end = block.find(b"\r\n\r\n")
        while http_end < 0 and len(block) < size:
            more = src.read_at(FIRST_BYTES, read)
            block += inflate.decompress(more) if packed else more
            read += len(more)
            http_end = block.find(b"\r\n\r\n")
        http = block[: max(http_end, 0)].decode("latin-1").lower()
        body = http_end + 4 if http.startswith("http/") else 0
        stated = next((int(x.partition(":")[2]) for x in http.split("\r\n") if x.startswith("content-length:")), size - body)
        row = {
            "page_id": _id_of(fields.get("warc-record-id")),
            "target_uri": fields.get("warc-target-uri"),
            "record_type": fields.get("warc-type"),
            "payload_bytes": stated,
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": _id_of(fields.get("warc-refers-to")),
        }
        wanted = all(_TESTS[kind](row[name], value) for name, kind, value in self.tests)
        decode = wanted and self.payload != "skip" and row["record_type"] != "revisit"
        if not packed:
            length = len(head) + 4 + size + 4
            if decode and len(block) < size:
                block += src.read_at(size - len(block), read)
        elif decode or length is None:
            if length is not None and read < at + length:
                block += inflate.decompress(src.read_at(at + length - read, read))
            while length is None and not inflate.eof:
                more = src.read_at(1 << 16, read)
                if not more:
                    break
                text = inflate.decompress(more)
                block += text if decode else b""
                read += len(more)
            if length is None:
                length = read - len(inflate.unused_data) - at
                length += 8 if flag & ~4 == 0 else 0
        if not wanted:
            return None, at + length
        payload = digest_ok = None
        if decode:
            payload = bytes(block[body:size])
            digest_ok = base64.b32encode(hashlib.sha1(payload).digest()).decode() == row["payload_digest"]
            if not digest_ok or len(payload) != stated:
                digest_ok = False
        return (*(row[c] for c in _HEADER_COLUMNS), digest_ok, payload if self.payload == "bytes" else None), at + length


class WarcDataSource(DataSource):
    """``format("warc")``; options ``path``, ``payload`` (skip, verify, bytes), ``roll_mb``, ``cut_mb``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, path: str, payload: str = "skip") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def archive_pages(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0
) -> str:
    """Write one record per page under ``path`` and return it."""
    register(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("target_uri"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha"),
        payload.alias("payload"),
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", "last", F.lit(True).alias("again"))
    )
    found = rows.join(repeated, "sha", "left")
    revisit = F.col("again").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    # base32 of the digest: eight groups of five hex digits give four letters each
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    group = lambda g: F.conv(F.substring("sha", 5 * g + 1, 5), 16, 10).cast("int")
    letters = [
        F.substr(alphabet, F.shiftright(group(g), 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1))
        for g in range(8)
        for k in (3, 2, 1, 0)
    ]
    found.select(
        "page_id",
        "target_uri",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "payload_bytes",
        F.concat(*letters).alias("payload_digest"),
        F.when(revisit, F.col("last")).alias("refers_to"),
        F.lit(None).cast("boolean").alias("digest_ok"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)
    return path


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), g AS (SELECT sha, max(page_id) AS last FROM p GROUP BY sha)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(sha, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM p JOIN g USING (sha)
"""


@query("op4_warc", SQL)
def op4_warc(spark, sf_dir):
    path = archive_pages(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    found = read_archive(spark, path, payload="verify")
    broken = F.raise_error(F.concat(F.lit("digest mismatch in page "), F.col("page_id").cast("string")))
    digest = F.when(F.col("digest_ok").eqNullSafe(False), broken.cast("string")).otherwise(F.col("payload_digest"))
    return found.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
