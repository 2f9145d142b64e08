import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from prepspark.llm.common import scratch
from prepspark.llm.warc import Range, WarcReader, archive_pages, gzip_member, read_archive, record_bytes

PAGES = [
    (1, "http://a.example/ü x", "<p>é</p>"), (2, "http://b.example/", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "http://c.example/\r\nX: y", "<b>" * 5000),
    (6, "http://a.example/2", "last"), (7, "http://a.example/3", "<p>é</p>"), (7, "http://a.example/3", "<p>é</p>"), (None, "n", "<p>é</p>"), (None, "n", "only null"),
]


def pages(spark):
    docs = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return docs.selectExpr("*", "1 AS sha", "2 AS payload", "'x' AS record_type", "3 AS last", "true AS again")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_with_revisits(spark):
    rows = read_archive(spark, archive_pages(pages(spark), scratch(spark, "warc")), "bytes").collect()
    largest = {}
    for i, _, html in PAGES:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    expected = []
    for i, _, html in PAGES:
        top = largest.get(html or "")
        revisit = top is not None and i != top
        expected.append((i, "revisit" if revisit else "response", len((html or "").encode()), digest(html), top if revisit else None))
    got = [(r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    html = {i: (h or "").encode() for i, _, h in PAGES}
    for r in rows:
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload) == html[r.page_id] and r.digest_ok
        if r.record_type == "revisit":
            assert r.payload is None and r.digest_ok is None


def test_small_payloads_are_all_responses(spark):
    rows = read_archive(spark, archive_pages(pages(spark), scratch(spark, "warc"), min_bytes=100)).collect()
    assert {r.record_type for r in rows} == {"response"} and all(r.payload is None and r.digest_ok is None for r in rows)


def test_predicates_reach_the_reader(spark):
    found = read_archive(spark, archive_pages(pages(spark), scratch(spark, "warc")))
    kept = found.where("record_type = 'revisit' AND payload_bytes > 3 AND target_uri LIKE 'http://b%'").collect()
    assert [r.page_id for r in kept] == [2]
    assert found.where(F.col("page_id").isin(5, 6)).count() == 2 and found.where("page_id IS NULL").count() == 2


def test_skipped_payloads_are_not_decoded(spark, tmp_path):
    """A payload damaged behind its headers hurts only readers that want it."""
    records = [gzip_member(record_bytes(i, "u", bytes(range(256)) * 400, 102_400, "X", "response", None)) for i in (1, 2)]
    broken = bytearray(records[0])
    broken[5000:9000] = b"\xff" * 4000 if len(broken) > 9500 else broken[5000:9000]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(bytes(broken) + records[1])
    reader = WarcReader({"path": str(tmp_path)})
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    assert [r[0] for r in rows] == [1, 2]


def test_foreign_archives(tmp_path):
    """Plain files, and gzip members without a length field."""
    records = [record_bytes(i, f"http://x/{i}", b"body%d" % i * 3000, 15_000, digest("body%d" % i * 3000), "response", None) for i in (1, 2, 3)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for name in ("a.warc", "b.warc.gz"):
        for payload in ("skip", "verify", "bytes"):
            reader = WarcReader({"path": str(tmp_path), "payload": payload})
            rows = list(reader.read(Range(str(tmp_path / name), 0, (tmp_path / name).stat().st_size)))
            assert [r[0] for r in rows] == [1, 2, 3]
            assert [r[6] for r in rows] == [None if payload == "skip" else True] * 3
            assert [r[7] for r in rows] == ([b"body%d" % i * 3000 for i in (1, 2, 3)] if payload == "bytes" else [None] * 3)


def test_empty_table(spark):
    none = pages(spark).where("false")
    assert read_archive(spark, archive_pages(none, scratch(spark, "warc"))).count() == 0
