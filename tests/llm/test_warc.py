import hashlib
import io
import zipfile

from pyspark.sql import functions as F

from weekloom.llm import warc
from weekloom.llm.warc import DATA, read_archives, stored_members, write_archives
from weekloom.session import scratch_path

BIG, LARGE = "<p>é" * 60, "x" * 3_000_000
ROWS = [(7, "http://a", BIG), (3, None, BIG), (9, "u\nv", BIG), (3, "http://c", BIG), (None, "http://d", BIG), (1, "", None), (2, "e", ""), (5, "f", "short"), (6, "g", "short"), (8, "h", LARGE), (None, "i", "z" * 200), (None, "j", "z" * 200)]


def want():
    out = []
    for page, _, body in ROWS:
        raw = (body or "").encode()
        ids = [p for p, _, b in ROWS if b == body and p is not None]
        refers = min(ids) if len(raw) >= 100 and ids and page != min(ids) else None
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")


def test_round_trip_over_small_archives(spark, monkeypatch):
    made = write_archives(pages(spark, ROWS).repartition(3), scratch_path(spark, "warc"), archive_bytes=300)
    assert made.count() > 3
    records = read_archives(made).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=repr) == want()
    assert {bytes(r.payload) for r in records if r.record_type == "response"} == {(b or "").encode() for _, _, b in ROWS}
    assert {r.url for r in records} == {u.replace("\n", "%0A") if u is not None else None for _, u, _ in ROWS}


def test_ranges_are_read_in_parallel(spark):
    rows = [(k, f"http://{k}", f"page {k} " * 50) for k in range(60)]
    made = write_archives(pages(spark, rows), scratch_path(spark, "warc"), archive_bytes=2000)
    records = read_archives(made, range_bytes=1)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert records.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert records.select(F.spark_partition_id().alias("p")).distinct().count() > 1 and records.count() == 60


def test_empty_table(spark):
    assert read_archives(write_archives(pages(spark, []), scratch_path(spark, "warc"))).collect() == []


def test_directories_of_other_writers():
    def made(**how):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("deflated.txt", b"y" * 500, zipfile.ZIP_DEFLATED)
            z.writestr(DATA, b"record bytes", zipfile.ZIP_STORED)
            z.comment = how.get("comment", b"")
        return out.getvalue()

    for data in (made(), made(comment=b"with PK\x05\x06 inside" * 40)):
        found = stored_members(io.BytesIO(data), len(data))
        start, length = found[DATA]
        assert list(found) == [DATA] and data[start : start + length] == b"record bytes"


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for k in range(5):
            z.writestr(f"member{k}", bytes([k]) * 150)
    data = out.getvalue()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    offset, length, entries = warc.central_directory(io.BytesIO(data), len(data))
    assert entries == 5
    for k, (start, size) in enumerate(stored_members(io.BytesIO(data), len(data)).values()):
        assert data[start : start + size] == bytes([k]) * 150
