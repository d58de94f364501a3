"""WARC records in ZIP archives: writing, locating and range-reading.

An archive is a ZIP whose members are stored, not deflated: ``archive/data.warc.gz``
holds the records, each a gzip member of its own, and ``indexes/index.cdx`` one
line a record with its offset and length.  The reader never unpacks an archive:
it reads the end of the file, follows the (ZIP64) end records to the central
directory, finds the members' byte ranges, reads the index, and then fetches
ranges of records, archives being split over as many tasks as they have ranges.

Payloads are told apart by SHA-256.  Of records with equal payloads of at least
``min_revisit`` bytes the one with the smallest id is the response and the others
are revisits that name it.

Results by case: a null payload is empty; a null id is no one's reference (if all
ids of a payload are null, all its records are responses); rows that repeat the
smallest id are all responses; a null address gives a record without target; an
empty table gives no archive and no rows; only the id, address and payload columns are
read, so others may have any name; a long payload is held whole by one task.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.scratch import partitions, written
from weekloom.session import scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

#: A new archive is begun beyond this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Record bytes that one range read covers.
RANGE_BYTES = 8 << 20

_END = struct.Struct("<4sHHHHIIH")
_END64_PLACE = struct.Struct("<4sIQI")
_END64 = struct.Struct("<4sQHHIIQQQQ")
_ENTRY = struct.Struct("<4sHHHHHHIIIHHHHHII")
_LOCAL = struct.Struct("<4sHHHHHIIIHH")


def read_range(source, start: int, length: int) -> bytes:
    source.seek(start)
    data = source.read(length)
    if len(data) != length:
        raise ValueError(f"archive ends at {start + len(data)}, {start + length} expected")
    return data


def central_directory(source, size: int) -> tuple[int, int, int]:
    """(offset, length, entries) of the central directory of a ZIP of ``size`` bytes."""
    tail = read_range(source, max(0, size - _END.size - 0xFFFF - _END64_PLACE.size), min(size, _END.size + 0xFFFF + _END64_PLACE.size))
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0:
        end = _END.unpack_from(tail, at) if at + _END.size <= len(tail) else None
        if end and at + _END.size + end[7] == len(tail):
            break
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    entries, length, offset = end[4], end[5], end[6]
    if 0xFFFF in (entries, end[3]) or 0xFFFFFFFF in (length, offset):
        mark, _, place, _ = _END64_PLACE.unpack_from(tail, at - _END64_PLACE.size)
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        far = _END64.unpack(read_range(source, place, _END64.size))
        if far[0] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, offset = far[7], far[8], far[9]
    return offset, length, entries


def stored_members(source, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (first byte, length) of the stored members; others are left out."""
    offset, length, entries = central_directory(source, size)
    data, at, found = read_range(source, offset, length), 0, {}
    for _ in range(entries):
        entry = _ENTRY.unpack_from(data, at)
        if entry[0] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, packed, full, n_name, n_extra, n_note, local = entry[4], entry[8], entry[9], entry[10], entry[11], entry[12], entry[16]
        name = data[at + _ENTRY.size : at + _ENTRY.size + n_name].decode("utf-8")
        extra, k = data[at + _ENTRY.size + n_name : at + _ENTRY.size + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:  # ZIP64: the 64-bit values of those fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            k += 4 + n
        at += _ENTRY.size + n_name + n_extra + n_note
        if method == 0:
            head = _LOCAL.unpack(read_range(source, local, _LOCAL.size))
            if head[0] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            found[name] = (local + _LOCAL.size + head[9] + head[10], packed)
    return found


def record(kind: str, page: int | None, url: str | None, digest: str, payload: bytes, refers: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += ["WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(value: str | None) -> int | None:
    number = value[len("<urn:page:") : -1] if value else ""
    return int(number) if number else None


def parsed(raw: bytes) -> dict:
    """The fields of one record, its payload checked against the digest."""
    head, block = raw.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = block[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return {
        "page_id": _urn(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": _urn(fields.get("WARC-Refers-To")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _typed(pages: DataFrame, id_col: str, url_col: str, body_col: str, min_revisit: int) -> DataFrame:
    """(page, url, body, digest, refers): refers is set for revisits."""
    body = F.coalesce(F.col(f"`{body_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"), body.alias("body"), F.sha2(body.cast("binary"), 256).alias("digest")
    )
    large = rows.where(F.octet_length("body") >= min_revisit)
    first = large.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("same"), "first")
    first = written(first, "first")
    joined = rows.join(first, F.col("digest") == F.col("same"), "left")
    return joined.select("page", "url", "body", "digest", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("refers"))


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit: int = 100, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Archives of ``pages`` in ``folder``, which all executors must reach.
    Returns (path, bytes, records) of each.  A task that is run again writes new
    files; only those named in the result belong to it."""
    typed = _typed(pages, id_col, url_col, body_col, min_revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        archive = None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(5)), strict=True):
                page, url, body, digest, refers = (x.as_py() for x in row)
                kind = "response" if refers is None else "revisit"
                if archive is None:
                    archive = _Archive(fs, root, folder)
                archive.add(record(kind, page, url, digest, body.encode(), refers), page, digest)
                if archive.bytes >= archive_bytes:
                    yield archive.close()
                    archive = None
        if archive is not None:
            yield archive.close()

    return written(typed.mapInArrow(run, "path string, bytes bigint, records bigint"), "archives")


class _Archive:
    """One archive being written as a stream."""

    def __init__(self, fs: pafs.FileSystem, root: str, folder: str):
        self.name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.fs, self.at = f"{folder.rstrip('/')}/{self.name}", fs, f"{root.rstrip('/')}/{self.name}"
        self.out = fs.open_output_stream(self.at)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.bytes, self.index = 0, []

    def add(self, raw: bytes, page: int | None, digest: str) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        data = packer.compress(raw) + packer.flush()
        self.member.write(data)
        self.index.append(f"{'' if page is None else page} {self.bytes} {len(data)} {digest}\n")
        self.bytes += len(data)

    def close(self) -> pa.RecordBatch:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in self.index:
                index.write(line.encode())
        self.zip.close()
        self.out.close()
        size = self.fs.get_file_info(self.at).size
        columns = [pa.array([self.path]), pa.array([size]), pa.array([len(self.index)])]
        return pa.RecordBatch.from_arrays(columns, ["path", "bytes", "records"])


RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def read_ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, lengths): runs of neighbouring records, from the indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _filesystem(path)
                with fs.open_input_file(at) as source:
                    members = stored_members(source, source.size())
                    first, _ = members[DATA]
                    index = read_range(source, *members[INDEX])
                starts, runs, size = [], [], range_bytes
                for line in index.splitlines():
                    _, offset, length, _ = line.split(b" ")
                    if size >= range_bytes:
                        starts.append(first + int(offset))
                        runs.append([])
                        size = 0
                    runs[-1].append(int(length))
                    size += int(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(runs, pa.list_(pa.int64()))], ["path", "start", "lengths"]
                )

    spread = archives.select("path").repartition(partitions(archives.sparkSession), "path")
    return spread.mapInArrow(run, "path string, start bigint, lengths array<bigint>")


def read_archives(archives: DataFrame, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """RECORD rows of the archives named in ``path``; ``payloads`` false leaves
    the checked payloads out of the result."""
    # a row of a few kilobytes stands for a range: the number keeps them from being merged into one task
    ranges = read_ranges(archives, range_bytes).repartition(partitions(archives.sparkSession), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
            + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                fs, at = _filesystem(path)
                with fs.open_input_file(at) as source:
                    data = memoryview(read_range(source, start, sum(lengths)))
                rows, place = [], 0
                for n in lengths:
                    row = parsed(zlib.decompress(data[place : place + n], 31))
                    rows.append(row if payloads else row | {"payload": None})
                    place += n
                yield pa.RecordBatch.from_pylist(rows, kind)

    return ranges.mapInArrow(run, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Pages written to archives in the shared folder, and the records read back."""
    archives = write_archives(pages, scratch_path(spark, "warc"), min_revisit=min_revisit)
    return read_archives(archives, payloads=False)
