"""Web archives in ZIP packages: write pages as WARC records, read them back by range.

Writing: pages with equal payloads of at least ``min_revisit_bytes`` keep one
``response`` record (the largest page id); the others become ``revisit`` records
that refer to it. Each task streams its records into ZIP packages of bounded size:
one stored member ``archive/data.warc.gz`` (one gzip member per record) and a
stored index ``indexes/index.cdxj`` with every record's place. File names carry
the task attempt, and only files named in the written manifest are ever read, so
a task that is lost and run again leaves nothing behind that counts.

Reading: the end record, the ZIP64 records where present, and the central
directory are parsed from ranges of the file; the index gives the records'
places; neighbouring records are read as one range and unpacked alone. No package
is extracted.

Null html is an empty payload, a null url an empty one. A null page id is kept and
counts as smaller than every other; rows that repeat a page id and its payload are
all the response. An empty table writes no package and reads back no row; extra
columns are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import encoded_of, materialise, on_workers
from statforge.session import scratch_path

#: A payload of at least so many bytes is stored once.
MIN_REVISIT_BYTES = 0
#: Compressed bytes after which a task begins its next package.
PACKAGE_BYTES = 256 << 20
#: Bytes of neighbouring records read as one range.
RANGE_BYTES = 4 << 20
#: A payload of more than one in so many pages is common; there are fewer of these than this.
COMMON = 1000

# Fixed values of the formats: member names, header names and record signatures.
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END_SIG, END64_SIG, LOCATOR_SIG, ENTRY_SIG = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02"

MANIFEST = "package string, n_records long, n_bytes long"
UNITS = "package string, at long, n_bytes long, records array<struct<offset:long,length:long>>"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


# --------------------------------------------------------------------------- files
def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path in the shared folder (a URI or a plain path)."""
    m = re.match(r"file:/*", path)
    return (pafs.LocalFileSystem(), "/" + path[m.end() :]) if m else pafs.FileSystem.from_uri(path)


# --------------------------------------------------------------------------- records
def payload_digest(payload: bytes) -> str:
    """Bare upper-case base-32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    text = uri[len("<urn:page:") : -1] if uri else ""
    return int(text) if text else None


def _header_value(text: str) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit that carries no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_value(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {_page_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(raw: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    revisit = warc["warc-type"] == "revisit"
    if not revisit and payload_digest(payload) != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
    return {
        "page_id": _page_of(warc["warc-record-id"]),
        "url": warc["warc-target-uri"],
        "record_type": warc["warc-type"],
        "refers_to": _page_of(warc.get("warc-refers-to")),
        "payload_bytes": int(_headers(http)["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


# --------------------------------------------------------------------------- packages
class PackageWriter:
    """Streams records into one ZIP package; only the index lines are kept in memory."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.path, self.lines, self.offset = path, [], 0
        self._out = fs.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True)

    def add(self, page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(record_bytes(page_id, url, payload, refers_to)) + packer.flush()
        self._data.write(packed)
        self.lines.append(json.dumps({"url": url, "offset": self.offset, "length": len(packed)}))
        self.offset += len(packed)

    def close(self) -> tuple[int, int]:
        """Finish the package: number of records and bytes of records."""
        self._data.close()
        with self._zip.open(zipfile.ZipInfo(INDEX_MEMBER), "w") as f:
            f.write("".join(f"{x}\n" for x in self.lines).encode())
        self._zip.close()
        self._out.close()
        return len(self.lines), self.offset


def _at(f, offset: int, length: int) -> bytes:
    f.seek(offset)
    return f.read(length)


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """``name -> (method, local header offset, packed size)`` from the central directory."""
    tail_at = max(0, size - 22 - 65535)
    tail = _at(f, tail_at, size - tail_at)
    end = tail.rfind(END_SIG, 0, max(len(tail) - 18, 0))  # the end record has 22 bytes at least
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END_SIG, 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if (count == 0xFFFF or 0xFFFFFFFF in (length, start)) and locator >= 0 and _at(f, locator, 4) == LOCATOR_SIG:
        place = struct.unpack("<Q", _at(f, locator + 8, 8))[0]
        record = _at(f, place, 56)
        if record[:4] != END64_SIG:
            raise ValueError("no ZIP64 end record where its locator points")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    block, at, out = _at(f, start, length), 0, {}
    for _ in range(count):
        if block[at : at + 4] != ENTRY_SIG:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", block, at + 10)[0]
        packed, plain = struct.unpack_from("<II", block, at + 20)
        names, extras, comment = struct.unpack_from("<HHH", block, at + 28)
        offset = struct.unpack_from("<I", block, at + 42)[0]
        name = block[at + 46 : at + 46 + names].decode("utf-8")
        extra, k = block[at + 46 + names : at + 46 + names + extras], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # the wide values stand in this order, each only if its narrow field is full
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            k += 4 + n
        out[name] = (method, offset, packed)
        at += 46 + names + extras + comment
    return out


def member_range(f, entry: tuple[int, int, int]) -> tuple[int, int]:
    """Where the bytes of a stored member begin, and how many there are."""
    method, offset, packed = entry
    if method != 0:
        raise ValueError("only stored members can be read by range")
    names, extras = struct.unpack("<HH", _at(f, offset + 26, 4))
    return offset + 30 + names + extras, packed


def work_units(package: str) -> Iterator[dict]:
    """Ranges of neighbouring records of one package, from its directory and its index."""
    fs, path = filesystem(package)
    with fs.open_input_file(path) as f:
        members = directory(f, f.size())
        data, _ = member_range(f, members[DATA_MEMBER])
        at, length = member_range(f, members[INDEX_MEMBER])
        unit: dict | None = None
        for line in _at(f, at, length).decode().splitlines():
            entry = json.loads(line)
            if unit and unit["n_bytes"] + entry["length"] > RANGE_BYTES:
                yield unit
                unit = None
            if unit is None:
                unit = {"package": package, "at": data + entry["offset"], "n_bytes": 0, "records": []}
            unit["records"].append({"offset": unit["n_bytes"], "length": entry["length"]})
            unit["n_bytes"] += entry["length"]
        if unit:
            yield unit


# --------------------------------------------------------------------------- Spark
def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def with_references(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to`` (null for responses).

    Only payloads that occur more than once are looked up. Those that make up more than
    one in ``COMMON`` of all pages are at most ``COMMON``; they are broadcast, and their pages
    are spread over all tasks. The others are written first, so the planner knows their
    size and shuffles the pages only where it must; none of them is a large group.
    """
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("payload_key", F.sha1(F.col("html").cast("binary")))
    again = p.where(F.octet_length("html") >= min_revisit_bytes).groupBy("payload_key").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper")).where("n > 1")
    again = materialise(again, "payloads")
    often = F.col("n") * COMMON > pages.count()
    common = again.where(often).select("payload_key", F.col("keeper").alias("common_keeper"), F.lit(True).alias("common"))
    found = p.join(F.broadcast(common), "payload_key", "left")
    # pages of a common payload are looked up under names that nothing has, each task's share of them under its own
    spread = F.concat(F.lit("#"), F.xxhash64("page_id", "url").cast("string"))
    found = found.withColumn("payload_key", F.when(F.col("common"), spread).otherwise(F.col("payload_key")))
    joined = found.join(again.where(~often).select("payload_key", "keeper"), "payload_key", "left")
    keeper = F.when(F.col("common"), F.col("common_keeper")).otherwise(F.col("keeper"))
    other = keeper.isNotNull() & ~keeper.eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", F.when(other, keeper).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages below ``folder``; the manifest of the packages, itself written."""
    schema = _arrow(MANIFEST, pages.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        task = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out: list[tuple[str, int, int]] = []
        writer, name = None, ""

        def close() -> None:
            if writer:
                out.append((f"{folder.rstrip('/')}/{name}", *writer.close()))

        for b in batches:
            ids, urls, refers = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()
            for page_id, url, payload, refers_to in zip(ids, urls, encoded_of(b.column(2)), refers, strict=True):
                if writer is None or writer.offset >= PACKAGE_BYTES:
                    close()
                    name = f"pages-{task}-{len(out):04d}.wacz"
                    writer = PackageWriter(fs, f"{base.rstrip('/')}/{name}")
                writer.add(page_id, url, payload, refers_to)
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    on_workers(pages.sparkSession)
    return materialise(with_references(pages, min_revisit_bytes).mapInArrow(written, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the packages of a manifest."""
    spark = manifest.sparkSession
    units_schema, records_schema = _arrow(UNITS, spark), _arrow(RECORDS, spark)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for package in b.column(0).to_pylist():
                if rows := list(work_units(package)):
                    yield pa.RecordBatch.from_pylist(rows, schema=units_schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for unit in b.to_pylist():
                fs, path = filesystem(unit["package"])
                with fs.open_input_file(path) as f:
                    raw = _at(f, unit["at"], unit["n_bytes"])
                rows = [parse_record(zlib.decompress(raw[r["offset"] : r["offset"] + r["length"]], 31)) for r in unit["records"]]
                if not with_payload:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_pylist(rows, schema=records_schema)

    on_workers(spark)
    units = manifest.select("package").mapInArrow(listed, UNITS)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, "package", "at").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """The contract's columns: write every page, then read all packages back."""
    manifest = write_archives(pages, scratch_path(pages.sparkSession, "llm-packages"))
    return read_archives(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
