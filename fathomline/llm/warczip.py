"""WARC in ZIP packages, written and range-read.

Writer: each task packs its records, in files of about ``ARCHIVE_BYTES`` of payload, into a ZIP with two stored
members, ``archive/data.warc`` and ``indexes/index.cdxj`` (one JSON line per record: page, offset and length in the
WARC, digest). Files go through ``pyarrow.fs`` into the shared folder (names of Hadoop's object-store connectors, such as s3a,
are translated) under names no other attempt uses; only
those named in the manifest (a table in the shared folder) count, so lost executors and repeated tasks do no harm.

Reader: from the end of the file it finds the end-of-central-directory record, the ZIP64 locator and record where
sizes ask for them, and the central directory; then the stored members' data offsets; then it reads the indexes and
each record's byte range. A package may hold several archives and indexes (``archive/*.warc``, ``indexes/*.cdxj``): a line that
names its archive (``filename``) is read from that one, others from the only one. Nothing is extracted. Compressed
members, and lines that name no archive where there are several, are refused with ``ValueError``. Very long texts are one
record each, held whole by the task that writes or reads them.

Records of equal payloads of at least ``REVISIT_BYTES`` bytes: that of the largest page_id is the response, the
others are revisits of it, without the payload. Edge cases: a null html is an empty payload; a null page_id is
written as such and sorts below all ids; repeated rows of one page_id are each written, and the copies of the
largest id are all responses; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import dicts, shared_dir, small_batches, staged

ARCHIVE_BYTES = 32 << 20
REVISIT_BYTES = 1000
#: Places of the bitmap that tells which pages may be revisits, at most.
FILTER_BITS = 1 << 24
DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
# Scheme names of Hadoop's connectors, by the names of the same stores in pyarrow.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


# -- records


def warc_record(page: int | None, url: str | None, kind: str, refers: int | None, payload: bytes, digest: str, size: int) -> bytes:
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Target-URI: {(url or 'about:blank').replace(chr(13), ' ').replace(chr(10), ' ')}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {size}", *([f"WARC-Refers-To: <urn:page:{refers}>"] if refers is not None else []),
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_warc(record: bytes) -> tuple[dict[str, str], bytes]:
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('WARC-Record-ID')}: its length is not what it says")
    return headers, rest[:size]


# -- packages


def zip_package(records: list[tuple[dict, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        lines, at = [], 0
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as f:
            for entry, record in records:
                f.write(record)
                lines.append(json.dumps(entry | {"offset": at, "length": len(record)}, sort_keys=True))
                at += len(record)
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines) + "\n" * bool(lines))
    return out.getvalue()


def directory(size: int, read: Callable[[int, int], bytes]) -> dict[str, tuple[int, int, int]]:
    """Of the ZIP behind ``read(offset, length)``: name to (data offset, data length, method)."""
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    data, found, p = read(start, length), {}, 0
    for _ in range(count):
        if data[p : p + 4] != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        flags, method = struct.unpack_from("<HH", data, p + 8)
        packed, plain = struct.unpack_from("<II", data, p + 20)
        n, m, k = struct.unpack_from("<HHH", data, p + 28)
        local = struct.unpack_from("<I", data, p + 42)[0]
        name = data[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = data[p + 46 + n : p + 46 + n + m], 0
        while e + 4 <= len(extra):
            tag, size_of = struct.unpack_from("<HH", extra, e)
            if tag == 1:  # ZIP64: only the fields that overflow, in this order
                q = e + 4
                if plain == 0xFFFFFFFF:
                    plain, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                if packed == 0xFFFFFFFF:
                    packed, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                if local == 0xFFFFFFFF:
                    local = struct.unpack_from("<Q", extra, q)[0]
            e += 4 + size_of
        header = read(local, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        a, b = struct.unpack_from("<HH", header, 26)
        found[name] = (local + 30 + a + b, packed, method)
        p += 46 + n + m + k
    return found


def file_system(path: str):
    """(file system, path in it) of a URI of the shared folder."""
    import pyarrow.fs

    scheme, found, rest = path.partition("://")
    return pyarrow.fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}" if found else path)


def open_package(path: str):
    """An open file of a package in the shared folder, through the file system its URI names."""
    fs, inner = file_system(path)
    return fs.open_input_file(inner)


def range_records(path: str) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """(index entry, headers, stored payload) of each record, each read by its byte range."""
    with open_package(path) as f:
        read = lambda offset, length: f.read_at(length, offset)
        members = directory(f.size(), read)
        archives = [n for n in members if n.startswith("archive/") and n.endswith(".warc")]
        indexes = sorted(n for n in members if n.startswith("indexes/") and n.endswith(".cdxj"))
        if not archives or not indexes:
            raise ValueError(f"{path}: an archive and an index are expected, found {sorted(members)}")
        for name in (*archives, *indexes):
            if members[name][2] != zipfile.ZIP_STORED:
                raise ValueError(f"{path}: {name} is compressed; only stored members can be range-read")
        for name in indexes:
            for line in read(*members[name][:2]).decode().splitlines():
                entry = json.loads(line)
                archive = f"archive/{entry['filename']}" if "filename" in entry else archives[0]
                if archive not in archives or ("filename" not in entry and len(archives) > 1):
                    raise ValueError(f"{path}: {name} has a line that names none of {sorted(archives)}")
                base, size, _ = members[archive]
                if entry["offset"] + entry["length"] > size:
                    raise ValueError(f"{path}: {name} has a line that leaves {archive}")
                yield entry, *parse_warc(read(base + entry["offset"], entry["length"]))


def write_packages(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, kind, refers_to, payload, digest, size) rows; the manifest (path, records, bytes)."""
    folder = f"{shared_dir(records.sparkSession)}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            fs, inner = file_system(path)
            fs.create_dir(inner.rpartition("/")[0], recursive=True)
            data = zip_package(held)
            with fs.open_output_stream(inner) as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)], pa.int64()), pa.array([len(data)], pa.int64())], ["path", "records", "bytes"])

        for b in dicts(batches):
            for page, url, kind, refers, payload, digest, n in zip(*(b[c] for c in ("page_id", "url", "kind", "refers_to", "payload", "digest", "size")), strict=True):
                body = payload if kind == "response" else b""
                record = warc_record(page, url, kind, refers, body, digest, n)
                held.append(({"page": page, "digest": digest}, record))
                size += len(record)
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    small_batches(records.sparkSession)
    return staged(records.select("page_id", "url", "kind", "refers_to", "payload", "digest", "size").mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_packages(manifest: DataFrame) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of all packages named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page_of = lambda urn: None if urn is None or urn == "<urn:page:None>" else int(urn[10:-1])
        for b in dicts(batches):
            for path in b["path"]:
                rows = []
                for entry, headers, payload in range_records(path):
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(headers["Payload-Length"])):
                        raise ValueError(f"{path}: {headers['WARC-Record-ID']} does not have the digest or length it states")
                    rows.append((page_of(headers["WARC-Record-ID"]), int(headers["Payload-Length"]), digest, kind, page_of(headers.get("WARC-Refers-To")), payload))
                    if len(rows) == 256:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(min(files, 100_000)).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def revisit_filter(revisits: DataFrame, rows: int) -> DataFrame:
    """One row, ``bits``: a bitmap of the (page_id, digest) of revisits as 64-bit words, of up to ``FILTER_BITS`` places."""
    size = min(FILTER_BITS, max(1 << 10, 1 << (16 * rows).bit_length()))
    place = F.pmod(F.xxhash64("page_id", "digest"), F.lit(size))
    words = revisits.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    full = revisits.sparkSession.range(size // 64).withColumnRenamed("id", "word").join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return staged(full.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits")), "warc-filter")  # a bounded number of words


def as_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages as records, responses and revisits decided.

    Only (digest, largest page) of digests that occur more than once meet in a shuffle, after partial
    aggregation; the revisits' (page, digest) make a bitmap. Pages that it does not have are responses and stay in the task that
    reads them, so their payloads are not shuffled. The others (the revisits, and responses that share a place of the bitmap with one) get their
    decision by a join on (page, digest), not on the digest alone, so that thousands of copies of one page are dealt to all tasks.
    The bitmap's size changes what is shuffled, never the result.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", html.alias("payload")).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    slim = staged(pages.where(F.col("size") >= least).select("page_id", "digest"), "warc-digests")
    top = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    top = staged(top, "warc-responses")  # a table on its own: a skewed join of it can be split, or it is broadcast by its size
    revisits = staged(slim.distinct().join(top, "digest").where("page_id is null or page_id < refers_to").where("refers_to is not null"), "warc-revisits")

    def records(of: DataFrame, kind: Column, refers: Column) -> DataFrame:
        return of.select("p.page_id", "p.url", kind.alias("kind"), refers.alias("refers_to"), "p.payload", "p.digest", "p.size")

    alone = lambda of: records(of.alias("p"), F.lit("response"), F.lit(None).cast(revisits.schema["refers_to"].dataType))
    rows = revisits.count()
    if not rows:
        return alone(pages)
    bits = revisit_filter(revisits, rows)
    place = F.pmod(F.xxhash64("page_id", "digest"), F.size(bits.scalar()).cast("long") * 64)
    found = (F.col("size") >= least) & (F.getbit(F.get(bits.scalar(), F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1)
    joined = pages.where(found).alias("p").join(revisits.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest")), "left")
    kind = F.when(F.col("r.refers_to").isNull(), "response").otherwise("revisit")
    return alone(pages.where(~found)).unionByName(records(joined, kind, F.col("r.refers_to")))


def query(pages: DataFrame) -> DataFrame:
    return read_packages(write_packages(as_records(pages))).drop("payload")


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM t
"""
