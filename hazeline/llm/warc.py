"""WARC archives with a two-level capture index.

Writing: each task streams its rows into one file of gzip members, one record
each, and reports where every record lies. Of equal payloads the one with the
largest page id is a response, the others are revisits of it without a payload.
Files get a new name per attempt and only those that a finished task reported
are ever read, so lost or repeated tasks do no harm.

Index: captures are sorted by reversed-host URL key over range partitions; each
partition becomes one index file of compressed blocks of ``BLOCK_LINES`` lines
followed by its directory, the first key and place of every block. The second
level is one line per index file, so its size is the number of partitions.

Lookup: wanted keys are range-partitioned and sorted too. For each, the file
list and that file's directory are binary-searched, one block is read by range
and searched, and the record is read by range from its archive, in file order.

Defined cases: a NULL payload is empty; equal payloads of any size, empty ones
too, revisit; a row with a NULL page id is a response and never revisited;
repeated rows with the largest id are responses both. A NULL URL is
``about:blank``; an unparsable one is its own key. An empty table gives empty
archives and an empty index. Files go below the session's shared folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stored, work_dir

BLOCK_LINES = 3000
BLANK = "about:blank"
RECORD_ID = "urn:x-page:"
#: All records of an archive are dated by one parameter, so reruns write the same bytes.
DATE = datetime(2025, 1, 1, tzinfo=timezone.utc)

CAPTURES = "surt string, page_id long, file string, offset long, length long"
FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def surt_key(url: str) -> str:
    """``http://www.a.org:80/x?y#z`` becomes ``org,a,www)/x?y``; what has no host is its own key."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    usual = {"http": 80, "https": 443}.get(parts.scheme)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != usual else "")
    return f"{where}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def one_line(text: str) -> str:
    """A header value or key may hold no line ends."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit keeps the HTTP header, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE:%Y-%m-%dT%H:%M:%SZ}", f"WARC-Target-URI: {one_line(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{RECORD_ID}{refers_to}>"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n", 3, mtime=0)


def parsed(member: bytes) -> dict:
    """What a record says; the payload and its digest are checked against each other."""
    raw = zlib.decompress(member, 31)
    head, rest = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    named = lambda f: int(v) if (v := fields[f][len(RECORD_ID) + 1:-1]) else None
    revisit, digest = fields["WARC-Type"] == "revisit", fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": named("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": named("WARC-Refers-To") if revisit else None, "payload": None if revisit else payload}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, by its whole address."""
    return fs.FileSystem.from_uri(path)


def address(spark: SparkSession, path: str) -> str:
    """A folder's whole address, its file system included: that of Spark's own files where the path names none.

    Spark writes a bare path to its default file system. Executors must open the
    same one, so the driver qualifies the path before it is sent to them.
    """
    bare = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = bare.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(bare).toString()
    return whole if "://" in whole else whole.replace(":/", ":///", 1)


def revisits(pages: DataFrame) -> DataFrame:
    """(of_page, of_digest, refers_to): rows that repeat the payload of a larger page id."""
    seen = stored(pages.select("page_id", F.sha1("payload").alias("digest")), "warc-digests")
    kept = stored(seen.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-kept")
    return stored(seen.join(kept, "digest").where("page_id < refers_to").select(F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"), "refers_to").distinct(), "warc-revisits")


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write one record per (page_id, url, html) row; returns the captures (surt, page_id, file, offset, length)."""
    root = address(pages.sparkSession, folder or work_dir(pages.sparkSession, "warc"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit(BLANK)).alias("url"),
                        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    again = revisits(rows)
    # Page ids are dealt out evenly, whatever the payloads have in common.
    decided = rows.join(again, (F.col("page_id") == F.col("of_page")) & (F.sha1("payload") == F.col("of_digest")), "left").select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(root)
        system.create_dir(path, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                places = []
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                    data = record(page_id, url, payload, payload_digest(payload), refers_to)
                    out.write(data)
                    places.append((one_line(surt_key(url)), page_id, name, at, len(data)))
                    at += len(data)
                columns = zip(*places) if places else [[]] * 5
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["surt", "page_id", "file", "offset", "length"])
        finally:
            if out:
                out.close()

    captures = stored(decided.mapInArrow(write, CAPTURES), "warc-captures")
    return captures.withColumn("file", F.concat(F.lit(root + "/"), "file"))


Entry = tuple[tuple[str, int], str, int, int]


def capture_order(surt: str, page_id: int | None) -> tuple[str, int]:
    """The index order of captures: by key, then page id, NULL first, as Spark sorts them."""
    return surt, -(1 << 63) - 1 if page_id is None else page_id


def write_index(captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES) -> list[Entry]:
    """Write the index files; returns their list: (first capture, file, offset and length of its directory), in order."""
    root = address(captures.sparkSession, folder or work_dir(captures.sparkSession, "cdx"))
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.select("surt", "page_id", "file", "offset", "length").repartitionByRange(n, "surt", "page_id").sortWithinPartitions("surt", "page_id", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(root)
        system.create_dir(path, recursive=True)
        name, directory, lines, at, out = f"{uuid.uuid4().hex}.cdx.gz", [], [], 0, None

        def flush() -> int:
            data = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            directory.append([*json.loads(lines[0])[:2], at, len(data)])
            out.write(data)
            lines.clear()
            return len(data)

        for batch in batches:
            for capture in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(json.dumps(capture, ensure_ascii=False))
                if len(lines) == block_lines:
                    at += flush()
        if out:
            if lines:
                at += flush()
            data = gzip.compress(json.dumps(directory, ensure_ascii=False).encode(), 6, mtime=0)
            out.write(data)
            out.close()
            columns = [pa.array([directory[0][0]], pa.string()), pa.array([directory[0][1]], pa.int64()), pa.array([f"{root}/{name}"]),
                       pa.array([at], pa.int64()), pa.array([len(data)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["surt", "page_id", "file", "offset", "length"])

    files = stored(ordered.mapInArrow(write, CAPTURES), "cdx-files")
    # Code-point order is what Python compares, and what Spark sorted by.
    return sorted((capture_order(r.surt, r.page_id), r.file, r.offset, r.length) for r in files.toLocalIterator())


class Ranges:
    """Range reads of files, keeping the last file open."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            system, path = opened(name)
            self.name, self.file = name, system.open_input_file(path)
        return self.file.read_at(length, offset)


class Index:
    """Binary search over the file list, a file's directory, and a block; the last of each is kept."""

    def __init__(self, files: list[Entry]):
        self.files, self.firsts = files, [f[0] for f in files]
        self.ranges, self.at, self.directory, self.block_at, self.block = Ranges(), None, [], None, []

    def _directory(self, k: int) -> list:
        if k != self.at:
            _, name, offset, length = self.files[k]
            rows = json.loads(gzip.decompress(self.ranges.read(name, offset, length)))
            self.at, self.directory, self.block_at = k, [(capture_order(*r[:2]), *r[2:]) for r in rows], None
        return self.directory

    def _block(self, k: int, b: int) -> list:
        _, offset, length = self._directory(k)[b]
        if self.block_at != (k, b):
            lines = gzip.decompress(self.ranges.read(self.files[k][1], offset, length)).decode().split("\n")
            captures = list(map(json.loads, lines))
            self.block_at, self.block = (k, b), [(capture_order(*c[:2]), c) for c in captures]
        return self.block

    def captures(self, low: tuple[str, int], high: tuple[str, int]) -> Iterator[list]:
        """All captures from ``low`` to ``high``; they may begin in the file or block before the first that starts there."""
        k = max(0, bisect_left(self.firsts, low) - 1)
        while k < len(self.files) and self.firsts[k] <= high:
            directory = self._directory(k)
            b = max(0, bisect_left(directory, low, key=lambda d: d[0]) - 1)
            while b < len(directory) and directory[b][0] <= high:
                block = self._block(k, b)
                for _, capture in block[bisect_left(block, low, key=lambda c: c[0]):bisect_right(block, high, key=lambda c: c[0])]:
                    yield capture
                b += 1
            k += 1


def look_up(wanted: DataFrame, files: list[Entry]) -> DataFrame:
    """Captures (surt, page_id, file, offset, length) of the URLs in column ``url``, each distinct one once.

    With a column ``page_id`` only the capture of that page is found, so wanted
    rows of one URL, however many, are spread over tasks. ``files`` is the list
    that ``write_index`` gave: one entry per index file.
    """
    exact = "page_id" in wanted.columns

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            surts = [one_line(surt_key(BLANK if u is None else u)) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(surts, pa.string()), batch.column(1)], names=["surt", "page_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, kinds = Index(files), [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

        def as_batch(found: list) -> pa.RecordBatch:
            columns = zip(*found) if found else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["surt", "page_id", "file", "offset", "length"])

        for batch in batches:
            found = []
            for surt, page_id in zip(*(c.to_pylist() for c in batch.columns)):
                low = capture_order(surt, page_id)
                for capture in index.captures(low, low if exact else (surt, 1 << 63)):
                    found.append(capture)
                    if len(found) == 10_000:
                        yield as_batch(found)
                        found = []
            yield as_batch(found)

    page = F.col("page_id").cast("long") if exact else F.lit(None).cast("long")
    asked = wanted.select("url", page.alias("page_id")).mapInArrow(keys, "surt string, page_id long").distinct()
    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartitionByRange(n, "surt", "page_id").sortWithinPartitions("surt", "page_id").mapInArrow(search, CAPTURES)


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the captures' places, read by range in file order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for a in range(0, batch.num_rows, 500):
                records = [parsed(ranges.read(f, o, n)) for f, o, n in zip(*(c[a:a + 500] for c in columns))]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in records], t) for c, t in zip(names, kinds)], names=names)

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = captures.select("file", "offset", "length")
    return placed.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, FOUND)
