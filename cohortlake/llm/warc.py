"""Web archives: write pages as monolithic gzip WARC files, normalise them so
that every record is a gzip member of its own, with a sidecar offset index, and
read the records back by offset.

``write_archives``: each task writes its rows as one archive, a single gzip
stream, in the shared folder (an archive is as large as an input split).
``normalise``: each archive's stream is inflated once, record by record; every
record is rewritten as its own member, as a revisit where an equal payload is
kept elsewhere, and its offset and length go to the sidecar ``.idx``.
``read_back``: opens each normalised archive by its index and parses each member.

Files are written under a temporary name and renamed, and their content is a
function of the rows alone, so a repeated task replaces a file by an equal one.

Defined results: a null html is an empty payload, a null url gives no target
URI, a null page_id writes no page id and is the smallest; payloads of any
length go through whole; of repeated rows the first in archive order is the
response; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import Scratch

REVISIT_BYTES = 1000  # payloads below are always kept
CHUNK = 1 << 20
TASKS = 20_000  # tasks at most that archives are spread over
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # of every record: pages have no date of their own


def gzip_writer() -> zlib._Compress:
    return zlib.compressobj(LEVEL, zlib.DEFLATED, 16 + zlib.MAX_WBITS)


def record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if kind == "revisit" else http + payload
    name = f"urn:sha1:{digest}" if page_id is None else f"urn:page:{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Stream:
    """Bytes of an inflated gzip stream of one or more members, read forward once."""

    def __init__(self, raw):
        self.raw, self.inflate, self.held = raw, zlib.decompressobj(16 + zlib.MAX_WBITS), bytearray()
        self.left = b""

    def more(self) -> bool:
        data = self.left or self.raw.read(CHUNK)
        self.left = b""
        if not data:
            return False
        if self.inflate.eof:  # the next member
            self.inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        self.held += self.inflate.decompress(data)
        self.left = self.inflate.unused_data
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise EOFError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def head(self) -> dict[str, str] | None:
        """The next record's named fields; None at the end."""
        seen = 0
        while (end := self.held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held:
                    raise EOFError("the archive ends inside a record's head")
                return None
        lines = self.take(end + 4).decode().split("\r\n")
        return dict(line.split(": ", 1) for line in lines[1:] if line)


def parsed(stream: Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of each record of the stream."""
    while (fields := stream.head()) is not None:
        block = stream.take(int(fields["Content-Length"]))
        stream.take(4)
        yield fields, block[block.index(b"\r\n\r\n") + 4 :]


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return fs, path.rstrip("/")


class Replacing:
    """A file that appears under its name when it is complete."""

    def __init__(self, fs: pafs.FileSystem, path: str, attempt: int):
        self.fs, self.path, self.temporary = fs, path, f"{path}.{attempt}.part"
        self.out = fs.open_output_stream(self.temporary)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.path)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One monolithic archive per task. (archive, place, page_id, size, sha1, sha256) of each record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId()
        file, place = None, 0
        gzip = gzip_writer()
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is None:
                    fs, path = _opened(folder)
                    fs.create_dir(path, recursive=True)
                    file = Replacing(fs, f"{path}/pages-{number:06d}.warc.gz", task.taskAttemptId())
                payload = (html or "").encode()
                sha1 = hashlib.sha1(payload).hexdigest()
                file.out.write(gzip.compress(record("response", page_id, url, sha1, len(payload), payload)))
                out.append((number, place, page_id, len(payload), sha1, hashlib.sha256(payload).digest()))
                place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if file is not None:
            file.out.write(gzip.flush())
            file.close()

    names = ["archive", "place", "page_id", "size", "sha1", "sha256"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "archive int, place long, page_id long, size long, sha1 string, sha256 binary")


def _archives(records: DataFrame) -> int:
    return (records.agg(F.max("archive")).first()[0] or 0) + 1


def by_archive(rows: DataFrame, archives: int, order: str) -> DataFrame:
    """An archive's rows together and in order, about one archive a task: the rows are few, but
    each stands for a record to read or write, so small partitions must not be joined."""
    return rows.repartition(min(archives, TASKS), "archive").sortWithinPartitions("archive", order)


def decisions(records: DataFrame, scratch: Scratch, least: int = REVISIT_BYTES) -> DataFrame:
    """(archive, place, kept_id, revisit) for the records of equal payloads of at least
    ``least`` bytes: the largest page_id, then the first in archive order, is kept."""
    first = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"), (-F.col("archive")).alias("a"), (-F.col("place")).alias("p"))
    large = records.filter(F.col("size") >= least)
    kept = large.groupBy("sha256", "size").agg(F.max(first).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    kept = scratch.table(kept.select("sha256", F.col("size").alias("kept_size"), "kept"), "kept")
    met = common.spread_lookup(large, kept, "sha256", F.concat_ws(":", "archive", "place"), how="inner").filter("size = kept_size")
    same = (F.col("archive") == -F.col("kept.a")) & (F.col("place") == -F.col("kept.p"))
    kept_id = F.when(F.col("kept.page_id") != -(1 << 63), F.col("kept.page_id"))
    return met.filter(~same).select("archive", "place", kept_id.alias("kept_id"))


def normalise(records: DataFrame, revisits: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one member per record. (archive, place, offset, length) of each member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"archive": None, "rows": {}}
        attempt = TaskContext.get().taskAttemptId()

        def rewrite(archive: int, refers: dict[int, int | None]) -> Iterator[pa.RecordBatch]:
            fs, path = _opened(folder)
            target = Replacing(fs, f"{path}/pages-{archive:06d}.records.warc.gz", attempt)
            sidecar = Replacing(fs, f"{path}/pages-{archive:06d}.records.idx", attempt)
            out, at = [], 0
            with fs.open_input_stream(f"{path}/pages-{archive:06d}.warc.gz", compression=None) as raw:
                for place, (fields, payload) in enumerate(parsed(Stream(raw))):
                    page = fields.get("X-Page-Id")
                    again = place in refers
                    gzip = gzip_writer()
                    member = gzip.compress(record(
                        "revisit" if again else "response", int(page) if page is not None else None, fields.get("WARC-Target-URI"),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"]), payload, refers.get(place))) + gzip.flush()
                    target.out.write(member)
                    sidecar.out.write(f"{place}\t{at}\t{len(member)}\t{page or ''}\n".encode())
                    out.append((archive, place, at, len(member)))
                    at += len(member)
            target.close()
            sidecar.close()
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for batch in batches:
            for archive, place, refers_to, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != state["archive"]:
                    if state["archive"] is not None:
                        yield from rewrite(state["archive"], state["rows"])
                    state = {"archive": archive, "rows": {}}
                if again:
                    state["rows"][place] = refers_to
        if state["archive"] is not None:
            yield from rewrite(state["archive"], state["rows"])

    names, types = ["archive", "place", "offset", "length"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    archives = records.select("archive").distinct().select("archive", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("kept_id"), F.lit(False).alias("again"))
    rows = archives.unionByName(revisits.withColumn("again", F.lit(True)))
    # one row per archive and revisit; a task holds one archive's revisits at a time
    rows = by_archive(rows, _archives(records), "place")
    return rows.mapInArrow(run, "archive int, place long, offset long, length long")


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of each record, read from
    its member; a response's payload must match its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != opened:
                    fs, path = _opened(folder)
                    file, opened = fs.open_input_file(f"{path}/pages-{archive:06d}.records.warc.gz"), archive
                file.seek(offset)
                data = zlib.decompress(file.read(length), 16 + zlib.MAX_WBITS)
                stream = Stream(pa.BufferReader(b""))
                stream.held = bytearray(data)
                fields, payload = next(parsed(stream))
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"archive {archive}, offset {offset}: the payload doesn't match its digest")
                page, refers = fields.get("X-Page-Id"), fields.get("WARC-Refers-To")
                out.append((int(page) if page is not None else None, int(fields["X-Payload-Length"]), digest, kind,
                            int(refers.removeprefix("<urn:page:").rstrip(">")) if refers else None, fields.get("WARC-Target-URI")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    rows = by_archive(index.select("archive", "offset", "length"), _archives(index), "offset")
    return rows.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive(pages: DataFrame, scratch: Scratch, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write, deduplicate and normalise; (index, folder of the archives)."""
    folder = folder or scratch.path("warc")
    records = scratch.table(write_archives(pages, folder), "records")
    revisits = scratch.table(decisions(records, scratch), "revisits")
    index = scratch.table(normalise(records, revisits, folder), "index")
    scratch.drop("records", "revisits", "kept")
    return index, folder


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the normalised archives of all pages hold."""
    index, folder = archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), Scratch(spark, "warc"))
    return read_back(index, folder).drop("url")


OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, html, strlen(html)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM s
"""
