"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are dealt by ranges of their id and sorted within them, so every file's records follow from the data alone.
A task streams its ranges into gzip files (one member a record), rolls a file when its compressed size passes
``roll_bytes``, and regenerates all headers, lengths and digests from the payload. A file is written under a
temporary name of its attempt and moved to its final name when complete; a repeated task makes the same file again.
The manifest (one row a file, with its size and checksum) is a Parquet table that Spark commits last; only files it
names exist for the reader, and leftovers of lost attempts are removed after it.

Equal payloads of at least ``min_bytes`` bytes are stored once: the record with the largest id is the response, the
others are revisits that refer to it. Only ids, lengths and checksums are compared; the payloads are shuffled once.

Files go through ``pyarrow.fs``, which opens local, HDFS and object-store addresses from the executors.

Defined cases: a null payload is empty; a null id sorts first, counts as the smallest and shares a range; equal rows
of one id are a response and revisits of the same id; null addresses become the record's own name; an empty table
gives an empty manifest and no file; a page of any length is one record (held whole); other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from math import ceil, log2

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import arrow_map, checkpointed, fresh_path

DATE = "2020-01-01T00:00:00Z"  # records carry one given date, so that reruns agree
ROLL_BYTES = 64 << 20
#: Payload bytes that a range of ids holds on average.
RANGE_BYTES = 16 << 20
FILE_SCHEMA = "file string, records long, bytes long, sha256 string"
ROW_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


def record(kind: str, page_id: int | None, nth: int, url: str | None, payload: bytes, refers: tuple[int | None, int] | None, date: str) -> bytes:
    """One WARC record; ``nth`` tells apart equal ids, and ``refers`` are a revisit's response's."""
    uri = (url or f"urn:page:{_name(page_id)}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{_name(page_id)}:{nth}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{_name(refers[0])}:{refers[1]}>", f"X-Payload-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The files of one task: temporary names, rolling, commit by move."""

    def __init__(self, folder: str, roll_bytes: int, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.roll, self.date, self.out, self.done = roll_bytes, date, None, []
        task = TaskContext.get()
        self.attempt = f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}" if task else "0"

    def start(self, group: str) -> None:
        self.close()
        self.group, self.nth = group, 0

    def _open(self) -> None:
        self.name = f"{self.group}-{self.nth:05d}.warc.gz"
        self.temporary = f"{self.folder}/.tmp-{self.attempt}-{self.name}"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        info = f"software: deterministic sharded writer\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{self.name}>\r\nWARC-Date: {self.date}\r\n"
                f"WARC-Filename: {self.name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n").encode()
        self._put(head + info + b"\r\n\r\n")

    def _put(self, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.size += len(member)
        self.sum.update(member)

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size >= self.roll:
            self.close()
            self.nth += 1
        if self.out is None:
            self._open()
        self._put(data)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        final = f"{self.folder}/{self.name}"
        try:
            self.fs.move(self.temporary, final)
        except OSError:  # stores whose move does not replace what an earlier attempt left
            self.fs.delete_file(final)
            self.fs.move(self.temporary, final)
        self.done.append((self.name, self.records, self.size, self.sum.hexdigest()))
        self.out = None


def plan(pages: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(page_id, sum, n) of every record, computed once; and (page_id, sum, refers_to, refers_nth) of those that revisit a larger id."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    small = checkpointed(pages.select(F.col("page_id"), F.unhex(F.sha2(payload, 256)).alias("sum"), F.octet_length(payload).cast("long").alias("n")))
    best = small.where(F.col("n") >= min_bytes).groupBy("sum").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")) \
        .where("copies > 1").select("sum", "refers_to")
    # a hot payload's rows are many on one side of this inner join only: AQE splits them
    later = small.join(best, "sum").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    # a response of a page with several payloads has a number: as many records of its page come before it
    several = small.groupBy("page_id").agg(F.count("*").alias("rows")).where("rows > 1").select("page_id")
    before = Window.partitionBy("page_id").orderBy("sum").rowsBetween(Window.unboundedPreceding, -1)
    numbers = small.join(several, "page_id").groupBy("page_id", "sum").agg(F.count("*").alias("rows")) \
        .select(F.col("page_id").alias("refers_to"), "sum", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("refers_nth"))
    later = later.select("page_id", "sum", "refers_to").distinct().join(numbers, ["refers_to", "sum"], "left")
    return small, later.select("page_id", "sum", "refers_to", F.coalesce("refers_nth", F.lit(0)).cast("long").alias("refers_nth"))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = ROLL_BYTES,
               range_bytes: int = RANGE_BYTES, date: str = DATE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) below ``folder``, a new folder on a shared store; returns the manifest."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    small, later = plan(pages, min_bytes)
    low, high, total = small.agg(F.percentile_approx("page_id", 0.01), F.percentile_approx("page_id", 0.99), F.sum("n")).first()
    ranges = max(1, ceil((total or 0) / range_bytes))
    width = 1 << max(0, ceil(log2(max(1, ((high or 0) - (low or 0) + 1) / ranges))))
    group = F.floor(F.col("page_id") / F.lit(width)).cast("long").alias("part")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(group, "page_id", F.unhex(F.sha2(payload.cast("binary"), 256)).alias("sum"), F.lit(1).alias("kind"),
                        "url", F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("long").alias("refers_nth"), payload.alias("html"))
    told = later.select(group, "page_id", "sum", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                        "refers_to", "refers_nth", F.lit(None).cast("string").alias("html"))
    dealt = rows.unionByName(told).repartition("part").sortWithinPartitions("part", "page_id", "sum", "kind", "url")
    location, places = pafs.FileSystem.from_uri(folder)
    location.create_dir(places, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, part, seen, nth, target, own = _Files(folder, roll_bytes, date), (), None, 0, None, None
        for batch in batches:
            for k in range(batch.num_rows):
                p, page, checksum, kind, url, refers, refers_nth, html = (c[k].as_py() for c in batch.columns)
                if part != (p,):
                    part = (p,)
                    files.start(f"pages-{'null' if p is None else f'{p:+020d}'}")
                if seen is None or seen[0] != page:
                    nth = 0
                if seen != (page, checksum):
                    seen, target, own = (page, checksum), None, None
                if kind == 0:
                    target = refers, refers_nth
                    continue
                data = html.encode()
                if target is not None:
                    files.add(record("revisit", page, nth, url, data, target, date))
                elif own is None or len(data) < min_bytes:
                    files.add(record("response", page, nth, url, data, None, date))
                    own = nth
                else:
                    files.add(record("revisit", page, nth, url, data, (page, own), date))
                nth += 1
        files.close()
        if files.done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*files.done), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["file", "records", "bytes", "sha256"])

    arrow_map(dealt, run, FILE_SCHEMA).write.parquet(f"{folder}/_manifest")
    for f in location.get_file_info(pafs.FileSelector(places)):
        if f.base_name.startswith(".tmp-"):
            location.delete_file(f.path)
    return spark.read.parquet(f"{folder}/_manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other, each whole."""
    pending, rest = zlib.decompressobj(31), b""
    out: list[bytes] = []
    while True:
        data = rest or stream.read(1 << 20)
        rest = b""
        if not data:
            break
        out.append(pending.decompress(data))
        if pending.eof:
            yield b"".join(out)
            out, rest, pending = [], pending.unused_data, zlib.decompressobj(31)
    if any(out):
        raise ValueError("a file ends within a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("a record's length is not what its header says")
    return fields, block


def _id(urn: str) -> int | None:
    own = urn.split(":")[2]
    return None if own == "null" else int(own)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page record of the files that the manifest names; lengths and digests are checked."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("file", "records")
    # a number of its own, as the manifest's size says nothing of the files'
    tasks = max(1, min(manifest.count(), 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        location, places = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, n = [], 0, 0
                with location.open_input_stream(f"{places}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, block = parsed(data)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        n += 1
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if payload is not None and digest(payload) != told or f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: a digest does not hold")
                        rows.append((_id(fields["WARC-Record-ID"]), fields["WARC-Target-URI"],
                                     len(payload) if payload is not None else int(fields["X-Payload-Length"]), told, kind,
                                     _id(fields["WARC-Refers-To"]) if kind == "revisit" else None, payload))
                        size += len(block)
                        if size > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if n != records:
                    raise ValueError(f"{name} has {n} records; the manifest says {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return arrow_map(manifest.repartitionByRange(tasks, "file"), run, ROW_SCHEMA)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as WARC below the shared folder and read back."""
    folder = fresh_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_warc(spark, folder).drop("url", "payload")
