"""WARC archives: a deterministic sharded writer and a reader.

Writing, for rows (id, uri, payload):

1. A narrow pass takes the payloads' digests.  Of equal payloads of a least
   size the row with the smallest id is stored; the others become *revisit*
   records, told by notices that carry no payload.
2. Shards are ranges of ids of about equal payload, cut where a histogram of exact byte counts says: the same rows give the same shards
   however the table is split.  A single range that is too heavy is dealt out
   by hash.  Payloads are shuffled to their shard once, and sorted there.
3. A task writes its shards' records, a gzip member each, to files of its own
   attempt; a file that has reached ``roll_bytes`` compressed is closed and the
   next begun.  Headers and digests are made anew for every record.  What the
   task wrote is returned as manifest rows, so files of a lost attempt are not
   in the manifest.
4. The manifest's files get their final names (a step that may be repeated),
   and the manifest is written last.  An archive without a manifest is not complete;
   readers open the files that it names and nothing else.

Files go through Arrow's file systems: the folder must be one that every
executor reaches (hdfs, s3, gs, abfs, or a shared mount), not a local disk.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.llm.common import drop, partitions, slices, store, tidy

#: Shards have an equal part of all payloads, at least and at most so many bytes.
SHARDS, SHARD_BYTES = 256, (8 << 20, 256 << 20)
ROLL_BYTES = 64 << 20
#: Ranges of the histogram that shards are made of.
RANGES = 1 << 16
MANIFEST = "shard string, part int, name string, temporary string, records long, bytes long, sha256 string"
RECORDS = ("file string, position long, record_type string, record_id string, target_uri string, page_id long, payload_bytes long,"
           " payload_digest string, refers_to long, refers_to_id string, payload binary")

# fixed values: the format's words
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


@dataclass(frozen=True)
class WarcOptions:
    """``date`` is written into every record (rows carry none; a fixed one keeps archives alike).  Payloads of fewer than
    ``least_bytes`` are stored each time.  Shards are cut at ``shard_bytes`` of payload (None: one of :data:`SHARDS` equal
    parts, within :data:`SHARD_BYTES`), files at ``roll_bytes`` compressed."""
    date: str = "1970-01-01T00:00:00Z"
    least_bytes: int = 100
    shard_bytes: int | None = None
    roll_bytes: int = ROLL_BYTES
    level: int = 6
    content_type: str = "text/html; charset=utf-8"


def record_id(page_id: int | None, uri: str | None, digest: str, again: int) -> str:
    """A record's name, made from what it holds; ``again`` counts rows that are alike in all three."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(json.dumps([page_id, uri, digest, again]).encode()).digest()[:16], version=5)}>"


def plain_uri(uri: str) -> str:
    """Without spaces, control and other characters that a header line cannot hold."""
    return quote(uri, safe="!#$%&'()*+,/:;=?@[]~-._")


def member(headers: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    """One record as a gzip member that holds no time or name."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress((CRLF.join(lines) + CRLF * 2).encode()) + squeeze.compress(block) + squeeze.compress((CRLF * 2).encode()) + squeeze.flush()


def response(page_id: int | None, uri: str | None, digest: str, again: int, payload: bytes, o: WarcOptions) -> bytes:
    block = f"HTTP/1.1 200 OK{CRLF}Content-Type: {o.content_type}{CRLF}Content-Length: {len(payload)}{CRLF * 2}".encode() + payload
    return member([("WARC-Type", "response"), ("WARC-Record-ID", record_id(page_id, uri, digest, again)), ("WARC-Date", o.date),
                   ("WARC-Target-URI", None if uri is None else plain_uri(uri)), ("WARC-Payload-Digest", f"sha256:{digest}"),
                   ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("X-Page-Id", page_id),
                   ("Content-Type", "application/http;msgtype=response")], block, o.level)


def revisit(page_id: int | None, uri: str | None, digest: str, again: int, size: int, first: tuple[int | None, str | None], o: WarcOptions) -> bytes:
    """A record without payload that names the one that has it; the HTTP header keeps the payload's length."""
    block = f"HTTP/1.1 200 OK{CRLF}Content-Type: {o.content_type}{CRLF}Content-Length: {size}{CRLF * 2}".encode()
    return member([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id, uri, digest, again)), ("WARC-Date", o.date),
                   ("WARC-Target-URI", None if uri is None else plain_uri(uri)), ("WARC-Payload-Digest", f"sha256:{digest}"),
                   ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("WARC-Profile", IDENTICAL),
                   ("WARC-Refers-To", record_id(*first, digest, 0)), ("WARC-Refers-To-Target-URI", None if first[1] is None else plain_uri(first[1])),
                   ("WARC-Refers-To-Date", o.date), ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", first[0]),
                   ("Content-Type", "application/http;msgtype=response")], block, o.level)


def opening(name: str, o: WarcOptions) -> bytes:
    block = f"software: ontime_analytics{CRLF}format: {VERSION}{CRLF}".encode()
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, "", 0)), ("WARC-Date", o.date), ("WARC-Filename", name),
                   ("Content-Type", "application/warc-fields")], block, o.level)


def _folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{os.path.abspath(path)}")


class _Files:
    """The files of one shard: each is closed when it has reached its size."""

    def __init__(self, folder: str, shard: str, attempt: str, o: WarcOptions):
        self.fs, self.folder = _folder(folder)
        self.shard, self.attempt, self.o = shard, attempt, o
        self.part, self.out, self.done = 0, None, []

    def write(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"{self.shard}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
            self.out, self.records, self.bytes, self.digest = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None), -1, 0, hashlib.sha256()
            self.write(opening(self.name, self.o))
        self.out.write(record)
        self.digest.update(record)
        self.records += 1
        self.bytes += len(record)
        if self.records and self.bytes >= self.o.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.name, self.temporary, self.records, self.bytes, self.digest.hexdigest()))
            self.out, self.part = None, self.part + 1


def _writer(folder: str, o: WarcOptions):
    """Sorted rows become files; a row is preceded by the notice, if there is one, that it is a copy."""
    def manifest(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in MANIFEST.split(", ")])

    def run(batches):
        attempt, files, shard, last, again, first, repeats = uuid.uuid4().hex, None, None, None, 0, None, False
        for b in slices(batches, text="payload"):
            columns = [b.column(c).to_pylist() for c in ("shard", "page_id", "uri", "digest", "kind", "first_id", "first_uri", "repeats")]
            for i, (s, page_id, uri, digest, kind, first_id, first_uri, rep) in enumerate(zip(*columns)):
                if s != shard:
                    if files:
                        files.close()
                        if files.done:
                            yield manifest(files.done)
                    shard, files, last = s, _Files(folder, s, attempt, o), None
                key = (page_id, uri, digest)
                if key != last:
                    last, again, first, repeats = key, 0, None, False
                if kind == 0:
                    first, repeats = (first_id, first_uri), rep
                    continue
                payload = (b.column("payload")[i].as_py() or "").encode()
                if first is not None and not (repeats and again == 0):
                    files.write(revisit(*key, again, len(payload), first, o))
                else:
                    files.write(response(*key, again, payload, o))
                again += 1
        if files:
            files.close()
            if files.done:
                yield manifest(files.done)

    return run


def _shards(rows: DataFrame, o: WarcOptions):
    """What gives frames with ``page_id, uri, digest`` their ``shard``: ranges of ids with about so many bytes, null ids
    first.  The table of ranges has at most ``RANGES`` + 1 rows, so it is broadcast."""
    ends = rows.agg(F.min("page_id").alias("a"), F.max("page_id").alias("z")).first()
    low, high = (ends["a"] or 0), (ends["z"] or 0)
    step = (high - low) // RANGES + 1
    at = F.coalesce(F.expr(f"CAST((CAST(page_id AS DECIMAL(20, 0)) - {low}) div {step} AS INT)"), F.lit(-1))
    weights = sorted((r["at"], int(r["bytes"])) for r in rows.groupBy(at.alias("at")).agg(F.sum(F.col("size") + 512).alias("bytes")).collect())
    ranges, number, filled = [], 0, 0
    most = o.shard_bytes or max(SHARD_BYTES[0], min(SHARD_BYTES[1], sum(size for _, size in weights) // SHARDS))
    for where, size in weights:
        if filled and filled + size > most:
            number, filled = number + 1, 0
        ranges.append((where, number, 1 if size <= 2 * most else -(-size // most)))
        filled += size
    table = F.broadcast(rows.sparkSession.createDataFrame(ranges, "at int, n int, parts int"))

    def with_shard(df: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("page_id", "uri", "digest"), F.col("parts")).cast("int")
        return df.withColumn("at", at).join(table, "at").withColumn("shard", F.format_string("%07d-%04d", "n", part)).drop("at", "n", "parts")

    return with_shard


def write_warc(pages: DataFrame, folder: str, options: WarcOptions = WarcOptions(), id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the rows as WARC files into ``folder``, which must be new; returns the manifest (``folder/manifest``).

    The payload is the text in UTF-8, null as empty.  Of equal payloads of
    ``least_bytes`` or more the row with the smallest (id, uri), null first, is
    a response and all others revisit it, also those that are alike in all
    columns; smaller payloads are always responses.  Null and repeated ids keep
    their rows, null uris have no header, other columns are ignored.  An empty
    table gives a manifest without files.  The rows are read twice and must be
    the same both times (a table's are).
    """
    spark = pages.sparkSession
    o = options
    fs, top = _folder(folder)
    if fs.get_file_info(f"{top}/manifest").type != pa.fs.FileType.NotFound:
        raise ValueError(f"{folder} holds an archive already")
    text = F.coalesce(pages[payload_col].cast("string"), F.lit(""))
    base = pages.select(pages[id_col].cast("long").alias("page_id"), pages[uri_col].cast("string").alias("uri"), text.alias("payload"),
                        F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    narrow, narrow_path = store(base.drop("payload"), "payloads")
    with_shard = _shards(narrow, o)
    groups = narrow.filter(F.col("size") >= o.least_bytes).groupBy("digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("page_id", "uri")).alias("first")).filter("copies > 1")
    # a notice for each copy: of rows alike in id, uri and payload one; if these are the first, only the second and later are copies
    notices = narrow.groupBy("digest", "page_id", "uri").agg(F.count("*").alias("alike")).join(groups, "digest") \
        .withColumn("is_first", F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("uri").eqNullSafe(F.col("first.uri"))) \
        .filter("not is_first or alike > 1") \
        .select("page_id", "uri", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("payload"),
                F.col("first.page_id").alias("first_id"), F.col("first.uri").alias("first_uri"), F.col("is_first").alias("repeats"))
    none = F.lit(None)
    rows = base.select("page_id", "uri", "digest", F.lit(1).alias("kind"), "payload", none.cast("long").alias("first_id"),
                       none.cast("string").alias("first_uri"), F.lit(False).alias("repeats"))
    dealt = with_shard(notices.unionByName(rows)).repartition(partitions(spark), "shard").sortWithinPartitions("shard", "page_id", "uri", "digest", "kind")
    written, path = store(dealt.mapInArrow(tidy(_writer(folder, o)), MANIFEST), "written")
    manifest = _commit(written, folder)
    drop(spark, narrow_path)
    drop(spark, path)
    return manifest


def _commit(written: DataFrame, folder: str) -> DataFrame:
    """Final names for the files of the manifest, then the manifest itself."""
    def rename(batches):
        fs, top = _folder(folder)
        for b in batches:
            for r in b.to_pylist():
                if fs.get_file_info(f"{top}/{r['temporary']}").type != pa.fs.FileType.NotFound:
                    fs.move(f"{top}/{r['temporary']}", f"{top}/{r['name']}")
                if fs.get_file_info(f"{top}/{r['name']}").size != r["bytes"]:
                    raise RuntimeError(f"{r['name']} is not as it was written")
            yield b

    spark = written.sparkSession
    path = f"{folder}/manifest"
    written.mapInArrow(tidy(rename), MANIFEST).drop("temporary").write.parquet(path)
    fs, top = _folder(folder)
    if fs.get_file_info(f"{top}/_temporary").type == pa.fs.FileType.Directory:
        fs.delete_dir(f"{top}/_temporary")  # files of attempts that were lost
    return spark.read.schema(", ".join(c for c in MANIFEST.split(", ") if not c.startswith("temporary"))).parquet(path)


def records(stream, size: int = 1 << 20):
    """(position, headers in lower case, block) of a compressed archive, record by record; the stream is read in pieces."""
    rest, at = b"", 0
    more = True
    while more or rest:
        inflate, out, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not rest:
                rest = stream.read(size)
                if not rest:
                    if used:
                        raise ValueError("the archive ends within a record")
                    return
            out.append(inflate.decompress(rest))
            used += len(rest) - len(inflate.unused_data)
            rest = inflate.unused_data
        data = b"".join(out)
        head, _, body = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        block = body[:int(headers["content-length"])]
        if body[len(block):] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield at, headers, block
        at += used


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an archive (columns of ``RECORDS``; ``payload`` null if not asked for, or for a revisit).

    Every file's length and digest are held against the manifest, every stored
    payload and block against its record's digests; what differs fails the job.
    Files are read in pieces, one record at a time."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("name", "bytes", "sha256")

    class Hashed:
        def __init__(self, stream):
            self.stream, self.digest, self.size = stream, hashlib.sha256(), 0

        def read(self, n):
            data = self.stream.read(n)
            self.digest.update(data)
            self.size += len(data)
            return data

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in RECORDS.split(", ")])

    def parse(name: str, at: int, h: dict, block: bytes) -> tuple | None:
        if h["warc-type"] not in ("response", "revisit"):
            return None
        if hashlib.sha256(block).hexdigest() != h["warc-block-digest"].removeprefix("sha256:"):
            raise ValueError(f"{name}: a block differs from its digest")
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = h["warc-payload-digest"].removeprefix("sha256:")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        if h["warc-type"] == "response":
            if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{name}: a payload differs from its digest")
        number = lambda k: int(h[k]) if k in h else None
        return (name, at, h["warc-type"], h["warc-record-id"], h.get("warc-target-uri"), number("x-page-id"), size, digest, number("x-refers-to-page-id"),
                h.get("warc-refers-to"), payload if payloads and h["warc-type"] == "response" else None)

    def run(batches):
        fs, top = _folder(folder)
        for b in batches:
            for f in b.to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{top}/{f['name']}", compression=None) as raw:
                    stream = Hashed(raw)
                    for at, headers, block in records(stream):
                        row = parse(f["name"], at, headers, block)
                        if row:
                            rows.append(row)
                            held += len(row[-1] or b"") + 300
                            if held >= 4 << 20:
                                yield batch(rows)
                                rows, held = [], 0
                if (stream.size, stream.digest.hexdigest()) != (f["bytes"], f["sha256"]):
                    raise ValueError(f"{f['name']} differs from the manifest")
                if rows:
                    yield batch(rows)

    return manifest.repartition(partitions(spark), "name").mapInArrow(tidy(run), RECORDS)
