"""WARC archives: a writer that stores equal payloads once, and a reader that
salvages damaged archives.

:func:`write` stores one record per row, gzip member by member, in files of
about ``file_bytes``.  Among rows of equal payload of at least ``least`` bytes
the one with the smallest id becomes a ``response``, the others ``revisit`` it
(rows that repeat this smallest id are responses too).  Which is which is
decided on digests alone; payloads meet their decision in one shuffle by
digest whose hot keys are salted.  A task writes each file under another name
and renames it; rows are sorted within a partition and names depend on the
partition, so a task that runs again writes the same files with the same bytes.

:func:`read` takes files, of up to 2 GB each, through Spark's binary reader and returns
records and gaps as it comes upon them, so beside the file itself a task holds a few MB.  A member or record is valid when it decompresses with its
checksum, starts with a version line, has the headers it needs and a block of
the stated length, and its block or payload digest, where stated, agrees.
After a failed check the reader searches for the next position that starts a
valid record: the nearer of the next gzip magic and the next version line,
whatever the file began with, and also a version line inside a member whose own
records are damaged.  Everything
skipped is logged as a gap with its byte range and reason; a file that ends
inside a record is a gap up to its end.

Edge cases: null payloads are empty; null urls become ``urn:page:<id>``; empty
input writes no file and reads back as no rows; rows without an id are written
with an empty one and read back as null.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import give_back, shared_folder, table

LEAST, FILE_BYTES, SALTS = 100, 16 << 20, 16
HELD_BYTES = 4 << 20  # payloads read before they are passed on
# Names and layout of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
DATE = "2000-01-01T00:00:00Z"  # records carry no clock time, so that a rerun writes the same bytes

RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType())])
RECORD_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
                          ("reason", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
                          ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One WARC record: a response with an HTTP block, or a revisit without payload."""
    name = "" if page_id is None else str(page_id)
    uri = (uri or f"urn:page:{name}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


# Names that Hadoop and Arrow give the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfss", "abfs": "abfs", "gs": "gs", "s3": "s3", "hdfs": "hdfs", "viewfs": "viewfs",
           "file": "file"}


def arrow_uri(folder: str) -> str:
    """The URI under which Arrow's file systems know a folder; ValueError for a store that they do not know."""
    scheme, sign, rest = folder.partition("://")
    if not sign:
        scheme, rest = folder.partition(":")[0] if folder.startswith("file:") else "", folder.removeprefix("file:")
    if scheme and scheme not in SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}://, only to {', '.join(SCHEMES)}")
    return f"{SCHEMES[scheme]}://{rest}" if scheme else folder


def _store(folder: str, name: str, data: bytes) -> None:
    fs, base = pafs.FileSystem.from_uri(arrow_uri(folder))
    fs.create_dir(base, recursive=True)
    hidden = f"{base}/_{name}.{hashlib.sha256(data).hexdigest()[:8]}.tmp"
    with fs.open_output_stream(hidden) as f:
        f.write(data)
    try:
        fs.move(hidden, f"{base}/{name}")
    except OSError:  # some stores don't replace: another attempt has stored the same bytes
        if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
            raise
        fs.delete_file(hidden)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
          least: int = LEAST, file_bytes: int = FILE_BYTES, compress: bool = True) -> int:
    """Write one record per row to ``folder``, a URI that all executors reach and Arrow
    knows (``arrow_uri``; hdfs and viewfs need libhdfs on the executors); returns
    the number of records."""
    arrow_uri(folder)
    d = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    d = d.withColumn("digest", F.sha2("payload", 256)).withColumn("long", F.octet_length("payload") >= least)
    # Digests of several rows, with the response's id; each once per salt.
    shared = (d.filter("long and id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .filter("first < last").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    d = d.withColumn("salt", F.pmod(F.xxhash64("id", "uri"), F.lit(SALTS)).cast("int"))
    d = d.join(shared, ["digest", "salt"], "left").select(
        "id", "uri", "payload", "digest", F.when(F.col("long") & (F.col("id") != F.col("first")), F.col("first")).alias("refers"))
    d = d.sortWithinPartitions("digest", "id", "uri")
    suffix = ".warc.gz" if compress else ".warc"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, files, held, size, n = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                data = record(row[0], row[1], row[2].encode(), row[4], row[3])
                held.append(member(data) if compress else data)
                size += len(held[-1])
                n += 1
                if size >= file_bytes:
                    _store(folder, f"part-{part:06d}-{files:05d}{suffix}", b"".join(held))
                    held, size, files = [], 0, files + 1
        if held:
            _store(folder, f"part-{part:06d}-{files:05d}{suffix}", b"".join(held))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return d.mapInArrow(run, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0


@dataclass
class Found:
    """What a reader got out of one archive."""
    records: list[dict] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)  # offset, length, reason


class Damaged(ValueError):
    """A check failed; the text is the reason."""


def _parsed(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and the position behind it."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("headers do not end")
    head: dict[str, str] = {}
    for raw in data[line.end():stop].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            raise Damaged("malformed header")
        head.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    for need in ("warc-type", "warc-record-id", "content-length"):
        if need not in head:
            raise Damaged(f"no {need} header")
    if not head["content-length"].isascii() or not head["content-length"].isdigit():
        raise Damaged("bad content-length")
    begin = stop + 4
    end = begin + int(head["content-length"])
    if end > len(data):
        raise Damaged("block ends early")
    block = data[begin:end]
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("no end of record")
    stated = head.get("warc-block-digest", "")
    if stated.startswith("sha256:") and hashlib.sha256(block).hexdigest() != stated[7:]:
        raise Damaged("block digest differs")
    payload, length = block, None
    if head.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        length = int(said[1]) if said else None
    digest = head.get("warc-payload-digest", "")
    if head["warc-type"] == "revisit":
        payload = None
    else:
        if digest.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest[7:]:
            raise Damaged("payload digest differs")
        length = len(payload)
    return {"record_type": head["warc-type"], "record_id": head["warc-record-id"],
            "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
            "payload_digest": digest.removeprefix("sha256:") or None, "payload_bytes": length, "payload": payload}, end + 4


def _plain(data: bytes, found: Found, offset: int, size: int) -> None:
    """Records of the bytes of a gzip member, whose own place in the file is logged."""
    at, bad, why = 0, None, ""
    while at < len(data):
        try:
            got, end = _parsed(data, at)
        except Damaged as e:
            if bad is None:
                bad, why = at, str(e)
            line = _VERSION_LINE.search(data, at + 1)
            at = line.start() if line else len(data)
            continue
        if bad is not None:
            found.gaps.append((offset, size, f"in member: {why}"))
            bad = None
        found.records.append(got | {"offset": offset, "length": size})
        at = end
    if bad is not None:
        found.gaps.append((offset, size, f"in member: {why}"))


_WINDOW = 1 << 16


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at``, checksum verified, and the position behind it;
    fed piece by piece, so that the rest of the archive is never copied."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            if pos >= len(data):
                raise Damaged("gzip: member ends early")
            piece = data[pos:pos + _WINDOW]
            out.append(unpack.decompress(piece))
            pos += len(piece)
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return b"".join(out), pos - len(unpack.unused_data)


def salvage(data: bytes) -> Found:
    """Every valid record of an archive and the gaps between them."""
    found = Found()
    for part in salvaged(data):
        found.records += part.records
        found.gaps += part.gaps
    return found


def salvaged(data: bytes) -> Iterator[Found]:
    """The records and gaps of an archive, in gzip members or plain, as they are come upon:
    those of one member at a time are held."""
    at, bad, why = 0, None, ""
    magic = version = -1  # the next ones behind ``at``, looked up again once passed
    while at < len(data):
        try:
            if data.startswith(MAGIC, at):
                out, end = _member(data, at)
                if not _VERSION_LINE.search(out):
                    raise Damaged("member holds no record")
                got = None
            else:
                got, end = _parsed(data, at)
        except Damaged as e:
            if bad is None:
                bad, why = at, str(e)
            if magic <= at:
                magic = data.find(MAGIC, at + 1)
                magic = magic if magic >= 0 else len(data)
            if version <= at:
                line = _VERSION_LINE.search(data, at + 1)
                version = line.start() if line else len(data)
            at = min(magic, version)
            continue
        found = Found()
        if bad is not None:
            found.gaps.append((bad, at - bad, why))
            bad = None
        if got is None:
            _plain(out, found, at, end - at)
        else:
            found.records.append(got | {"offset": at, "length": end - at})
        yield found
        at = end
    if bad is not None:
        yield Found(gaps=[(bad, len(data) - bad, why)])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of kind ``record`` and ``gap`` of all archives below ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                size = 0
                for got in salvaged(memoryview(content.as_buffer()).tobytes()):
                    rows += [r | {"path": path, "kind": "record", "reason": None} for r in got.records]
                    rows += [{"path": path, "kind": "gap", "offset": o, "length": n, "reason": why} for o, n, why in got.gaps]
                    size += sum(len(r["payload"] or b"") for r in got.records)
                    if size > HELD_BYTES or len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
        give_back()

    return files.mapInArrow(run, RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    if not write(pages, folder):
        return pages.limit(0).select("page_id", F.lit(0).cast("long").alias("payload_bytes"), F.lit("").alias("payload_digest"),
                                     F.lit("").alias("record_type"), F.lit(0).cast("long").alias("refers_to"))
    page = r"^<urn:page:(-?\d+)>$"
    return read(spark, folder).filter("kind = 'record'").select(
        F.expr(f"try_cast(nullif(regexp_extract(record_id, r'{page}', 1), '') as bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr(f"try_cast(nullif(regexp_extract(refers_to, r'{page}', 1), '') as bigint)").alias("refers_to"))
