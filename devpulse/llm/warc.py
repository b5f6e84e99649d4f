"""WARC archives: monolithic gzip in, one gzip member a record out, with an offset index.

Writing. Records are built by DataFrame functions and written by Spark's text
writer as whole-file gzip streams. Of the records with equal payloads (SHA-1
and length) the one with the largest page id is a response; the others are
revisits that name it, chosen by a partial aggregate over digests.

Normalising. A whole-file gzip stream can only be read from its start, so a
file is one task: it inflates the stream once, a buffer at a time, takes the
records by their Content-Length, deflates each as its own member of a new file
and notes its offset and length. Memory follows the largest record. Each attempt
writes a new file and its sidecar index (``.idx``, a line a record) under names
of its own; the index table names the files of the attempts that count, whatever
a failed or speculative one leaves.

Reading back. The index makes the new files splittable: its rows are dealt out
by stretches of a file to as many tasks as the archives' bytes ask for, and a
task inflates the members of its stretches one by one.

Files are written with Arrow's file systems under the shared folder (local or
network paths, hdfs://, s3://, gs://).

Defined results: a null payload is an empty one; a null URL leaves out the
target header, white space and control characters in it are percent-encoded;
a row without a page id is a record without one, and is a response unless its
payload also occurs in a row with an id (then a revisit of that). Repeated
rows with the largest id of their payload are all responses. An empty table
gives no archive records.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.plans.staging import stage_table
from devpulse.session import scratch_path

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: A stretch of an archive that is read in one go, and archive bytes for a reading task.
STRETCH_BYTES = 4 << 20
TASK_BYTES = 16 << 20
BUFFER = 1 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX = ("path string, offset long, length long, record_id string, record_type string, page_id long, "
         "payload_digest string")


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hexadecimal SHA-1."""
    letters = []
    for i in range(8):
        chunk = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(chunk, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                    for j in range(4)]
    return F.concat(*letters)


def with_record_types(pages: DataFrame, least_bytes: int, key: str, url: str, payload: str) -> DataFrame:
    """``page_id, url, payload, n_bytes, digest, first_id`` (the response's page id for a revisit, else null)."""
    rows = (pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                         F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
            .withColumn("n_bytes", F.octet_length("payload").cast("long"))
            .withColumn("sha1", F.sha1(F.col("payload").cast("binary"))))
    same = (pages.select(F.col(key).cast("long").alias("page_id"),
                         F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
            .groupBy(F.sha1(F.col("payload").cast("binary")).alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
            .agg(F.max("page_id").alias("best"), F.count("*").alias("n")).where("n > 1"))
    revisit = (F.col("n_bytes") >= least_bytes) & F.col("best").isNotNull() & ~F.col("best").eqNullSafe(F.col("page_id"))
    return (rows.join(same, ["sha1", "n_bytes"], "left")
            .select("page_id", "url", "payload", "n_bytes", base32_of_hex(F.col("sha1")).alias("digest"),
                    F.when(revisit, F.col("best")).alias("first_id")))


def _record_id(page: Column) -> Column:
    """A name-based identifier from a page id."""
    h = F.md5(F.concat(F.lit("page:"), page.cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(rows: DataFrame) -> DataFrame:
    """``record``: one WARC record a row, without its last line end."""
    is_revisit = F.col("first_id").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(CRLF * 2))
    body = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    target = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")

    def header(name: str, value: Column) -> Column:  # null: left out by concat_ws
        return F.concat(F.lit(f"{name}: "), value)

    own = F.coalesce(_record_id(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), header("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", own), F.lit(f"WARC-Date: {DATE}"), header("WARC-Target-URI", target),
        header("WARC-Page-ID", F.col("page_id").cast("string")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        header("WARC-Refers-To", _record_id(F.col("first_id"))),
        header("WARC-Refers-To-Page-ID", F.col("first_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        header("Content-Length", F.octet_length(body).cast("string")))
    return rows.select(F.concat(head, F.lit(CRLF * 2), body, F.lit(CRLF)).alias("record"))


def write_monolithic(pages: DataFrame, path: str, least_bytes: int = 0, key: str = "page_id", url: str = "url",
                     payload: str = "html") -> None:
    """Write the records of a page table as whole-file gzip streams under ``path``."""
    (records(with_record_types(pages, least_bytes, key, url, payload))
     .write.option("lineSep", CRLF).option("compression", "gzip").text(path))


class _Stream:
    """A gzip stream (one or several members) inflated a buffer at a time."""

    def __init__(self, raw):
        self.raw, self.inflate, self.data, self.rest = raw, zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        if self.inflate.eof:
            left = self.inflate.unused_data or self.raw.read(BUFFER)
            if not left:
                return False
            self.inflate, self.rest = zlib.decompressobj(31), left
        piece = self.rest or self.raw.read(BUFFER)
        if not piece:
            if self.data or not self.inflate.eof:
                raise EOFError("the gzip stream ends early")
            return False
        self.data += self.inflate.decompress(piece, BUFFER)
        self.rest = self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with a mark; None at the end of the stream."""
        start = 0
        while (at := self.data.find(mark, start)) < 0:
            start = max(0, len(self.data) - len(mark))
            if not self._more():
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self._more():
                raise EOFError("a record ends early")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip().split(CRLF)
    return {"": lines[0]} | {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_records(stream: _Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and the whole bytes of each record."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        headers = parse_headers(head)
        yield headers, head + stream.take(int(headers["content-length"])) + stream.take(4)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else
                                    "file://" + path.removeprefix("file:"))


def normalise(spark, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite every ``.gz`` under ``source`` with one member a record; returns the index of the new files."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
             .select("path", F.col("length").alias("size")))
    found = files.count()
    _make_folder(target)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield _rewrite(path, target, level)

    index = one_a_task(files.select("path"), found).mapInArrow(run, INDEX)
    return stage_table(index, "warc-index")


def one_a_task(files: DataFrame, n: int) -> DataFrame:
    """A file cannot be split: one a task, by ranges of the path (hashing would put several in one)."""
    return files.repartitionByRange(max(1, n), "path")


def _make_folder(path: str) -> None:
    fs, at = _filesystem(path)
    fs.create_dir(at, recursive=True)


def _rewrite(path: str, target: str, level: int) -> pa.RecordBatch:
    name = f"{posixpath.basename(path).removesuffix('.gz').removesuffix('.txt')}.{uuid.uuid4().hex}.warc.gz"
    source_fs, source = _filesystem(path)
    fs, folder = _filesystem(target)
    rows, offset = [], 0
    with source_fs.open_input_stream(source, compression=None) as raw, \
            fs.open_output_stream(f"{folder}/{name}", compression=None) as out, \
            fs.open_output_stream(f"{folder}/{name}.idx", compression=None) as sidecar:
        for headers, record in read_records(_Stream(raw)):
            deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = deflate.compress(record) + deflate.flush()
            out.write(member)
            page = headers.get("warc-page-id")
            rows.append((f"{target}/{name}", offset, len(member), headers["warc-record-id"], headers["warc-type"],
                         None if page is None else int(page), headers["warc-payload-digest"].removeprefix("sha1:")))
            sidecar.write(f"{offset}\t{len(member)}\t{rows[-1][3]}\t{rows[-1][4]}\t{page or '-'}\n".encode())
            offset += len(member)
    columns = list(zip(*rows)) if rows else [()] * 7
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["path", "offset", "length", "record_id", "record_type", "page_id", "payload_digest"])


READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, intact boolean")


def read_back(index: DataFrame, full: bool = False) -> DataFrame:
    """Read the records an index names, member by member.

    The payload's size and digest are computed from the record of a response
    and taken from the headers of a revisit; ``intact`` says whether a
    response's payload has the digest of its header. ``full`` adds ``payload``.
    """
    def run(batches):
        for batch in batches:
            out = []
            handle = at = None
            for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if path != at:
                    fs, place = _filesystem(path)
                    handle, at = fs.open_input_file(place), path
                handle.seek(offset)
                record = zlib.decompress(handle.read(length), 31)
                out.append(_described(record, full))
            columns = list(zip(*out)) if out else [()] * (8 if full else 7)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], shape.names)

    shape = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
                       ("intact", pa.bool_()), *([("payload", pa.binary())] if full else [])])
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 1) // TASK_BYTES)
    return (index.select("path", "offset", "length").repartition(tasks, "path", stretch).sortWithinPartitions("path", "offset")
            .mapInArrow(run, READ + (", payload binary" if full else "")))


def _described(record: bytes, full: bool) -> tuple:
    split = record.index(b"\r\n\r\n") + 4
    headers = parse_headers(record[:split])
    block = record[split:split + int(headers["content-length"])]
    body = block.index(b"\r\n\r\n") + 4
    http, payload = parse_headers(block[:body]), block[body:]
    named = headers["warc-payload-digest"].removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    digest = named if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    page, first = headers.get("warc-page-id"), headers.get("warc-refers-to-page-id")
    return (None if page is None else int(page), int(http["content-length"]) if revisit else len(payload), digest,
            headers["warc-type"], None if first is None else int(first), headers["warc-record-id"], digest == named,
            *([payload] if full else []))


def round_trip(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", url: str = "url",
               payload: str = "html") -> DataFrame:
    """Write the pages as monolithic archives, normalise these, and read the new ones back by their index."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    write_monolithic(pages, f"{folder}/monolithic", least_bytes, key, url, payload)
    return read_back(normalise(spark, f"{folder}/monolithic", f"{folder}/records"))
