"""WARC archives, and revisit records for payloads that are already there.

1. `write_archives` writes a response record per page, straight from the scan.
2. `headers` reads archives back: one row per record, with its place, without its payload.
3. `resolve` shuffles these rows by payload digest and names, for each record, the original
   response that it repeats.
4. `rewrite` reads each archive next to the decisions on its records and writes it anew:
   responses with their payload, revisit records without it, all with fresh headers: a new
   record id and block digest, the date of this write, and in a revisit the new id, the target
   and the date of the response that it refers to. A new id follows from the old one and the
   run, so that an archive knows the new ids in all others without looking.
5. `resolved` joins revisit records to the responses that they refer to.

Every archive begins with a warcinfo record, which the others name and no result lists.

Only header rows are shuffled, never payloads. Archives hold about ARCHIVE_BYTES, one gzip
member per record, and are read as a stream. Their names are unique to the task attempt and
only names that Spark's own commit of the result rows kept are read, so that lost executors
and second attempts leave files that nobody looks at.

Defined cases: a NULL html is an empty payload; empty payloads equal each other; of equal
payloads the response is that with the smallest id, rows repeated under one id in order of
their place in the archives; NULL ids come last, and a revisit to a page without an id has
NULL in refers_to; a NULL url writes no target; line ends in a url are escaped; an empty table
gives no archives. A folder without a scheme lies on the session's default file system, one whose
scheme tasks cannot write is refused. Columns other than page_id, url and html are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.llm.common import slices

ARCHIVE_BYTES = 64 * 1024**2
LEVEL = 4
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SOFTWARE = "tunemart"
# What pyarrow calls the file systems of Hadoop's schemes.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

PLACE = "archive string, position long"
HEADER = "record_id string, record_type string, page_id long, url string, date string, payload_digest string, payload_bytes long, refers_to_id string, refers_to long, refers_to_url string, refers_to_date string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def fresh_id(run: str, record_id: str) -> str:
    """The id that a record gets in a run of `rewrite`."""
    return f"urn:uuid:{uuid.uuid5(uuid.UUID(run), record_id)}"


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header."""
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def kind(self) -> str | None:
        return self.fields.get("WARC-Type")

    def to_bytes(self) -> bytes:
        lines = [VERSION] + [f"{k}: {v}".encode() for k, v in self.fields.items()]
        return b"\r\n".join(lines) + b"\r\n\r\n" + self.block + b"\r\n\r\n"


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def record_fields(kind: str, record_id: str, page_id, url, date: str, digest: str, n_bytes: int) -> dict:
    """Header fields in their order, Content-Length still missing."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    fields |= {
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": str(n_bytes),
        "Content-Type": "application/http; msgtype=response",
    }
    return fields if page_id is None else fields | {"X-Page-ID": str(page_id)}


def _with_block(fields: dict, block: bytes) -> Record:
    fields = fields | {"WARC-Block-Digest": f"sha1:{payload_digest(block)}", "Content-Length": str(len(block))}
    return Record(fields, block)


def warcinfo(name: str, date: str) -> Record:
    fields = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": date,
        "WARC-Filename": name,
        "Content-Type": "application/warc-fields",
    }
    return _with_block(fields, f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode())


def response(page_id, url, payload: bytes, date: str) -> Record:
    fields = record_fields(
        "response", f"urn:uuid:{uuid.uuid4()}", page_id, url, date, payload_digest(payload), len(payload)
    )
    return _with_block(fields, HTTP_HEAD + payload)


# Fields that say where, when and how a record was written.
_OF_THE_WRITE = ("Content-Length", "WARC-Block-Digest", "WARC-Warcinfo-ID")


def renewed(record: Record, run: str, date: str) -> Record:
    """The same content under fresh headers."""
    fields = {k: v for k, v in record.fields.items() if k not in _OF_THE_WRITE}
    own = fields["WARC-Record-ID"].strip("<>")
    return _with_block(fields | {"WARC-Record-ID": f"<{fresh_id(run, own)}>", "WARC-Date": date}, record.block)


def revisit(record: Record, run: str, date: str, original_id: str, original_page, original_url) -> Record:
    """A record for the same capture without its payload; `original_id` is the response's old id."""
    block = record.block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
    fresh = renewed(Record(record.fields, block), run, date)
    fields = {k: v for k, v in fresh.fields.items() if k not in _OF_THE_WRITE}
    fields |= {
        "WARC-Type": "revisit",
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": f"<{fresh_id(run, original_id)}>",
        "WARC-Refers-To-Date": date,
    }
    if original_url is not None:
        fields["WARC-Refers-To-Target-URI"] = original_url
    if original_page is not None:
        fields["X-Refers-To-Page"] = str(original_page)
    return _with_block(fields, block)


class ArchiveWriter:
    """Archives of about `limit` bytes under a folder; `add` tells where a record went."""

    def __init__(self, folder: str, date: str, limit: int = ARCHIVE_BYTES):
        self.fs, self.root = pa.fs.FileSystem.from_uri(folder)
        self.date, self.limit, self.out = date, limit, None

    def add(self, record: Record) -> tuple[str, int]:
        if self.out is not None and self.out.tell() >= self.limit:
            self.close()
        if self.out is None:
            self.fs.create_dir(self.root, recursive=True)
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
            info = warcinfo(self.name, self.date)
            self.info_id = info.fields["WARC-Record-ID"]
            self._write(info)
        return self.name, self._write(Record(record.fields | {"WARC-Warcinfo-ID": self.info_id}, record.block))

    def _write(self, record: Record) -> int:
        at = self.out.tell()
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.out.write(packer.compress(record.to_bytes()) + packer.flush())
        return at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _members(stream, chunk: int = 1 << 18) -> Iterator[tuple[int, bytes]]:
    """(position, content) of each gzip member."""
    data, at = b"", 0
    unpacker, parts, used = zlib.decompressobj(31), [], 0
    while data or (data := stream.read(chunk)):
        parts.append(unpacker.decompress(data))
        used += len(data) - len(unpacker.unused_data)
        data = unpacker.unused_data
        if unpacker.eof:
            yield at, b"".join(parts)
            at += used
            unpacker, parts, used = zlib.decompressobj(31), [], 0
    if used:
        raise ValueError("the archive ends within a record")


def parse(content: bytes) -> Iterator[Record]:
    """The records of one gzip member, by their Content-Length."""
    stream = io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip()] = value.strip()
        yield Record(fields, stream.read(int(fields["Content-Length"])))


def read_records(folder: str, name: str) -> Iterator[tuple[int, Record]]:
    """(position, record) of an archive, as a stream, without what tells of the archive itself."""
    fs, root = pa.fs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
        for at, content in _members(stream):
            for record in parse(content):
                if record.kind != "warcinfo":
                    yield at, record


def shared_uri(spark: SparkSession, folder: str) -> str:
    """A folder as Spark resolves it, spelled as pyarrow takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = files.makeQualified(path).toUri()
    if full.getScheme() not in SCHEMES:
        raise ValueError(f"archives cannot be written to {full.getScheme()}:, only to {', '.join(SCHEMES)}")
    return f"{SCHEMES[full.getScheme()]}://{full.getAuthority() or ''}{full.getRawPath()}"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_PLACED = pa.schema([("archive", pa.string()), ("position", pa.int64())])


def write_archives(pages: DataFrame, folder: str, limit: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """A response record for each page; the result, written, has the place of each record.

    `date` is that of the captures, by default the time of this call.
    """
    uri, date = shared_uri(pages.sparkSession, folder), date or now()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(uri, date, limit)
        for batch in slices(batches, "html"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            yield _table([writer.add(response(i, u, (h or "").encode(), date)) for i, u, h in rows], _PLACED)
        writer.close()

    return scratch.materialize(pages.select("page_id", "url", "html").mapInArrow(run, PLACE), "placed")


def _by_archive(rows: DataFrame) -> DataFrame:
    """The rows of an archive together, archives spread: their rows are small and would else
    be merged into few tasks, but each stands for a whole archive to read."""
    archives = rows.select("archive").distinct().count()
    return rows.repartition(max(1, archives), "archive")


def headers(placed: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives named in `placed`: its place and header fields."""
    uri = shared_uri(placed.sparkSession, folder)
    schema = f"{PLACE}, {HEADER}"
    types = {"string": pa.string(), "long": pa.int64()}
    arrow = pa.schema([(n, types[t]) for n, t in (x.split() for x in schema.split(", "))])

    def row(name: str, at: int, record: Record) -> tuple:
        f = record.fields
        return (
            name,
            at,
            f["WARC-Record-ID"].strip("<>"),
            record.kind,
            _number(f.get("X-Page-ID")),
            f.get("WARC-Target-URI"),
            f.get("WARC-Date"),
            payload_digest(record.payload) if record.kind == "response" else None,
            len(record.payload) if record.kind == "response" else None,
            f["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in f else None,
            _number(f.get("X-Refers-To-Page")),
            f.get("WARC-Refers-To-Target-URI"),
            f.get("WARC-Refers-To-Date"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows = []
                for at, record in read_records(uri, name):
                    rows.append(row(name, at, record))
                    if len(rows) == 2_000:
                        yield _table(rows, arrow)
                        rows = []
                yield _table(rows, arrow)

    return _by_archive(placed.select("archive").distinct()).mapInArrow(run, schema)


def resolve(found: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The response that each record of at least `min_bytes` repeats, itself for an original.

    Columns archive, position, original_id, original_page and original_url. The smallest record of a digest
    comes from an aggregate, which sends one row per task for a frequent payload, and goes back
    to its records by a join that adaptive execution may split.
    """
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "archive", "position")
    payload = ("payload_digest", "payload_bytes")
    large = found.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
    first = large.groupBy(*payload).agg(F.min_by(F.struct("record_id", "page_id", "url"), order).alias("o"))
    originals = first.select(
        *payload,
        F.col("o.record_id").alias("original_id"),
        F.col("o.page_id").alias("original_page"),
        F.col("o.url").alias("original_url"),
    )
    return large.select("archive", "position", *payload).join(originals, list(payload)).drop(*payload)


def rewrite(
    decisions: DataFrame, source: str, target: str, limit: int = ARCHIVE_BYTES, date: str | None = None
) -> DataFrame:
    """Archives with revisit records where `decisions` say so; the places of the records.

    `decisions` has a row (archive, position, original_id, original_page, original_url) for each
    record; with NULL in original_id a record keeps its kind. All get fresh headers. All rows of an archive, which is bounded by
    its size, are handled by one task that reads it once.
    """
    spark = decisions.sparkSession
    read_from, write_to = shared_uri(spark, source), shared_uri(spark, target)
    # Fixed before any task runs: a task that is run again gives the same ids and dates.
    this_run, date = str(uuid.uuid4()), date or now()

    def run(rows: pa.Table) -> pa.Table:
        name = rows.column("archive")[0].as_py()
        columns = (rows.column(c).to_pylist() for c in ("position", "original_id", "original_page", "original_url"))
        originals = {at: tuple(original) for at, *original in zip(*columns)}
        writer, placed = ArchiveWriter(write_to, date, limit), []
        for at, record in read_records(read_from, name):
            own, original = record.fields["WARC-Record-ID"].strip("<>"), originals[at]
            repeats = original[0] not in (None, own) and record.kind == "response"
            made = revisit(record, this_run, date, *original) if repeats else renewed(record, this_run, date)
            placed.append(writer.add(made))
        writer.close()
        return pa.Table.from_batches([_table(placed, _PLACED)])

    return scratch.materialize(_by_archive(decisions).groupBy("archive").applyInArrow(run, PLACE), "placed")


def resolved(found: DataFrame) -> DataFrame:
    """Records with the digest and size of their payload, which a revisit has from the
    response that it refers to."""
    revisits = found.filter("record_type = 'revisit'").drop("payload_digest", "payload_bytes")
    responses = found.filter("record_type = 'response'")
    originals = responses.select(F.col("record_id").alias("refers_to_id"), "payload_digest", "payload_bytes")
    return responses.unionByName(revisits.join(originals, "refers_to_id", "left"))


def deduplicate(pages: DataFrame, min_bytes: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages to archives to deduplicated archives, and one row per record read back from these."""
    spark: SparkSession = pages.sparkSession
    raw, final = scratch.new_folder(spark, "warc"), scratch.new_folder(spark, "warc")
    placed = write_archives(pages, raw, limit)
    found = scratch.materialize(headers(placed, raw), "headers")
    decisions = found.select("archive", "position").join(
        resolve(found, min_bytes), ["archive", "position"], "left"
    )
    again = rewrite(decisions, raw, final, limit)
    return resolved(scratch.materialize(headers(again, final), "headers"))
