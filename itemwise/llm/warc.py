"""WARC archives as a Spark data source (operator 6).

``spark.read.format("warc").load(folder)`` plans one partition for each
archive file and takes over predicates on the header columns (record type,
ids, target URI, digest, payload length): a record's headers are parsed
first, and the block of a record that is not wanted is skipped by its
Content-Length without being read.  With ``option("payload", "false")`` no
block is read at all.  Writing stages each task's files and moves them into
the folder when the whole job commits, so lost or repeated attempts leave
nothing behind that a reader would see; a file ends after ``file_bytes``.

Revisits: of records with equal payloads of ``least_bytes`` or more, the one
with the largest page_id keeps its payload, the others refer to it.

Input handling: null html is an empty payload; a null url gives no target
URI, control characters in one are percent-encoded; a null page_id gives the
id ``null``, never the one that others refer to unless all are null; rows
that repeat page_id and payload are all responses; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo,
                                    Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull,
                                    LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from itemwise.llm import files
from itemwise.session import scratch_path, write_scratch

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_bytes long, payload string")
FILE_BYTES = 256 << 20
LEAST_BYTES = 1000
FEW_LEADS = 500_000          # repeated digests (some 100 bytes each) that may be broadcast
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 22

# Header name of each column that a predicate can be pushed down to.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "payload_bytes": "x-payload-length",
}


def _clean(value: str) -> str:
    """A header value: control characters and spaces are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in value)


def record_bytes(row: dict) -> bytes:
    """One record; a revisit has the HTTP head but no payload."""
    payload = (row["payload"] or "").encode() if row["record_type"] != "revisit" else b""
    block = (HTTP % (row["payload_bytes"] or 0)).encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {_clean(row['record_type'])}",
            f"WARC-Record-ID: <{_clean(row['record_id'])}>",
            f"WARC-Date: {_clean(row['date'] or '1970-01-01T00:00:00Z')}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if row["payload_digest"]:
        digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
        head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if row["refers_to"] is not None:
        head += [f"WARC-Refers-To: <{_clean(row['refers_to'])}>", f"WARC-Profile: {PROFILE}"]
    head += [f"X-Payload-Length: {row['payload_bytes'] or 0}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def header_columns(headers: dict[str, str]) -> dict:
    """Column values that the headers alone give."""
    out = {c: headers.get(h) for c, h in HEADERS.items()}
    for c in ("record_id", "refers_to"):
        if out[c] is not None:
            out[c] = out[c].strip("<>")
    digest = out["payload_digest"]
    if digest and digest.startswith("sha1:"):
        out["payload_digest"] = base64.b32decode(digest[5:]).hex()
    out["payload_bytes"] = int(out["payload_bytes"]) if out["payload_bytes"] is not None else None
    return out


def _test(f: Filter, row: dict) -> bool | None:
    """SQL truth of a pushed predicate: None where it is unknown."""
    if isinstance(f, Not):
        inner = _test(f.child, row)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None:
        return None
    if isinstance(f, In):
        return value in f.value or (None if None in f.value else False)
    if f.value is None:
        return None
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, GreaterThan):
        return value > f.value
    if isinstance(f, GreaterThanOrEqual):
        return value >= f.value
    if isinstance(f, LessThan):
        return value < f.value
    if isinstance(f, LessThanOrEqual):
        return value <= f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    return f.value in value


_KNOWN = (IsNull, IsNotNull, EqualNullSafe, EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan,
          LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)


def pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return pushable(f.child)
    return isinstance(f, _KNOWN) and len(f.attribute) == 1 and f.attribute[0] in HEADERS


class _Stream:
    """Buffered reading with skips that seek."""

    def __init__(self, f, size: int = READ_BYTES):
        self.f, self.size, self.held, self.at = f, size, b"", 0

    def _more(self) -> bool:
        new = self.f.read(self.size)
        self.held, self.at = self.held[self.at:] + new, 0
        return bool(new)

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.held.find(mark, self.at)) < 0:
            if not self._more():
                return None
        out, self.at = self.held[self.at:i], i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n and self._more():
            pass
        out = self.held[self.at:self.at + n]
        if len(out) < n:
            raise EOFError("truncated WARC record")
        self.at += n
        return out

    def skip(self, n: int) -> None:
        ahead = n - (len(self.held) - self.at)
        if ahead <= 0:
            self.at += n
        else:
            self.f.seek(ahead, 1)
            self.held, self.at = b"", 0


def read_records(path: str, filters: Sequence[Filter] = (), payload: bool = True) -> Iterator[dict]:
    """Records of one archive that pass the filters."""
    with files.opened(path) as f:
        stream = _Stream(f)
        while (head := stream.until(b"\r\n\r\n")) is not None:
            first, *lines = head.decode().split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError(f"not a WARC record in {path}: {first[:40]!r}")
            headers = {}
            for line in lines:
                name, _, value = line.partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            row = header_columns(headers)
            row["payload"] = None
            if not all(_test(x, row) for x in filters):
                stream.skip(length + 4)
                continue
            if payload and row["record_type"] != "revisit":
                block = stream.take(length)
                row["payload"] = block[block.find(b"\r\n\r\n") + 4:].decode(errors="replace")
                stream.skip(4)
            else:
                stream.skip(length + 4)
            yield row


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in files.list_files(self.path, ".warc")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:   # an empty folder
            return
        kinds = {c: pa.int64() if c == "payload_bytes" else pa.string() for c in self.names}
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in held], kinds[c]) for c in self.names], self.names)

        for row in read_records(partition.value, self.filters, self.payload):
            held.append(row)
            size += 200 + len(row["payload"] or "")
            if size >= READ_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.stage = f"{self.path}/_staged-{uuid.uuid4().hex[:12]}"
        self.limit = int(options.get("file_bytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files.make_folder(self.stage)
        names: list[str] = []

        def rows():
            for batch in iterator:
                for i in range(0, batch.num_rows, 64):
                    yield from batch.slice(i, 64).to_pylist()

        source, row = rows(), None
        row = next(source, None)
        while row is not None:
            name, size = f"{uuid.uuid4().hex}.warc", 0
            with files.written(f"{self.stage}/{name}") as out:
                while row is not None and size < self.limit:
                    raw = record_bytes({"date": None, "target_uri": None, "refers_to": None, "payload": None, **row})
                    out.write(raw)
                    size += len(raw)
                    row = next(source, None)
            names.append(name)
        return Written(names)

    def commit(self, messages) -> None:
        files.make_folder(self.path)
        if self.overwrite:
            for old in files.list_files(self.path, ".warc"):
                files.remove(old)
        for name in (n for m in messages if m for n in m.names):
            files.move(f"{self.stage}/{name}", f"{self.path}/{name}")
        files.remove_folder(self.stage)

    def abort(self, messages) -> None:
        files.remove_folder(self.stage)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let Spark push predicates."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records_of(pages: DataFrame, least_bytes: int = LEAST_BYTES, few_leads: int = FEW_LEADS) -> DataFrame:
    """WARC records of ``pages`` (page_id, url, html), repeats as revisits."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"),
                        F.coalesce("html", F.lit("")).alias("payload"))
    base = base.withColumns({"payload_digest": F.sha1(F.encode("payload", "UTF-8")),
                             "payload_bytes": F.octet_length("payload").cast("long")})
    # Only digests that occur twice matter; counts are combined map-side.  Few
    # of them are broadcast, so that no payload is shuffled; many are not.
    leads = (base.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
             .agg(F.max("page_id").alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    leads = write_scratch(leads, "warc-leads")
    joined = base.join(F.broadcast(leads) if leads.count() <= few_leads else leads, "payload_digest", "left")
    again = F.col("lead").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("lead"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"),
        "target_uri", F.when(again, urn("lead")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> str:
    """Write ``pages`` as archives and return their folder."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or scratch_path(spark, "warc")
    records_of(pages, least_bytes).write.format("warc").mode("append").save(folder)
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    every record; a response's length and digest are taken from its payload."""
    register(spark)
    records = spark.read.format("warc").load(folder)
    number = lambda c: F.expr(f"try_cast(substr({c}, length('urn:page:') + 1) AS BIGINT)")
    has = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(has, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(has, F.sha1(F.encode("payload", "UTF-8"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
