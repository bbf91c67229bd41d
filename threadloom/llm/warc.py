"""WARC as a PySpark Python data source: planned file ranges, pushed-down header predicates, payloads decoded on demand.

Archives hold one gzip member a record, with the "sl" (skip lengths) extra field, so a record that a predicate refuses is
passed over by seeking once its header block is read. Each write job leaves a manifest of its archives and of record
offsets in them, by which the planner cuts large files into ranges; archives of a folder without manifests are read whole,
and members without "sl" are read through.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from . import files
from .common import new_path

#: Columns of the source and the header each is read from.
HEADERS = {
    "record_id": "WARC-Record-ID", "type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, headers map<string,string>, payload binary"
#: Distance of the offsets in a manifest, bytes read at a time, records and payload bytes of a batch.
RANGE, READ, RECORDS, BATCH_BYTES = 8 << 20, 1 << 16, 512, 16 << 20
GZIP = "<4sIBBH2sHII"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(fields: dict[str, str], payload: bytes | None, length: int) -> bytes:
    """A record with its HTTP response: header and payload, or for a revisit the header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    body = http if payload is None else http + payload
    head = "".join(f"{k}: {clean(v)}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field says how long it is, packed and unpacked."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(data) + z.flush()
    size = struct.calcsize(GZIP) + len(packed) + 8
    if max(size, len(data)) >> 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return struct.pack(GZIP, b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(data)) + packed + struct.pack("<II", zlib.crc32(data), len(data))


class Range(InputPartition):
    def __init__(self, uri: str, start: int, end: int):
        self.uri, self.start, self.end = uri, start, end


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Take what can be told from the record's header: equality, sets, prefixes and presence."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((HEADERS[column], "in", {f.value}))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((HEADERS[column], "in", set(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((HEADERS[column], "starts", f.value))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((HEADERS[column], "there", None))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            have = headers.get(name)
            if have is None or kind == "in" and have not in value or kind == "starts" and not have.startswith(value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Ranges of the archives that the folder's manifests name, one small file a write job; archives of a folder
        without manifests are read whole."""
        out = []
        for manifest, _ in files.names(self.path, ".manifest"):
            fs, path = files.open_fs(manifest)
            with fs.open_input_stream(path) as f:
                written = json.loads(f.read())
            for name, size, starts in written:
                out += [Range(f"{self.path.rstrip('/')}/{name}", a, z) for a, z in zip(starts, [*starts[1:], size], strict=True)]
        if not out:
            out = [Range(uri, 0, size) for uri, size in files.names(self.path, ".warc.gz")]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64() if c == "payload_length" else pa.binary() if c == "payload" else pa.map_(pa.string(), pa.string()) if c == "headers" else pa.string()) for c in self.names])
        rows: list[tuple] = []
        held = 0
        for headers, length, payload in self.records(partition) if partition.uri else ():
            special = {"payload_length": length, "headers": list(headers.items()), "payload": payload}
            rows.append(tuple(special[c] if c in special else headers.get(HEADERS[c]) for c in self.names))
            held += len(payload or b"") if "payload" in self.names else 0
            if len(rows) >= RECORDS or held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def records(self, partition: Range) -> Iterator[tuple[dict[str, str], int | None, bytes | None]]:
        """(headers, payload length, payload or None) of the range's wanted records."""
        fs, path = files.open_fs(partition.uri)
        decode = self.verify or "payload" in self.names
        with fs.open_input_file(path) as f:
            at = partition.start
            while at < partition.end:
                f.seek(at)
                raw = f.read(READ)
                size = struct.unpack_from("<I", raw, 16)[0] if raw[3:4] == b"\x04" and raw[12:14] == b"sl" else None
                z = zlib.decompressobj(31)
                data, rest = z.decompress(raw, READ), z.unconsumed_tail

                def more(limit: int) -> bytes:
                    nonlocal rest
                    if not rest and not z.eof:
                        rest = f.read(READ)
                        if not rest:
                            raise ValueError(f"{partition.uri} ends inside a record")
                    part = z.decompress(rest, limit)
                    rest = z.unconsumed_tail
                    return part

                while b"\r\n\r\n" not in data and not z.eof:
                    data += more(READ)
                head, _, body = data.partition(b"\r\n\r\n")
                lines = head.decode("utf-8", "replace").split("\r\n")
                headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
                keep = self.wanted(headers)
                total = int(headers.get("Content-Length", 0))
                http = headers.get("Content-Type", "").startswith("application/http")
                length, start, payload = None, 0, None
                if keep:
                    parts, have = [body], len(body)
                    while http and b"\r\n\r\n" not in body and have < total:
                        body += more(READ)
                        parts, have = [body], len(body)
                    if http:
                        top, _, _ = body.partition(b"\r\n\r\n")
                        start = len(top) + 4
                        length = next((int(x.split(b":")[1]) for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
                    else:
                        length = total
                    if decode and headers.get("WARC-Type") != "revisit":
                        while have < total:
                            parts.append(more(1 << 20))
                            have += len(parts[-1])
                        payload = b"".join(parts)[start:total]
                        if self.verify and (len(payload) != length or headers.get("WARC-Payload-Digest", "sha1:" + digest_of(payload)) != "sha1:" + digest_of(payload)):
                            raise ValueError(f"{partition.uri} is damaged at {at}")
                    yield headers, length, payload
                if size is None:
                    while not z.eof:
                        more(1 << 20)
                    size = f.tell() - at - len(z.unused_data)
                at += size


class WarcWriter(DataSourceArrowWriter):
    """Rows of record_id, type, target_uri, date, payload_digest, refers_to, payload_length, payload become records."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        name = f"{self.path}/part-{uuid.uuid4().hex}.warc.gz"
        offsets: list[int] = []

        def members() -> Iterator[bytes]:
            at = 0
            for b in batches:
                for i in range(0, b.num_rows, 64):
                    for r in b.slice(i, 64).to_pylist():
                        fields = {h: r.get(c) for c, h in HEADERS.items() if c != "content_type"} | {"Content-Type": "application/http; msgtype=response"}
                        data = member(record(fields, r["payload"] if r["type"] != "revisit" else None, r["payload_length"]))
                        if not offsets or at - offsets[-1] >= RANGE:
                            offsets.append(at)
                        at += len(data)
                        yield data

        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return Written("", 0, [])
        batches = itertools.chain([first], batches)
        size = files.write_whole(name, members())
        return Written(name.rpartition("/")[2], size, offsets)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """One manifest, written whole, makes all archives of the job visible at once. What a lost or repeated task has left
        is in no manifest, and so is no part of the archive."""
        written = [(m.name, m.size, m.offsets) for m in messages if m is not None and m.name]
        files.write_whole(f"{self.path}/{uuid.uuid4().hex}.manifest", [json.dumps(written).encode()])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Without a manifest nothing is visible; the archives that did get written are deleted."""
        for m in messages:
            if m is not None and m.name:
                fs, path = files.open_fs(f"{self.path}/{m.name}")
                fs.delete_file(path)


class Written(WriterCommitMessage):
    def __init__(self, name: str, size: int, offsets: list[int]):
        self.name, self.size, self.offsets = name, size, offsets


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make format("warc") known. The source travels by value, so that planning workers need no import path."""
    import sys

    cloudpickle.register_pickle_by_value(files)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record a row of pages (page_id, url, html): of equal payloads of at least `least` bytes the smallest page_id
    is the response, the others revisit it; smaller payloads are all responses.

    Null html is an empty payload, a null url no target. A repeated row of the smallest id is a response as well. A row of
    null id comes after all others of its payload. A payload is shuffled once at most; a hot digest is split by the join.
    Very long payloads are records like any other (a row is held whole). Other columns are ignored; an empty table gives an
    empty archive."""
    register(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("hex", F.sha1("payload"))
    first = p.groupBy("hex").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    p = p.join(first, "hex", "left")  # few payloads come twice: where their digests are small, no payload is shuffled
    again = (F.octet_length("payload") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.concat(F.lit("none-"), F.col("hex"))), F.lit(">"))

    def base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest = ["sha1:" + base64.b32encode(bytes.fromhex(h)).decode() for h in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(digest), *b.columns[1:]], ["payload_digest", *b.schema.names[1:]])

    rows = p.select(
        "hex", name(F.col("page_id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("type"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.when(again, name(F.col("first"))).alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_length"), F.when(~again, F.col("payload")).alias("payload"),
    )
    rows = rows.mapInArrow(base32, "payload_digest string, record_id string, type string, target_uri string, date string, refers_to string, payload_length long, payload binary")
    rows.write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record. With verify each response's payload
    is decoded, measured and hashed against its header; revisits are told by their headers."""
    register(spark)
    columns = "record_id string, type string, payload_digest string, refers_to string, payload_length long"
    read = lambda kind, check: spark.read.format("warc").schema(columns).option("verify", str(check)).load(path).where(F.col("type") == kind)
    both = read("response", verify).unionByName(read("revisit", False))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return both.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_pages(spark, path)
