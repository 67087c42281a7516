"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import cut_lineage, scratch_folder, table

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_length long, payload binary")
ARROW_SCHEMA = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                          ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary())])
#: WARC header of every column that headers alone give.
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
             "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a writer starts a new file, and bytes of files that one task reads (a larger file is read alone).
FILE_BYTES, PARTITION_BYTES = 64 << 20, 64 << 20
READ_BYTES = 1 << 18
#: Distinct repeated payloads that are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST_PAYLOADS = 100_000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _one_line(value: str) -> str:
    """A header value: control characters percent-encoded, so no value can end its line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed.  A revisit keeps the HTTP headers, and so the length, of its payload."""
    payload, kind = row["payload"] or b"", row["record_type"] or "response"
    length = row["payload_length"] if row["payload_length"] is not None else len(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length) + (payload if kind != "revisit" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{row['record_id']}>" if row["record_id"] else None), ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}" if row["payload_digest"] else None),
            ("WARC-Refers-To", f"<{row['refers_to']}>" if row["refers_to"] else None), ("WARC-Profile", REVISIT_PROFILE if kind == "revisit" else None),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


class _Stream:
    """Sequential reads of an archive, each record compressed on its own or the file plain."""

    def __init__(self, system: pafs.FileSystem, path: str):
        self.raw = system.open_input_stream(path, compression=None)
        self.inflate = None
        self.held, self.packed = bytearray(), b""
        first = self.raw.read(READ_BYTES)
        if first[:2] == b"\x1f\x8b":
            self.inflate, self.packed = zlib.decompressobj(31), first
        else:
            self.held += first

    def _more(self) -> bytes:
        """The next bytes of the archive; empty at its end."""
        if self.inflate is None:
            return self.raw.read(READ_BYTES)
        while True:
            data, self.packed = self.packed or self.raw.read(READ_BYTES), b""
            if not data:
                return b""
            out = self.inflate.decompress(data, 4 * READ_BYTES)
            if self.inflate.eof:
                self.packed = self.inflate.unused_data.lstrip(b"\x00")
                self.inflate = zlib.decompressobj(31)
            else:
                self.packed = self.inflate.unconsumed_tail
            if out:
                return out

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the archive."""
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            more = self._more()
            if not more:
                return None
            self.held += more
        out = bytes(self.held[:found + len(mark)])
        del self.held[:found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            more = self._more()
            if not more:
                raise ValueError("the archive ends inside a record")
            self.held += more
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, n: int) -> None:
        """Passes over n bytes without keeping them."""
        while n > len(self.held):
            n -= len(self.held)
            self.held = bytearray(self._more())
            if not self.held:
                raise ValueError("the archive ends inside a record")
        del self.held[:n]


def _headers(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


@dataclass
class Wanted:
    """Header predicates: column → allowed values, prefix, or presence."""
    values: dict[str, list] = field(default_factory=dict)
    prefix: dict[str, str] = field(default_factory=dict)
    present: list[str] = field(default_factory=list)

    def admits(self, row: dict) -> bool:
        return (all(row[c] is not None and row[c] in v for c, v in self.values.items())
                and all(row[c] is not None and row[c].startswith(p) for c, p in self.prefix.items())
                and all(row[c] is not None for c in self.present))


def read_records(system, path: str, wanted: Wanted, payload: bool) -> Iterator[dict]:
    """Records of one archive that the predicates admit.  Headers are parsed first: the block of any
    other record, and of every record where no payload is wanted, is passed over."""
    stream = _Stream(system, path)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        while head.startswith(b"\r\n"):
            head = head[2:]
        if not head.strip():
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at this place of {path}")
        h = _headers(head)
        size = int(h.get("content-length", "0"))
        row = {c: h.get(name) for c, name in HEADER_OF.items()}
        for c in ("record_id", "refers_to", "target_uri"):
            if row[c] and row[c][0] == "<" and row[c][-1] == ">":
                row[c] = row[c][1:-1]
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        row |= {"payload_length": None, "payload": None}
        if wanted.admits(row):
            http = h.get("content-type", "").startswith("application/http")
            body = size
            if http and size:
                first = stream.until(b"\r\n\r\n")
                if first is None or len(first) > size:
                    raise ValueError(f"an HTTP block of {path} has no end of headers")
                body = size - len(first)
                length = _headers(first).get("content-length", "")
                row["payload_length"] = int(length) if length.isdigit() else body
            else:
                row["payload_length"] = body
            if payload and row["record_type"] != "revisit":
                row["payload"] = stream.take(body)
            else:
                stream.skip(body)
            yield row
        else:
            stream.skip(size)
        stream.skip(4)      # the two line ends after a block


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted = Wanted()

    def pushFilters(self, filters):
        """Takes over equality, membership, prefixes and presence of header columns."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADER_OF:
                yield f
            elif isinstance(f, EqualTo):
                self._allow(column, [f.value])
            elif isinstance(f, In):
                self._allow(column, list(f.value))
            elif isinstance(f, StringStartsWith) and column not in self.wanted.prefix:
                self.wanted.prefix[column] = f.value
            elif isinstance(f, IsNotNull):
                self.wanted.present.append(column)
            else:
                yield f

    def _allow(self, column: str, values: list) -> None:
        old = self.wanted.values.get(column)
        self.wanted.values[column] = values if old is None else [v for v in values if v in old]

    def partitions(self):
        """Archives in groups of at most ``partition_bytes``.  Where writers left manifests, the files they name; else all archives."""
        system, base = _open(self.path)
        info = system.get_file_info(base)
        if info.type == pafs.FileType.File:
            files = [(base, info.size)]
        else:
            listed = [x for x in system.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)) if x.type == pafs.FileType.File]
            manifests = [x.path for x in listed if x.base_name.startswith("_manifest-")]
            committed = {n for m in manifests for n in json.loads(system.open_input_stream(m).read())}
            files = sorted((x.path, x.size) for x in listed if x.base_name.endswith((".warc", ".warc.gz")) and (not manifests or x.base_name in committed))
        groups, size = [], 0
        for path, n in files:
            if not groups or size + n > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [InputPartition(g) for g in groups] or [InputPartition([])]

    def read(self, partition):
        system, _ = _open(self.path)
        rows, size = [], 0
        for path in partition.value:
            for row in read_records(system, path, self.wanted, self.payload):
                rows.append(row)
                size += len(row["payload"] or b"")
                if len(rows) >= 1024 or size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW_SCHEMA)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW_SCHEMA)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Tasks write files under names of their own attempt; the commit's manifest makes those of the tasks that
    ended well readable, so attempts that were lost or run twice leave nothing that is read."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.job, self.overwrite = options["path"], uuid.uuid4().hex, overwrite
        self.level, self.file_bytes = int(options.get("compresslevel", 4)), int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{base}/{files[-1]}", compression=None), 0
                pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
                size += out.write(pack.compress(record_bytes(row)) + pack.flush())
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        old = [x.path for x in system.get_file_info(pafs.FileSelector(base)) if x.base_name.startswith("_manifest-")] if self.overwrite else []
        with system.open_output_stream(f"{base}/_manifest-{self.job}", compression=None) as out:
            out.write(json.dumps([f for m in messages if m is not None for f in m.files]).encode())
        for path in old:
            system.delete_file(path)

    def abort(self, messages):
        system, base = _open(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            system.delete_file(f"{base}/{name}")


class WarcDataSource(DataSource):
    """Options: path, payload (false: payloads stay unread and null), partition_bytes; writing: compresslevel, file_bytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def use_warc(spark: SparkSession) -> None:
    """Makes the format known to the session and lets filters reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32_sha1(payload):
    """Bare upper-case base32 of the SHA-1 of a binary column: five bits of the hexadecimal digest a letter."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
                 date: str = "1970-01-01T00:00:00Z", max_broadcast: int = MAX_BROADCAST_PAYLOADS) -> DataFrame:
    """One record (columns of the warc format) for each page.

    Of the pages with equal payloads of at least ``least_bytes`` bytes that with the largest id
    is a response; the others are revisits that refer to it and carry no payload.  Null payloads
    are empty ones; null ids are smaller than any other; rows that repeat the largest id are all
    responses; null urls leave the header out; other columns are not read."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("payload_length", F.octet_length("payload").cast("long"))
    kept = cut_lineage(rows.where(F.col("payload_length") >= least_bytes).groupBy("payload_digest", "payload_length")
                       .agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "payload_length", "kept", F.lit(True).alias("shared")), "payloads")
    if kept.count() <= max_broadcast:
        kept = F.broadcast(kept)
    named = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    revisit = F.col("shared") & ~F.col("id").eqNullSafe(F.col("kept"))
    joined = rows.join(kept, ["payload_digest", "payload_length"], "left").withColumn("again", F.coalesce(revisit, F.lit(False)))
    return joined.select(
        F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"), named("id").alias("record_id"), "target_uri",
        F.lit(date).alias("date"), F.when(F.col("again"), named("kept")).alias("refers_to"), "payload_digest", "payload_length",
        F.when(~F.col("again"), F.col("payload")).alias("payload"))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    use_warc(spark)
    path = scratch_folder(spark, "warc")
    page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path)
    page = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    own = F.col("payload").isNotNull()
    return back.select(page(F.col("record_id")).alias("page_id"),
                       F.when(own, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
                       F.when(own, base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
                       "record_type", page(F.col("refers_to")).alias("refers_to"))


def _base32_sql(digest: str) -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    five = [f"(('0x' || substr({digest}, {1 + 5 * g}, 5))::BIGINT >> {5 * (3 - i)}) & 31" for g in range(8) for i in range(4)]
    return " || ".join(f"substr({letters}, 1 + ({x}), 1)" for x in five)


OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex FROM p),
     k AS (SELECT hex, max(page_id) AS kept FROM d GROUP BY hex)
SELECT page_id, payload_bytes, {_base32_sql('d.hex')} AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM d JOIN k USING (hex)
"""
