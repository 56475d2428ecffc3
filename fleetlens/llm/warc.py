"""WARC archives as a PySpark Python data source.

``spark.read.format("warc")`` plans one partition per stretch of an archive
file; the writer notes beside each archive where stretches may start, and a
file without such notes is one partition.  Filters on ``record_type`` and on headers are pushed down: a record's
header block is parsed first, and its payload is read and decoded only if the
header passed and the caller asked for payloads; otherwise the reader seeks to
the next record.  Archives compressed by member (``.warc.gz``) are read too, in
one partition each; their skipped payloads are inflated, as gzip demands, but
not decoded.  Names of header fields are matched without regard to case.
``df.write.format("warc")`` writes one archive per task and publishes it under
its final name only when the job commits, so the files of lost or repeated
tasks are never read, and jobs that write to one folder do not meet.

Files are reached through ``pyarrow.fs``, so paths may name any store it knows;
``s3a`` and ``s3n`` are its ``s3``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from ..session import ship
from .common import fresh_path, small, written

CRLF = b"\r\n"
#: Bytes of an archive after which the next record may open another read partition.
SPLIT_BYTES = 64 << 20
#: Records shorter than this many payload bytes are never turned into revisits.
MIN_REVISIT_BYTES = 0
#: Folders of archives that are not committed begin so.
OPEN = "_open-"
#: Fixed value: the profile of revisits whose payload is the same.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A table of repeated payloads up to this many rows is broadcast; a longer one is joined by shuffling.
MAX_BROADCAST_PAYLOADS = 200_000

READ_SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_bytes long, content_length long, payload binary"
#: Column of the source, and the header that a pushed filter on it reads.
HEADER_OF = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, record_type: str, uri: str, digest: str, refers_to: str | None, payload_bytes: int, payload: bytes | None) -> bytes:
    """One record.  A revisit carries the HTTP header of its response, without the payload."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % payload_bytes, b"", b""])
    block = http + (payload or b"" if record_type == "response" else b"")
    head = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Target-URI", " ".join(uri.split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)] if record_type == "revisit" else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + CRLF + block + CRLF + CRLF


def parse_header(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The next record's header fields, names in lower case; None at the end.  The stream then stands at the block."""
    line = stream.readline()
    while line in (CRLF, b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should start: {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (CRLF, b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def bare(value: str | None) -> str | None:
    return value.removeprefix("<").removesuffix(">") if value is not None else None


def column_value(fields: dict[str, str], column: str) -> str | None:
    value = bare(fields.get(HEADER_OF[column].lower()))
    return value.removeprefix("sha1:") if column == "payload_digest" and value else value


class Stretch(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


def filesystem(path: str):
    from pyarrow import fs

    scheme, colon, rest = path.partition("://")
    if colon and scheme in ("s3a", "s3n"):
        path = f"s3://{rest}"
    return fs.FileSystem.from_uri(path) if colon or path.startswith("file:/") else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, payload: bool):
        self.path, self.payload = options["path"], payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equalities and lists on header columns; all else stays with Spark."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in HEADER_OF and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        store, at = filesystem(self.path)
        files = {i.path: i.size or 0 for i in store.get_file_info(fs.FileSelector(at, recursive=True)) if i.is_file and f"/{OPEN}" not in i.path[len(at) :]}
        out: list[InputPartition] = [Stretch(p, 0, 1 << 62) for p in sorted(files) if p.endswith(".warc.gz")]
        for path in sorted(p for p in files if p.endswith(".warc")):
            cuts = [0]
            if path + ".cuts" in files:  # a payload may hold text that looks like a record, so cuts are never guessed
                with store.open_input_stream(path + ".cuts") as f:
                    cuts = [int(x) for x in f.read().split()]
            out += [Stretch(path, a, b) for a, b in zip(cuts, [*cuts[1:], files[path]], strict=True)]
        return out or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        if not partition.path:
            return
        store, _ = filesystem(self.path)
        with store.open_input_file(partition.path) as raw:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if partition.path.endswith(".gz") else raw, 1 << 16)
            stream.seek(partition.start)
            while stream.tell() < partition.end:
                fields = parse_header(stream)
                if fields is None:
                    return
                if "content-length" not in fields:
                    raise ValueError(f"{partition.path}: a record without a length at {stream.tell()}")
                length = int(fields["content-length"])
                block = stream.tell()
                if all(column_value(fields, c) in values for c, values in self.wanted.items()):
                    yield self._row(fields, stream, length)
                stream.seek(block + length + 2 * len(CRLF))

    def _row(self, fields: dict[str, str], stream, length: int) -> tuple:
        """Header fields; the HTTP header of the block for the payload's length; the payload if asked for.

        A block that is no HTTP message is its own payload.  A payload is held
        against its digest where the record gives one by SHA-1.
        """
        start = stream.tell()
        http = fields.get("content-type", "").lower().startswith("application/http")
        n, seen = 0 if http else length, set()
        while http and (line := stream.readline()) not in (CRLF, b"\n", b""):
            name, _, value = line.partition(b":")
            seen.add(name.strip().lower().decode("latin-1"))
            if name.strip().lower() == b"content-length":
                n = int(value)
        body = length - (stream.tell() - start)
        row = [column_value(fields, c) for c in ("record_id", "record_type", "target_uri", "payload_digest", "refers_to")] + [n, length]
        if not self.payload:
            return (*row, None)
        payload = stream.read(body)
        kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "")
        if kind == "response" and said.startswith("sha1:") and "transfer-encoding" not in seen and digest_of(payload) != row[3]:
            raise ValueError(f"{row[0]}: the payload does not match its digest")
        return (*row, payload if kind != "revisit" else None)


class Archived(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class WarcWriter(DataSourceWriter):
    """Each task writes a file under a folder of the job's own; the commit moves the finished ones out."""

    def __init__(self, options: dict):
        self.path, self.split_bytes, self.open = options["path"], int(options.get("splitbytes", SPLIT_BYTES)), f"{OPEN}{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> WriterCommitMessage:
        store, at = filesystem(self.path)
        name, out, cuts, size = f"{uuid.uuid4().hex}.warc", None, [0], 0
        try:
            for r in rows:
                if out is None:
                    store.create_dir(f"{at}/{self.open}")
                    out = store.open_output_stream(f"{at}/{self.open}/{name}")
                if size - cuts[-1] >= self.split_bytes:
                    cuts.append(size)
                record = record_bytes(r.record_id, r.record_type, r.target_uri or "", r.payload_digest or digest_of(bytes(r.payload or b"")), r.refers_to, r.payload_bytes, r.payload)
                out.write(record)
                size += len(record)
        finally:
            if out is not None:
                out.close()
        if out is None:
            return Archived(None)
        with store.open_output_stream(f"{at}/{self.open}/{name}.cuts") as f:
            f.write("\n".join(map(str, cuts)).encode())
        return Archived(name)

    def commit(self, messages: list) -> None:
        store, at = filesystem(self.path)
        store.create_dir(at)
        for m in messages:
            for name in (f"{m.name}.cuts", m.name) if m is not None and m.name else ():
                store.move(f"{at}/{self.open}/{name}", f"{at}/{name}")
        self._clear(store, at)

    def abort(self, messages: list) -> None:
        self._clear(*filesystem(self.path))

    def _clear(self, store, at: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{at}/{self.open}").type == fs.FileType.Directory:
            store.delete_dir(f"{at}/{self.open}")


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (default true) to have payloads decoded; when writing, ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options, self.options.get("payload", "true") == "true")

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def plan_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The records to write: the largest id of equal payloads responds, others revisit it.

    A null payload is empty; payloads of any length are written whole.  Repeated
    rows of the largest id all respond; a row without an id is never referred
    to, and always responds unless another row has its payload.  Ids of any
    type are written as text, percent-encoded.  Other columns are ignored,
    whatever their names.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("__n"), F.col(uri_col).cast("string").alias("target_uri"), payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "__sha1": F.unhex(F.sha1("payload"))}
    )
    same = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("__sha1").agg(F.max("__n").alias("__best"), F.count(F.lit(1)).alias("__copies")).where("__copies > 1 AND __best IS NOT NULL").drop("__copies")
    shared, _ = written(same.withColumnRenamed("__sha1", "__same"), "payloads")
    side = F.broadcast(shared) if small(shared, MAX_BROADCAST_PAYLOADS) else shared
    revisit = F.col("__best").isNotNull() & ~F.col("__n").eqNullSafe(F.col("__best"))
    return rows.join(side, (F.col("__sha1") == F.col("__same")) & (F.col("payload_bytes") >= min_bytes), "left").select(
        F.coalesce(urn(F.col("__n")), F.lit("urn:nopage:")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        base32(F.hex("__sha1")).alias("payload_digest"),
        F.when(revisit, urn(F.col("__best"))).alias("refers_to"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def urn(key: F.Column) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.url_encode(key.cast("string")))


def base32(hex_col) -> F.Column:
    """RFC 4648 base32 of 20 bytes given as 40 hexadecimal digits: four groups of 5 bytes, each 8 letters."""
    groups = [F.lpad(F.conv(F.substring(hex_col, 1 + 10 * g, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", **kw) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads back what their headers say of each.

    Ids come back in the type of ``id_col``, null where the row had none.  An
    empty table gives an empty result.
    """
    spark, path = pages.sparkSession, fresh_path(pages.sparkSession, "warc")
    write_archives(plan_records(pages, id_col, **kw), path)
    responses = read_archives(spark, path).where("record_type = 'response'")  # their payloads are decoded and held against the digest
    revisits = read_archives(spark, path, payload=False).where("record_type = 'revisit'")  # headers only
    responses = responses.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    key = lambda c: F.when(c.startswith("urn:page:"), F.url_decode(F.substring(c, len("urn:page:") + 1, 1 << 30))).cast(pages.schema[id_col].dataType)
    return responses.unionByName(revisits).select(key(F.col("record_id")).alias(id_col), "payload_bytes", "payload_digest", "record_type", key(F.col("refers_to")).alias("refers_to"), "target_uri")
