"""WARC archives (ISO 28500) as a Spark data source, and page archives with revisit records.

Reading packs small files together and splits large compressed ones at members. Predicates on record type and on headers
are pushed down (headers that the caller names are columns of their own, since a lookup in a map is never offered to a
Python source): a record's header is parsed first, and the payload of one that isn't wanted is neither read nor decoded.
In archives of this writer each record is a gzip member that tells its length in the 'sl' extra field, so unwanted records
are skipped by a seek; other compressed archives are inflated past them, uncompressed ones are skipped by their length.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zlib
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from strataloom.llm.blocks import slices
from strataloom.session import materialize, scratch_path

SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("refers_to", T.StringType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("payload", T.BinaryType()),
])
_HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to"}
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


# --- files --------------------------------------------------------------------------------------------------------------


def file_system(path: str):
    """(Arrow file system, path in it) of a local path or a URI of any store that Arrow reaches."""
    from pyarrow import fs

    scheme = urlparse(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path) if scheme else path
    return fs.FileSystem.from_uri(path)


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the archives at or below a path, hidden and unfinished ones left out."""
    from pyarrow import fs

    store, at = file_system(path)
    infos = store.get_file_info([at])
    if infos[0].type == fs.FileType.Directory:
        infos = store.get_file_info(fs.FileSelector(at, recursive=True))
    top = at.rstrip("/")
    shown = lambda i: not any(p[:1] in "._" for p in i.path[len(top) :].split("/") if p)
    return sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and shown(i))


# --- records ------------------------------------------------------------------------------------------------------------


def parse_header(block: bytes) -> dict[str, str]:
    """Named fields of a record header, names in lower case, continuation lines joined, the first of repeated names."""
    lines = block.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and name:
            out[name] = f"{out[name]} {line.strip().decode('utf-8', 'replace')}".strip()
        elif b":" in line:
            key, value = line.split(b":", 1)
            name = key.strip().lower().decode("ascii", "replace")
            if name in out:
                name = None
            else:
                out[name] = value.strip().decode("utf-8", "replace")
    return out


def uri(value: str | None) -> str | None:
    """A header's URI without the angle brackets of older archives."""
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def entity(header: dict[str, str], block: bytes) -> bytes:
    """The payload: for HTTP messages what follows the HTTP header, else the whole block."""
    if header.get("content-type", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class _Plain:
    """Bytes of an uncompressed archive."""

    def __init__(self, file):
        self.file, self.buffer = file, b""

    def header(self) -> bytes | None:
        while (end := self.buffer.find(b"\r\n\r\n")) < 0 or not self.buffer.strip():
            more = self.file.read(1 << 16)
            if not more:
                if self.buffer.strip():
                    raise ValueError("an archive ends within a header")
                return None
            self.buffer = (self.buffer + more).lstrip(b"\r\n") if not self.buffer.strip() else self.buffer + more
        head, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return head

    def take(self, n: int) -> bytes:
        if len(self.buffer) < n:
            self.buffer += self.file.read(n - len(self.buffer))
        if len(self.buffer) < n:
            raise ValueError("an archive ends within a record")
        out, self.buffer = self.buffer[:n], self.buffer[n:].lstrip(b"\r\n")
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.file.seek(n - len(self.buffer), io.SEEK_CUR)
            self.buffer = b""
        self.buffer = self.buffer.lstrip(b"\r\n")


class _Gzip:
    """Bytes of an archive of gzip members, one member to a record."""

    def __init__(self, file, end: int | None = None):
        self.file, self.rest, self.end = file, b"", end

    def header(self) -> bytes | None:
        if self.end is not None and self.file.tell() - len(self.rest) >= self.end:
            return None
        start = self.rest + self.file.read(max(0, 24 - len(self.rest)))
        if not start:
            return None
        if start[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        self.total = None
        if start[3] & 4 and start[12:14] == b"sl":
            self.total = struct.unpack("<I", start[16:20])[0]
        self.inflate, self.read, self.out, self.rest = zlib.decompressobj(31), 0, b"", start
        while (end := self.out.find(b"\r\n\r\n")) < 0:
            if not self._more(4096):
                if self.out.strip():
                    raise ValueError("an archive ends within a header")
                return self.header()
        self.out, head = self.out[end + 4 :], self.out[:end]
        return head.lstrip(b"\r\n")

    def _more(self, most: int) -> bool:
        """Inflate some more of the member; False at its end."""
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
            return False
        data = self.inflate.unconsumed_tail or self.rest or self.file.read(1 << 15)
        if not data:
            raise ValueError("an archive ends within a record")
        if not self.inflate.unconsumed_tail:
            self.read += len(data)
        self.rest = b""
        self.out += self.inflate.decompress(data, most)
        return True

    def take(self, n: int) -> bytes:
        while len(self.out) < n and self._more(max(1 << 16, n)):
            pass
        if len(self.out) < n:
            raise ValueError("an archive ends within a record")
        out = self.out[:n]
        self._finish()
        return out

    def _finish(self) -> None:
        while self._more(1 << 16):
            self.out = b""

    def skip(self, n: int) -> None:
        if self.total is not None and not self.inflate.eof:
            self.file.seek(self.total - self.read, io.SEEK_CUR)  # back, if more than this member has been read
            self.rest = b""
            return
        self.out = b""
        self._finish()


def next_member(file, start: int, step: int = 1 << 20) -> int | None:
    """Where the first gzip member at or after ``start`` that holds a record begins."""
    file.seek(start)
    base, held, more = start, b"", True
    while more:
        data = file.read(step)
        held, more = held + data, bool(data)
        at = held.find(b"\x1f\x8b\x08")
        while at >= 0 and (len(held) - at >= 4096 or not more):
            try:
                if zlib.decompressobj(31).decompress(held[at : at + 4096], 5) == b"WARC/":
                    return base + at
            except zlib.error:
                pass
            at = held.find(b"\x1f\x8b\x08", at + 1)
        keep = at if at >= 0 else max(0, len(held) - 2)
        base, held = base + keep, held[keep:]
    return None


def records(file, wanted, decode: str, start: int = 0, end: int | None = None, columns: tuple[str, ...] = ()):
    """Rows of the records of an open archive that ``wanted(header)`` accepts; ``decode`` as for the data source.

    Of a compressed archive, only records whose member begins within [start, end).
    """
    magic = file.read(2)
    if magic == b"\x1f\x8b":
        first = 0 if start == 0 else next_member(file, start)
        if first is None or end is not None and first >= end:
            return
        file.seek(first)
        source = _Gzip(file, end)
    else:
        file.seek(0)
        source = _Plain(file)
    while (block := source.header()) is not None:
        header = parse_header(block)
        size = int(header.get("content-length", 0))
        if not wanted(header):
            source.skip(size)
            continue
        payload = data = digest = None
        if decode == "none":
            source.skip(size)
        else:
            data = entity(header, source.take(size))
            digest = hashlib.sha256(data).hexdigest()
            payload = data if decode == "payload" else None
        yield (
            header.get("warc-type"), uri(header.get("warc-record-id")), uri(header.get("warc-target-uri")), header.get("warc-date"), uri(header.get("warc-refers-to")),
            header, None if data is None else len(data), digest, payload, *(header.get(c) for c in columns),
        )


# --- the data source ----------------------------------------------------------------------------------------------------


def header_column(name: str) -> str:
    """The column of a header that the caller names: header_ and the name, in lower case, dashes as underscores."""
    return "header_" + name.lower().replace("-", "_")


class WarcPartition(InputPartition):
    """Pieces (path, start, end) of archives."""

    def __init__(self, pieces: list[tuple[str, int, int | None]]):
        self.pieces = pieces


def named_headers(options) -> tuple[str, ...]:
    return tuple(c.strip().lower() for c in options.get("headers", "").split(",") if c.strip())


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.decode = options["path"], options.get("decode", "payload")
        self.partition_bytes, self.least = int(options.get("partitionBytes", 64 << 20)), int(options.get("minPartitions", 1))
        self.split, self.columns = options.get("split", "true").lower() == "true", named_headers(options)
        self.header_of = {**_HEADER_OF, **{header_column(c): c for c in self.columns}}
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        for f in filters:
            at = f.attribute
            name = self.header_of.get(at[0]) if len(at) == 1 else None
            if name and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", (f.value,)))
            elif name and isinstance(f, IsNotNull):
                self.tests.append((name, "known", ()))
            else:
                yield f

    def partitions(self):
        files = list_files(self.path)
        most = max(1, min(self.partition_bytes, max(sum(n for _, n in files) // max(1, self.least), 1 << 20)))
        held, size, out = [], 0, []
        for path, n in files:
            cuts = [*range(0, n, self.partition_bytes)] if path.endswith(".gz") and n > self.partition_bytes and self.split else [0]
            for a, e in zip(cuts, [*cuts[1:], None], strict=True):
                k = (n if e is None else e) - a
                if held and size + k > most:
                    out.append(WarcPartition(held))
                    held, size = [], 0
                held.append((path, a, e))
                size += k
        return [*out, WarcPartition(held)] if held else out or [WarcPartition([])]

    def wanted(self, header: dict[str, str]) -> bool:
        for name, kind, values in self.tests:
            v = header.get(name)
            v = uri(v) if name in _HEADER_OF.values() else v
            if v is None or kind == "in" and v not in values or kind == "starts" and not v.startswith(values[0]):
                return False
        return True

    def read(self, partition):
        store, _ = file_system(self.path)
        for path, start, end in partition.pieces:
            with store.open_input_file(path) as file:
                yield from records(file, self.wanted, self.decode, start, end, self.columns)


def member(header: bytes, block: bytes, level: int) -> bytes:
    """A record as a gzip member that tells its length."""
    raw = header + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    extra = b"sl" + struct.pack("<HII", 8, 24 + len(body) + 8, len(raw) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def field(value: str) -> str:
    """A header value without line ends."""
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~ ") if any(ord(c) < 32 or ord(c) == 127 for c in value) else value


class WarcWriter(DataSourceArrowWriter):
    """Columns record_type, record_id, target_uri, refers_to, payload, payload_sha256 and payload_bytes, one record each.

    A task writes files of its own below _unfinished; the commit moves those of the attempts that Spark accepted.
    """

    def __init__(self, options):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.level, self.file_bytes = int(options.get("level", 4)), int(options.get("fileBytes", 64 << 20))
        self.run = uuid.uuid4().hex[:12]

    def _record(self, kind, ident, target, refers, payload, digest, size) -> bytes:
        revisit = kind == "revisit"
        block = b"" if revisit else _HTTP % len(payload) + payload
        head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{field(ident)}>", f"WARC-Date: {self.date}"]
        if target is not None:
            head.append(f"WARC-Target-URI: {field(target)}")
        head.append(f"WARC-Payload-Digest: sha256:{digest}")
        if revisit:
            head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{field(refers)}>", f"X-Payload-Length: {size}"]
        else:
            head.append("Content-Type: application/http; msgtype=response")
        head.append(f"Content-Length: {len(block)}")
        return member("\r\n".join(head).encode(), block, self.level)

    def write(self, iterator):
        store, at = file_system(self.path)
        folder, names, out, size = f"{at}/_unfinished-{self.run}", [], None, 0
        store.create_dir(folder, recursive=True)
        for batch in iterator:
            for b in slices([batch], "payload"):
                for row in zip(*(b.column(c).to_pylist() for c in ("record_type", "record_id", "target_uri", "refers_to", "payload", "payload_sha256", "payload_bytes")), strict=True):
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                        info = b"software: a Spark data source\r\nformat: WARC File Format 1.1\r\n"
                        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {self.date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}"
                        out.write(member(head.encode(), info, self.level))
                    data = self._record(*row)
                    out.write(data)
                    size += len(data)
        if out is not None:
            out.close()
        message = WriterCommitMessage()
        message.names = names
        return message

    def commit(self, messages):
        store, at = file_system(self.path)
        for m in messages:
            for name in m.names if m else ():
                store.move(f"{at}/_unfinished-{self.run}/{name}", f"{at}/{name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        store, at = file_system(self.path)
        folder = f"{at}/_unfinished-{self.run}"
        if store.get_file_info([folder])[0].type == fs.FileType.Directory:
            store.delete_dir(folder)


class WarcDataSource(DataSource):
    """Format "warc". Options: path; decode = payload, digest (size and SHA-256 only) or none; headers (names, parted by
    commas, of headers to have as columns header_...); partitionBytes, minPartitions; split (true: compressed files over partitionBytes are split where a member begins with a
    record; turn it off for archives that hold other .warc.gz files uncompressed); for writing date, level and fileBytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return T.StructType([*SCHEMA.fields, *(T.StructField(header_column(c), T.StringType()) for c in named_headers(self.options))])

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, decode: str = "payload", **options) -> DataFrame:
    """Records at or below a path, with predicate pushdown turned on for Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    options.setdefault("minPartitions", spark.sparkContext.defaultParallelism)
    return spark.read.format("warc").options(decode=decode, **options).load(path)


def write_warc(rows: DataFrame, path: str, **options) -> None:
    rows.sparkSession.dataSource.register(WarcDataSource)
    rows.write.format("warc").options(**options).mode("append").save(path)


# --- page archives ------------------------------------------------------------------------------------------------------

_URN = "urn:x-page:"


def archive_pages(pages: DataFrame, path: str, least: int = 100, **options) -> None:
    """Write one record per page: page_id, url and html (null: empty), as UTF-8.

    Of the pages with equal payloads of at least ``least`` bytes, the one with the smallest page_id (rows that repeat it
    alike) is a response, the others revisit it; smaller payloads are all responses. A null page_id has the record id
    "...null" and never is what others revisit, unless no page of the group has an id: then all are responses.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), body.alias("payload"), F.sha2(body, 256).alias("payload_sha256"), F.octet_length(body).cast("long").alias("payload_bytes"))
    groups = rows.where(F.col("payload_bytes") >= least).groupBy("payload_sha256").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1").select(F.col("payload_sha256").alias("key"), "first")
    # small payloads have keys of their own, so that the join spreads them evenly; one kind of join at every size
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "payload_sha256").cast("string"))
    joined = rows.withColumn("own", F.when(F.col("payload_bytes") >= least, F.col("payload_sha256")).otherwise(alone)).join(groups.hint("merge"), F.col("own") == F.col("key"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit(_URN), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    out = joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), "target_uri",
        F.when(again, urn("first")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"), "payload_sha256", "payload_bytes",
    )
    write_warc(out, path, **options)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the pages in archives of archive_pages.

    Sizes and digests are those of payloads as read: a revisit's are its response's, found by the page and the digest that
    its header names. A response whose payload differs from its declared digest is an error, as is a revisit of nothing.
    """
    rows = read_warc(spark, path, decode="digest", headers="warc-payload-digest").where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.expr(f"try_cast(substr({c}, {len(_URN) + 1}) as bigint)")
    declared = F.substring_index(F.col("header_warc_payload_digest"), ":", -1).alias("declared")
    rows = materialize(rows.select("record_type", "record_id", page("record_id").alias("page_id"), page("refers_to").alias("refers_to"), declared, "payload_bytes", "payload_sha256"), "warc-rows")
    wrong = lambda what: F.raise_error(F.concat(F.lit(what), F.col("record_id")))
    digest = F.when(F.col("declared").eqNullSafe(F.col("payload_sha256")), F.col("declared")).otherwise(wrong("payload differs from its digest: "))
    responses = rows.where("record_type = 'response'").select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
    known = rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("r_id"), F.col("payload_sha256").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes"))
    again = rows.where("record_type = 'revisit'").join(known.hint("merge"), (F.col("refers_to") == F.col("r_id")) & (F.col("declared") == F.col("r_digest")), "left")
    size = F.when(F.col("r_bytes").isNull(), wrong("revisit of no response: ")).otherwise(F.col("r_bytes"))
    return responses.unionByName(again.select("page_id", size.alias("payload_bytes"), F.col("r_digest").alias("payload_digest"), "record_type", "refers_to"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and read the archives back.

    Null html is an empty payload, empty and very long payloads are stored whole, an empty table gives an empty result, and
    other columns than page_id, url and html are ignored, whatever their names.
    """
    path = scratch_path(pages.sparkSession, "warc")
    archive_pages(pages, path)
    return read_pages(pages.sparkSession, path)


SQL = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body)::bigint as payload_bytes, sha256(body) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
"""
