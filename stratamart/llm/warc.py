"""WARC archives as a Spark data source, and an archive of pages in which equal payloads are stored once.

Reading: files are planned as partitions by their sizes. Predicates on the record's type and header fields are
handed to the reader (``where`` of ``read_warc``). Of every record the header is parsed first; a record that
they reject is skipped, and its payload is neither read nor inflated. Of one that they accept, the payload is
decoded only if the schema asks for it: give ``columns`` to ``read_warc`` and only these are made. Predicates
are an option of the scan and not Spark's own filter pushdown for Python sources: that keeps the last filters
with the relation, so that two queries over one DataFrame see each other's. Any filter on the DataFrame is
right, it only saves nothing.

Writing: a record is one gzip member with its compressed length in the ``sl`` extra field, which the format
describes for that purpose, so a reader can go on to the next record without inflating. Tasks write files of
their own and start a new one when it is large enough; the commit names the files that count in one manifest,
so what a lost or repeated task leaves behind is never read. Folders without a manifest are read as they are.

Defined results: files may be gzipped record by record, with or without ``sl``, or plain. A file that is not
made of records raises, as does a gzip member that holds more than one. A missing header field is NULL. Of
field names that are repeated the first counts. A payload of HTTP records is the body as stored. An archive of
pages takes NULL html as empty and NULL ids and urls as missing; rows of one id and payload are alike all
response or all revisit. Texts of any length are stored whole. An empty table makes an archive without
records. Columns that are not asked for are not read, whatever their names.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from stratamart.sources.shared_folder import fresh_folder

#: Payloads of at least this many bytes are stored once, however many pages have them.
LEAST_REVISIT_BYTES = 100
#: Bytes of files in one partition when reading, and of one file when writing.
PARTITION_BYTES, FILE_BYTES = 64 << 20, 128 << 20
COMPRESSION_LEVEL = 6
#: Bytes of one payload's rows that a task may get; payloads with more are spread over several tasks.
HOT_BYTES = 16 << 20
#: No more payloads than this can each have more than 1 / MOST_HOT of all bytes.
MOST_HOT = 10_000

MANIFEST = "_records.json"
RECORDS = (
    "record_type string, record_id string, date string, target_uri string, content_type string, content_length long, "
    "payload_digest string, refers_to string, headers map<string,string>, payload_bytes long, payload binary"
)
#: Fixed names of the format: header field of each column.
FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "date": "warc-date",
    "target_uri": "warc-target-uri",
    "content_type": "content-type",
    "content_length": "content-length",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD_END = b"\r\n\r\n"
_READ = 8_192
_BATCH_ROWS, _BATCH_BYTES = 256, 4 << 20


def _located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it. Spark does not escape local paths."""
    if path.startswith("file:") or "://" not in path:
        return arrow_fs.LocalFileSystem(), path if path.startswith("/") else "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


# -- one record at a time ---------------------------------------------------------------------------


class _Plain:
    """A record that starts at a place of an uncompressed file."""

    def __init__(self, file, at: int) -> None:
        self._file, self._at, self._held = file, at, b""

    def more(self) -> bytes:
        """Some more bytes of the record and what follows it; nothing at the end of the file."""
        self._file.seek(self._at + len(self._held))
        read = self._file.read(_READ)
        self._held += read
        return read

    def upto(self, end: int) -> bytes:
        """Its first ``end`` bytes."""
        if len(self._held) < end:
            self._file.seek(self._at + len(self._held))
            self._held += self._file.read(end - len(self._held))
        return self._held[:end]

    def next(self, end: int) -> int:
        """Where the next record starts if this one has ``end`` bytes, line breaks behind it included."""
        return self._at + end


class _Member:
    """A record that is the gzip member at a place of a file; inflated no further than asked."""

    def __init__(self, file, at: int) -> None:
        self._file, self._start = file, at
        file.seek(at)
        head = file.read(_READ)
        self._length = self._skip_length(head)
        self._inflater = zlib.decompressobj(31)
        self._next = at + len(head)
        self._pending, self._held, self.inflated = head, b"", 0

    @staticmethod
    def _skip_length(head: bytes) -> int | None:
        """The member's compressed length, if its extra field has it."""
        if len(head) < 12 or not head[3] & 4:
            return None
        at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
        while at + 4 <= min(end, len(head)):
            name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
            if name == b"sl" and size == 8:
                return struct.unpack_from("<I", head, at + 4)[0]
            at += 4 + size
        return None

    def more(self, most: int = _READ) -> bytes:
        while not self._inflater.eof:
            if not self._pending:
                self._file.seek(self._next)
                self._pending = self._file.read(max(_READ, most))
                self._next += len(self._pending)
                if not self._pending:
                    raise ValueError("a gzip member that never ends")
            got = self._inflater.decompress(self._pending, most)
            self._pending = self._inflater.unconsumed_tail
            if got:
                self._held += got
                self.inflated += len(got)
                return got
        return b""

    def upto(self, end: int) -> bytes:
        parts, size = [], len(self._held)
        while size < end:  # collected apart, so that long payloads are not copied again and again
            held, self._held = self._held, b""
            got = self.more(max(_READ, end - size))
            self._held, size = held, size + len(got)
            parts.append(got)
            if not got:
                break
        self._held = b"".join([self._held, *parts])
        return self._held[:end]

    def next(self, end: int) -> int:
        if self._length:
            return self._start + self._length
        size, self._held = len(self._held), b""
        while got := self.more(1 << 20):  # to its end, keeping nothing
            size, self._held = size + len(got), b""
        if size > end:
            raise ValueError("a gzip member with more than one record")
        return self._next - len(self._inflater.unused_data)


def _fields(lines: bytes) -> dict[str, str]:
    """Named fields by lower-case name; lines that begin with white space go on with the one before."""
    out: dict[str, str] = {}
    name = None
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        key, colon, value = line.partition(":")
        name = key.strip().lower() if colon else None
        if name is not None:
            if name in out:
                name = None
            else:
                out[name] = value.strip()
    return out


class Record:
    """A record whose header is parsed; the rest is read when asked for."""

    def __init__(self, source: _Plain | _Member) -> None:
        self._source, head, end = source, b"", -1
        while end < 0:
            got = source.more()
            if not got:
                raise ValueError("a header that never ends")
            from_here = max(0, len(head) - len(_HEAD_END))
            head += got
            end = head.find(_HEAD_END, from_here)
        version, _, lines = head[:end].partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        self.fields = _fields(lines)
        self.start, self.length = end + len(_HEAD_END), int(self.fields.get("content-length", ""))
        self._payload_start: int | None = None

    @property
    def _is_http(self) -> bool:
        return self.fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")

    def http_head(self) -> bytes:
        """Status line and header of an HTTP block, with the blank line; nothing of other blocks."""
        if not self._is_http:
            return b""
        size = min(self.length, _READ)
        while True:
            block = self._source.upto(self.start + size)[self.start :]
            end = block.find(_HEAD_END)
            if end >= 0 or size >= self.length:
                return block[: end + len(_HEAD_END)] if end >= 0 else block
            size = min(self.length, 2 * size)

    def payload_bytes(self) -> int:
        """Bytes of the payload; of a revisit those that its HTTP header tells of."""
        head = self.http_head()
        if self.fields.get("warc-type") == "revisit":
            told = _fields(head).get("content-length", "")
            return int(told) if told.isdigit() else 0
        return self.length - len(head)

    def payload(self) -> bytes:
        head = len(self.http_head())
        return self._source.upto(self.start + self.length)[self.start + head :]

    def next(self) -> int:
        return self._source.next(self.start + self.length + len(_HEAD_END))

    def value(self, column: str) -> object:
        if column == "headers":
            return list(self.fields.items())
        if column in ("payload", "payload_bytes"):
            return getattr(self, column)()
        if column == "content_length":
            return self.length
        found = self.fields.get(FIELDS[column])
        if found is not None and column in ("record_id", "refers_to", "target_uri"):
            found = found.removeprefix("<").removesuffix(">")
        return found


def records(file, size: int, wanted: Callable[[Record], bool] = lambda record: True) -> Iterator[Record]:
    """The wanted records of an open file in order. Use each before asking for the next."""
    at = 0
    while at < size:
        file.seek(at)
        magic = file.read(2)
        try:
            record = Record((_Member if magic == b"\x1f\x8b" else _Plain)(file, at))
            if wanted(record):
                yield record
            at = record.next()
        except (ValueError, zlib.error) as error:
            raise ValueError(f"at byte {at}: {error}") from error


# -- predicates -------------------------------------------------------------------------------------

#: (column, operator, value) on a header field; a field that is missing satisfies only "is null".
Predicate = tuple[str, str, object]

_OPERATORS: dict[str, Callable] = {
    "=": lambda mine, value: mine == value,
    "!=": lambda mine, value: mine != value,
    "<": lambda mine, value: mine < value,
    "<=": lambda mine, value: mine <= value,
    ">": lambda mine, value: mine > value,
    ">=": lambda mine, value: mine >= value,
    "in": lambda mine, value: mine in value,
    "starts with": lambda mine, value: mine.startswith(value),
    "is not null": lambda mine, value: True,
}


def header_test(predicate: Predicate) -> Callable[[Record], bool]:
    """Whether a record's header satisfies a predicate."""
    column, operator, value = predicate
    if column not in FIELDS:
        raise ValueError(f"{column} is not read from the header of a record")
    if operator == "is null":
        return lambda record: record.value(column) is None
    if operator not in _OPERATORS:
        raise ValueError(f"{operator!r} is none of {', '.join([*_OPERATORS, 'is null'])}")
    compare = _OPERATORS[operator]
    return lambda record: (mine := record.value(column)) is not None and compare(mine, value)


# -- the data source --------------------------------------------------------------------------------


@dataclass
class WarcFiles(InputPartition):
    """Files, with their sizes, that one task reads."""

    files: tuple[tuple[str, int], ...]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, partition_bytes: int, where: Sequence[Predicate] = ()) -> None:
        self._path, self._columns, self._partition_bytes, self._where = path, schema.names, partition_bytes, where
        known = dict(zip(_ARROW.names, _ARROW.types, strict=True))
        unknown = [c for c in self._columns if c not in known]
        if unknown:
            raise ValueError(f"a WARC record has no {', '.join(unknown)}")
        self._schema = pa.schema([(c, known[c]) for c in self._columns])
        for predicate in where:
            header_test(predicate)

    def _files(self) -> list[tuple[str, int]]:
        fs, path = _located(self._path)
        info = fs.get_file_info(path)
        if info.type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(self._path)
        if info.is_file:
            return [(path, info.size)]
        manifest = posixpath.join(path, MANIFEST)
        if fs.get_file_info(manifest).is_file:
            with fs.open_input_stream(manifest) as stream:
                return [(posixpath.join(path, name), size) for name, size in json.loads(stream.read())]
        found = fs.get_file_info(arrow_fs.FileSelector(path, recursive=True))
        named = [f for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")) and f.base_name[0] not in "_."]
        return sorted((f.path, f.size) for f in named)

    def partitions(self) -> Sequence[InputPartition]:
        """Files in order, together while they are small."""
        out: list[list[tuple[str, int]]] = []
        held = 0
        for path, size in self._files():
            if not out or held + size > self._partition_bytes:
                out.append([])
                held = 0
            out[-1].append((path, size))
            held += size
        return [WarcFiles(tuple(files)) for files in out] or [WarcFiles(())]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        tests = [header_test(predicate) for predicate in self._where]
        fs, _ = _located(self._path)
        rows: list[list[object]] = []
        held = 0
        for path, size in partition.files:
            with fs.open_input_file(path) as file:
                try:
                    for record in records(file, size, lambda r: all(test(r) for test in tests)):
                        row = [record.value(c) for c in self._columns]
                        rows.append(row)
                        held += sum(len(v) for v in row if isinstance(v, bytes))
                        if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield self._batch(rows)
                            rows, held = [], 0
                except ValueError as error:
                    raise ValueError(f"{path}, {error}") from error
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[list[object]]) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(self._schema)]
        return pa.RecordBatch.from_arrays(columns, schema=self._schema)


_ARROW = pa.schema(
    [(c, pa.int64() if c == "content_length" else pa.string()) for c in FIELDS]
    + [("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


@dataclass
class Written(WriterCommitMessage):
    """Files, with their sizes, that one task wrote."""

    files: tuple[tuple[str, int], ...]


def _header_value(value: object) -> str:
    """On one line: white space and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


def record_bytes(row: dict) -> bytes:
    """The record of a page: an HTTP response, or a revisit with the HTTP header alone."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_header_value(row['record_id'])}>"]
    lines.append(f"WARC-Date: {_header_value(row['date'])}")
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_header_value(row['target_uri'])}")
    lines.append(f"WARC-Payload-Digest: {_header_value(row['payload_digest'])}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_header_value(row['refers_to'])}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return b"".join(["\r\n".join(lines).encode(), _HEAD_END, http, payload, _HEAD_END])


def member(record: bytes, level: int = COMPRESSION_LEVEL) -> bytes:
    """A gzip member that tells its own compressed length, if 32 bits can."""
    deflater = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflater.compress(record) + deflater.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    whole = 24 + len(body) + len(tail)
    if whole >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, whole, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, file_bytes: int, level: int) -> None:
        self._path, self._overwrite, self._file_bytes, self._level = path, overwrite, file_bytes, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _located(self._path)
        fs.create_dir(folder, recursive=True)
        files: list[tuple[str, int]] = []
        out, name, size = None, "", 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    if out is None:
                        name, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(posixpath.join(folder, name), compression=None)
                    written = member(record_bytes(batch.slice(i, 1).to_pylist()[0]), self._level)
                    out.write(written)
                    size += len(written)
                    if size >= self._file_bytes:
                        out.close()
                        files.append((name, size))
                        out = None
            if out is not None:
                out.close()
                files.append((name, size))
                out = None
        finally:
            if out is not None:
                out.close()
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        """Name the files that make up the archive, in one step."""
        fs, folder = _located(self._path)
        fs.create_dir(folder, recursive=True)
        final = posixpath.join(folder, MANIFEST)
        files = [list(f) for message in messages if message is not None for f in message.files]
        if not self._overwrite and fs.get_file_info(final).is_file:
            with fs.open_input_stream(final) as stream:
                files = json.loads(stream.read()) + files
        hidden = f"{final}-{uuid.uuid4().hex}"
        with fs.open_output_stream(hidden, compression=None) as stream:
            stream.write(json.dumps(files).encode())
        fs.move(hidden, final)

    def abort(self, messages: list[Written | None]) -> None:
        """Files of tasks that ended are deleted; they were never part of the archive."""
        fs, folder = _located(self._path)
        for message in messages:
            for name, _ in message.files if message is not None else ():
                fs.delete_file(posixpath.join(folder, name))


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options for reading: partitionBytes, and where, a JSON list of predicates; for writing: fileBytes, level.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: StructType) -> WarcReader:
        where = [tuple(predicate) for predicate in json.loads(self.options.get("where", "[]"))]
        return WarcReader(self.options["path"], schema, int(self.options.get("partitionBytes", PARTITION_BYTES)), where)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        level = int(self.options.get("level", COMPRESSION_LEVEL))
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("fileBytes", FILE_BYTES)), level)


def read_warc(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Sequence[Predicate] = ()
) -> DataFrame:
    """Records of a file or folder that satisfy all predicates; only what ``columns`` names is read of them."""
    spark.dataSource.register(WarcSource)
    types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(RECORDS)}
    schema = ", ".join(f"{c} {types[c]}" for c in (types if columns is None else columns))
    return spark.read.format("warc").schema(schema).option("where", json.dumps(list(where))).load(path)


# -- an archive of pages ----------------------------------------------------------------------------

_ID_PREFIX = "urn:page:"


def _record_id(page_id: str) -> Column:
    return F.concat(F.lit(_ID_PREFIX), F.coalesce(F.col(page_id).cast("string"), F.lit("")))


def _page_id(record_id: str) -> Column:
    return F.expr(f"try_cast(substring({record_id}, {len(_ID_PREFIX) + 1}) as bigint)")


def page_records(
    pages: DataFrame,
    date: dt.datetime | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """What to write of every page: of long enough equal payloads that of the least id is the response.

    The payloads themselves are shuffled once, to meet the one row that says which of their pages is the
    response. Those of a payload that would overfill a task are spread over as many as they need.
    """
    stamp = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("target_uri"), payload.alias("payload")
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    groups = rows.groupBy("digest").agg(
        F.first("payload_bytes").alias("bytes"), F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")
    )
    spark = pages.sparkSession
    folder = fresh_folder(spark, "llm-payloads")
    shared = groups.where((F.col("n") > 1) & (F.col("bytes") >= least_bytes) & F.col("least").isNotNull())
    shared = shared.select("digest", "least", (F.col("n") * F.col("bytes")).alias("total"))
    shared.write.parquet(folder)
    shared = spark.read.schema(shared.schema).parquet(folder)
    everything = shared.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    share = max(hot_bytes, -(-everything // MOST_HOT))
    tasks = F.ceil(F.col("total") / share).cast("long")
    hot = F.broadcast(shared.where(F.col("total") > share).select("digest", tasks.alias("salts")))  # fewer than MOST_HOT
    # a payload too short to be shared meets nothing, so its rows may go anywhere
    spread = F.when(F.col("payload_bytes") < least_bytes, F.xxhash64("page_id")).otherwise(
        F.pmod(F.xxhash64("page_id"), F.coalesce("salts", F.lit(1).cast("long")))
    )
    salted = rows.join(hot, "digest", "left").withColumn("salt", spread).drop("salts")
    sides = shared.select("digest", "least", F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1)).alias("salt"))
    met = salted.join(sides.hint("shuffle_hash"), ["digest", "salt"], "left")
    revisits = F.coalesce((F.col("least") != F.col("page_id")) | (F.col("least").isNotNull() & F.col("page_id").isNull()), F.lit(False))
    return met.withColumn("revisits", revisits).select(
        F.when(F.col("revisits"), "revisit").otherwise("response").alias("record_type"),
        _record_id("page_id").alias("record_id"),
        F.lit(stamp).alias("date"),
        "target_uri",
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(F.col("revisits"), _record_id("least")).alias("refers_to"),
        "payload_bytes",
        F.when(~F.col("revisits"), F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, **options: object) -> None:
    """Write an archive of pages to a folder; ``options`` as for ``page_records``."""
    pages.sparkSession.dataSource.register(WarcSource)
    page_records(pages, **options).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of an archive of pages.

    Responses are decoded, and their digests are those of what was read; one that differs from its header
    raises. Of revisits nothing but headers is read.
    """
    stored = read_warc(
        spark, path, ["record_type", "record_id", "payload_digest", "payload"], [("record_type", "=", "response")]
    ).withColumn("digest", F.sha2("payload", 256))
    message = F.concat(F.lit("payload differs from its digest: "), F.col("record_id"))
    whole = F.col("payload_digest").eqNullSafe(F.concat(F.lit("sha256:"), "digest"))
    responses = stored.select(
        _page_id("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(whole, F.col("digest")).otherwise(F.raise_error(message)).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    headers = ["record_type", "record_id", "payload_digest", "refers_to", "payload_bytes"]
    revisits = read_warc(spark, path, headers, [("record_type", "=", "revisit")]).select(
        _page_id("record_id").alias("page_id"),
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type",
        _page_id("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = fresh_folder(spark, "llm-warc")
    write_pages(pages, path)
    return read_pages(spark, path)
