"""WARC archives as a Python data source, and pages archived with revisit records.

Reading is planned by file: listed archives, or those that a manifest names, are dealt into partitions of
about ``partition_bytes``. Predicates on the record type and on header fields are handed down to the reader, which
parses a record's header first and seeks past the block of any record that they exclude, or whose payload
nobody asked for. They are part of the relation (``where``): Spark 4.1 can push filters into a Python source by
itself, but keeps the first plan of a relation for scans without filters and for a second scan in one query,
which then lack rows. So it is only let do so where the option ``pushdown`` asks for it. Compressed archives hold one gzip member per record; members written here carry their
length, so that an unwanted one is passed over without being inflated.

Writing is safe against lost tasks: each attempt writes files of its own, and only a manifest, moved into place
when the job commits, makes them part of the archive.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clicklake.llm.common import ship
from clicklake.session import stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RESPONSE = "application/http;msgtype=response"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

#: Predicates of ``where``; those with a leading "not " are negated.
PREDICATES = {
    "=": ds.EqualTo, "in": ds.In, "<": ds.LessThan, "<=": ds.LessThanOrEqual, ">": ds.GreaterThan, ">=": ds.GreaterThanOrEqual,
    "starts": ds.StringStartsWith, "ends": ds.StringEndsWith, "contains": ds.StringContains, "null": ds.IsNull,
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, content_type string, content_length long, "
    "payload_digest string, refers_to string, headers map<string,string>, payload binary, file string, offset long"
)
#: Columns that are no header field.
_PLACES = ("file", "offset", "headers", "payload")
_MAX_HEADER = 1 << 20
_FLUSH_ROWS, _FLUSH_BYTES = 1_000, 8 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; any store that Arrow knows."""
    return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


def field_of(column: str) -> str:
    """Header field of a column, in lower case: ``x_page_id`` is ``x-page-id``, the WARC fields lose their prefix."""
    name = column.lower().replace("_", "-")
    if name == "record-type":
        return "warc-type"
    return name if name.startswith(("content-", "x-", "warc-")) else f"warc-{name}"


# --- Reading -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Files(ds.InputPartition):
    paths: tuple[str, ...]


class _Plain:
    """Records of an uncompressed archive. ``next_header`` and then one of ``block`` and ``skip``."""

    def __init__(self, file):
        self.file = file

    def next_header(self) -> tuple[int, dict[str, str]] | None:
        at, line = self.file.tell(), self.file.readline()
        while line in (b"\r\n", b"\n"):
            at, line = self.file.tell(), self.file.readline()
        if not line:
            return None
        lines = [line]
        while line not in (b"\r\n", b"\n"):
            line = self.file.readline()
            lines.append(line)
            if not line or sum(map(len, lines)) > _MAX_HEADER:
                raise ValueError(f"broken header at byte {at}")
        fields = parse_header(b"".join(lines), at)
        self.length = int(fields["content-length"])
        return at, fields

    def block(self) -> bytes:
        data = self.file.read(self.length)
        if len(data) < self.length:
            raise ValueError("a record ends before its block does")
        return data

    def skip(self) -> None:
        self.file.seek(self.length, io.SEEK_CUR)


class _Gzip:
    """Records of an archive with one gzip member each. A member's stated length saves inflating it to its end."""

    def __init__(self, file):
        self.file = file
        self.at = 0

    def next_header(self) -> tuple[int, dict[str, str]] | None:
        self.file.seek(self.at)
        head = self.file.read(12)
        if not head:
            return None
        if head[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {self.at}")
        self.size = None
        if head[3] & 4:
            extra = self.file.read(struct.unpack("<H", head[10:12])[0])
            while len(extra) >= 4:
                tag, n = extra[:2], struct.unpack("<H", extra[2:4])[0]
                if tag == b"sl" and n == 8:
                    self.size = struct.unpack("<I", extra[4:8])[0] or None
                extra = extra[4 + n :]
        self.file.seek(self.at)
        self.inflate, self.data, self.read = zlib.decompressobj(31), b"", 0
        while (end := self.data.find(b"\r\n\r\n")) < 0:
            if len(self.data) > _MAX_HEADER or not self._more():
                raise ValueError(f"broken header at byte {self.at}")
        fields = parse_header(self.data[: end + 4], self.at)
        self.data, self.length = self.data[end + 4 :], int(fields["content-length"])
        return self.at, fields

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        chunk = self.file.read(4096 if not self.read else 1 << 16)
        self.read += len(chunk)
        self.data += self.inflate.decompress(chunk)
        return bool(chunk)

    def _end(self) -> None:
        while not self.inflate.eof:
            self.data = b""
            if not self._more():
                raise ValueError(f"the member at byte {self.at} has no end")
        self.at += self.read - len(self.inflate.unused_data)

    def block(self) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < self.length:
            self.data = b""
            if not self._more():
                raise ValueError("a record ends before its block does")
            parts.append(self.data)
            have += len(self.data)
        self._end()
        return b"".join(parts)[: self.length]

    def skip(self) -> None:
        if self.size is None:
            self._end()
        else:
            self.at += self.size


def parse_header(data: bytes, at: int = 0) -> dict[str, str]:
    """Fields by name in lower case; folded lines are joined, of a repeated field the first counts."""
    first, *lines = data.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    fields, name = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            key, value = line.split(":", 1)
            name = key.strip().lower()
            if name in fields:
                name = None
            else:
                fields[name] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError(f"no length of the record at byte {at}")
    return fields


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP header of a record that holds an HTTP message; else the whole block."""
    if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        _, _, block = block.partition(b"\r\n\r\n")
    return block


def _predicate(found: ds.Filter) -> Callable[[Callable], bool | None] | None:
    """A pushed filter as a function of a column getter, in three-valued logic; None if it cannot be pushed."""
    if isinstance(found, ds.Not):
        inner = _predicate(found.child)
        return None if inner is None else lambda get: None if (x := inner(get)) is None else not x
    column = found.attribute
    if len(column) != 1 or column[0].lower() in ("headers", "payload"):
        return None
    name = column[0]
    if isinstance(found, ds.IsNull):
        return lambda get: get(name) is None
    if isinstance(found, ds.IsNotNull):
        return lambda get: get(name) is not None
    wanted = found.value
    if isinstance(found, ds.EqualNullSafe):
        return lambda get: get(name) == wanted
    tests = {
        ds.EqualTo: lambda x: x == wanted, ds.In: lambda x: x in wanted,
        ds.GreaterThan: lambda x: x > wanted, ds.GreaterThanOrEqual: lambda x: x >= wanted,
        ds.LessThan: lambda x: x < wanted, ds.LessThanOrEqual: lambda x: x <= wanted,
        ds.StringStartsWith: lambda x: x.startswith(wanted), ds.StringEndsWith: lambda x: x.endswith(wanted),
        ds.StringContains: lambda x: wanted in x,
    }
    test = tests.get(type(found))
    # Text is ordered by code point, which is how Spark orders its bytes.
    return None if test is None else lambda get: None if (x := get(name)) is None else test(x)


def filter_of(column: str, test: str, value: object = None) -> ds.Filter:
    """Filter of a column that is no payload: ``("record_type", "=", "response")``, ``("x_n", "not in", [1, 2])``."""
    kind = PREDICATES[test.removeprefix("not ")]
    found = kind((column,)) if kind is ds.IsNull else kind((column,), tuple(value) if kind is ds.In else value)
    if _predicate(found) is None:
        raise ValueError(f"no predicate on {column} can be handed down")
    return ds.Not(found) if test.startswith("not ") else found


class Reader(ds.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.path, self.schema = options["path"], schema
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.filters = [filter_of(*x) for x in json.loads(options.get("where", "[]"))]
        self.whole = {f.name: f.dataType for f in schema if isinstance(f.dataType, (T.LongType, T.IntegerType))}
        for field in schema:
            kinds = {"payload": T.BinaryType, "headers": T.MapType}.get(field.name, (T.StringType, T.LongType, T.IntegerType))
            if not isinstance(field.dataType, kinds):
                raise TypeError(f"column {field.name} cannot be a {field.dataType.simpleString()}")

    def partitions(self) -> list[Files]:
        """Files in partitions of about ``partition_bytes``; one file is never cut, as records have no marks."""
        about_files = [f for f in self.filters if getattr(f, "attribute", None) == ("file",)]
        tests = [_predicate(f) for f in about_files]
        parts, paths, held = [], [], 0
        for path, size in archive_files(self.path):
            if not all(test(lambda _, p=path: p) for test in tests):
                continue
            if paths and held + size > self.partition_bytes:
                parts.append(Files(tuple(paths)))
                paths, held = [], 0
            paths.append(path)
            held += size
        return [*parts, Files(tuple(paths))] if paths else parts or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        kinds, names = to_arrow_schema(self.schema), [f.name for f in self.schema]
        tests = [_predicate(f) for f in self.filters]
        want_payload, rows, held = "payload" in names, [], 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in rows], kinds.field(k).type) for k in range(len(names))]
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for path in partition.paths:
            with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 16) as file:
                records = _Gzip(file) if path.endswith(".gz") else _Plain(file)
                while (found := records.next_header()) is not None:
                    at, fields = found

                    def get(column: str, at=at, fields=fields, path=path):
                        if column in _PLACES:
                            return {"file": path, "offset": at, "headers": list(fields.items())}.get(column)
                        value = fields.get(field_of(column))
                        if column in self.whole:
                            return int(value) if value is not None and re.fullmatch("[+-]?[0-9]{1,18}", value) else None
                        return value

                    if not all(test(get) for test in tests):
                        records.skip()
                        continue
                    row = [get(c) for c in names]
                    if want_payload:
                        row[names.index("payload")] = payload_of(fields, records.block())
                        held += len(row[names.index("payload")])
                    else:
                        records.skip()
                    rows.append(row)
                    if len(rows) >= _FLUSH_ROWS or held >= _FLUSH_BYTES:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()


class PushingReader(Reader):
    """A reader that also takes the filters of the query. It needs the session's setting for it."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for found in filters:
            if _predicate(found) is None:
                yield found
            else:
                self.filters.append(found)


def archive_files(uri: str) -> list[tuple[str, int]]:
    """Path and size of the archives below a folder: what its manifests name, or all if it has none."""
    store, root = _open(uri)
    found = store.get_file_info(pafs.FileSelector(root, recursive=True))
    manifests = sorted(f.path for f in found if f.base_name.startswith("_manifest-"))
    if not manifests:
        named = (f for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.base_name))
        return sorted((f.path, f.size) for f in named)
    out = []
    for path in manifests:
        with store.open_input_stream(path) as file:
            for line in file.read().decode().splitlines():
                size, name = line.split("\t", 1)
                out.append((f"{root}/{name}", int(size)))
    return sorted(out)


# --- Writing -------------------------------------------------------------------------------------


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[tuple[str, int]]


def header(fields: list[tuple[str, object]], length: int) -> bytes:
    """A record's header. Line breaks in values are percent-encoded, as a header has no place for them."""
    shown = [
        f"{name}: {re.sub('[\r\n]', lambda m: f'%{ord(m[0]):02X}', str(value))}" for name, value in fields if value is not None
    ]
    return b"\r\n".join([VERSION, *(x.encode("utf-8", "replace") for x in shown), b"Content-Length: %d" % length, b"", b""])


def gzip_member(data: bytes) -> bytes:
    """One gzip member that states its own length and that of its content in an extra field."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    lengths = struct.pack("<II", size, len(data)) if max(size, len(data)) < 1 << 32 else bytes(8)
    start = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8)
    return start + lengths + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict[str, object], date: str) -> bytes:
    """One record of a row with columns as in ``SCHEMA``; further columns are header fields."""
    kind, payload = row["record_type"], row.get("payload") or b""
    known = {"record_type", "payload", "record_id", "date", "content_type", "content_length", *_PLACES}
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", row.get("date") or date), ("WARC-Profile", PROFILE if kind == "revisit" else None),
    ]
    fields += [("-".join(p if p == "URI" else p.upper() if p in ("warc", "uri", "id", "ip") else p.capitalize() for p in field_of(c).split("-")), v)
               for c, v in row.items() if c not in known]
    content, block = row.get("content_type"), payload
    if kind == "response":
        content, block = _RESPONSE, _HTTP % len(payload) + payload
    elif kind == "revisit":
        block = b""
    fields.append(("Content-Type", content or ("application/octet-stream" if block else None)))
    return header(fields, len(block)) + block + b"\r\n\r\n"


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.compressed = options.get("compression", "none").lower() == "gzip"
        self.file_bytes = int(options.get("file_bytes", 1 << 30))
        self.date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        # A name of its own for each attempt: what a lost one leaves is in no manifest.
        name, files, out, size = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", [], None, 0

        def put(data: bytes) -> None:
            nonlocal size
            data = gzip_member(data) if self.compressed else data
            out.write(data)
            size += len(data)

        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is not None and size >= self.file_bytes:
                        out.close()
                        files[-1] = (files[-1][0], size)
                        out = None
                    if out is None:
                        files.append((f"{name}-{len(files)}.warc{'.gz' if self.compressed else ''}", 0))
                        out, size = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                        about = {"record_type": "warcinfo", "content_type": "application/warc-fields", "payload": b"format: WARC File Format 1.1\r\n"}
                        put(record(about, self.date))
                    put(record(row, self.date))
        finally:
            if out is not None:
                out.close()
                files[-1] = (files[-1][0], size)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        old = [f.path for f in store.get_file_info(pafs.FileSelector(root)) if f.is_file and f.base_name.startswith("_manifest-")]
        replaced = archive_files(self.path) if self.overwrite and old else []
        name = f"manifest-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{root}/_new-{name}") as file:
            file.write("".join(f"{size}\t{path}\n" for m in messages if m for path, size in m.files).encode())
        store.move(f"{root}/_new-{name}", f"{root}/_{name}")
        if self.overwrite:
            for path in [*old, *(p for p, _ in replaced)]:
                store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        for path in (p for m in messages if m for p, _ in m.files):
            if store.get_file_info(f"{root}/{path}").is_file:
                store.delete_file(f"{root}/{path}")


class WarcSource(ds.DataSource):
    """``warc`` format. Reading: ``path``, ``partition_bytes``, ``where`` (JSON), ``pushdown``. Writing: ``path``,
    ``compression`` (none, gzip), ``file_bytes``.

    A schema given to the reader chooses columns: those of ``SCHEMA``, and header fields by name, as text or
    whole numbers. Without ``payload`` no block is read at all.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> Reader:
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return (PushingReader if pushing else Reader)(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session. Of several sessions of one application, only one can have it."""
    ship(spark)
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, path: str, schema: str = SCHEMA, where: Sequence[tuple] = (), **options: str) -> DataFrame:
    """Records of the archives below ``path`` for which all of ``where`` hold; see ``filter_of`` and ``WarcSource``."""
    register(spark)
    for test in where:
        filter_of(*test)
    return spark.read.format("warc").options(where=json.dumps(list(where)), **options).schema(schema).load(path)


def write(records: DataFrame, path: str, compression: str = "none", overwrite: bool = False) -> None:
    """Records (columns as in ``SCHEMA``, further ones become header fields) into archives below ``path``."""
    register(records.sparkSession)
    out = records.write.format("warc").option("compression", compression)
    out.mode("overwrite" if overwrite else "append").save(path)


# --- Pages ---------------------------------------------------------------------------------------


def page_records(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Records of pages (``page_id, url, html``): a response each, or a revisit of the page that had the payload first.

    Of pages with equal payloads of ``least_bytes`` at least, the one with the smallest id is the response. Rows
    that repeat that id and payload are responses too; null ids come last, and where a payload has none but
    null ids, all are responses. A null html is an empty payload, a null url leaves the field out. Payloads are
    compared by length and SHA-256. Only payloads found twice are kept aside, and Spark sends them to all tasks
    where they are few, so that pages need not be shuffled.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("x_page_id"), F.col("url").cast("string").alias("target_uri"), body.alias("payload")
    ).withColumns({"payload_digest": F.sha2("payload", 256), "x_payload_length": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("x_payload_length") >= least_bytes).groupBy("payload_digest", "x_payload_length")
    repeated = large.agg(F.count(F.lit(1)).alias("n"), F.min("x_page_id").alias("first_id")).where("n > 1 AND first_id IS NOT NULL")
    repeated = stored(repeated.drop("n"), "warc-repeated")
    joined = rows.join(repeated, ["payload_digest", "x_payload_length"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("x_page_id").eqNullSafe(F.col("first_id"))

    def record_id(page):
        name = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("")), F.col("payload_digest")).cast("binary"))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("x_page_id")).alias("record_id"),
        "target_uri",
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"),
        F.when(again, record_id(F.col("first_id"))).alias("refers_to"),
        "x_page_id", "x_payload_length",
        F.when(again, F.col("first_id")).alias("x_refers_to_page_id"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page, read back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Size and digest of a response come from the payload in the archive, those of a revisit from its header, and
    no block is read for it.
    """
    bodies = read(spark, path, "x_page_id long, record_type string, payload binary", [("record_type", "=", "response")])
    bodies = bodies.select(
        F.col("x_page_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    fields = "x_page_id long, record_type string, payload_digest string, x_payload_length long, x_refers_to_page_id long"
    again = read(spark, path, fields, [("record_type", "=", "revisit")]).select(
        F.col("x_page_id").alias("page_id"), F.col("x_payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", F.col("x_refers_to_page_id").alias("refers_to"),
    )
    return bodies.unionByName(again)
