"""Document collections as dump files of length-prefixed BSON documents, read in splits and written by tasks.

``read_bson`` and ``write_bson`` register the format ``bson_dump`` and use it.  A file is documents one after
another, each with its byte length in front.  Paths are folders or files that driver and executors see: a mounted
folder, or a URI that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import datetime as dt
import json
import struct
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, ShortType, StringType, StructType, TimestampNTZType,
                               TimestampType)

# Executors get these classes by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "bson_dump"
SPLIT_BYTES = 64 << 20
#: A longer document is taken for a broken file.
MAX_DOCUMENT = 48 << 20
READ_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20

# Fixed values of the format: byte sizes of the types that have one, and types that start with a text's size.
SIZES = {0x01: 8, 0x06: 0, 0x07: 12, 0x08: 1, 0x09: 8, 0x0A: 0, 0x10: 4, 0x11: 8, 0x12: 8, 0x13: 16, 0x7F: 0, 0xFF: 0}
TEXTS = {0x02, 0x0D, 0x0E}
DOCUMENT, ARRAY, BINARY, REGEX, POINTER, SCOPED = 0x03, 0x04, 0x05, 0x0B, 0x0C, 0x0F

INT, LONG, DOUBLE = "<i", "<q", "<d"
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Broken(ValueError):
    """Bytes that are no document."""


class Short(Broken):
    """Bytes that end inside what may be a document."""


# --------------------------------------------------------------------------- bytes of documents

def _int(data: bytes, at: int, end: int) -> int:
    if at + 4 > end:
        raise Short
    return struct.unpack_from(INT, data, at)[0]


def _name_end(data: bytes, at: int, end: int) -> int:
    """Where the zero byte of a name is."""
    found = data.find(b"\0", at, end)
    if found < 0:
        raise Short
    return found


def value_end(data: bytes, kind: int, at: int, end: int, deep: bool = False) -> int:
    """Where a value ends; ``deep`` walks nested documents too."""
    if kind in SIZES:
        stop = at + SIZES[kind]
    elif kind in TEXTS or kind == POINTER:
        size = _int(data, at, end)
        if size < 1:
            raise Broken
        stop = at + 4 + size
        if stop <= end and data[stop - 1]:
            raise Broken
        stop += 12 if kind == POINTER else 0
    elif kind in (DOCUMENT, ARRAY):
        if deep:
            return document_end(data, at, end)
        stop = at + max(_int(data, at, end), 5)
    elif kind == BINARY:
        size = _int(data, at, end)
        if size < 0:
            raise Broken
        stop = at + 5 + size
    elif kind == REGEX:
        stop = _name_end(data, _name_end(data, at, end) + 1, end) + 1
    elif kind == SCOPED:
        stop = at + max(_int(data, at, end), 14)
    else:
        raise Broken
    if stop > end:
        raise Short
    return stop


def document_end(data: bytes, at: int, end: int) -> int:
    """Where the document at ``at`` ends, if every element down to the innermost fits its place."""
    size = _int(data, at, end)
    if not 5 <= size <= MAX_DOCUMENT:
        raise Broken
    whole = at + size <= end
    last, at = at + size - 1, at + 4
    limit = min(last, end)
    try:
        while at < limit:
            kind = data[at]
            if not kind:
                raise Broken
            at = value_end(data, kind, _name_end(data, at + 1, limit) + 1, limit, deep=True)
    except Short:
        raise Broken if whole else Short from None
    if not whole:
        raise Short
    if at != last or data[last]:
        raise Broken
    return last + 1


def elements(data: bytes, at: int):
    """(name, kind, start, end) of each element of a document."""
    last = at + struct.unpack_from(INT, data, at)[0] - 1
    at += 4
    while at < last:
        kind, zero = data[at], _name_end(data, at + 1, last)
        stop = value_end(data, kind, zero + 1, last)
        yield data[at + 1:zero].decode("utf-8", "replace"), kind, zero + 1, stop
        at = stop


def decoded(data: bytes, kind: int, at: int, stop: int):
    """A value as Python has it; kinds without a counterpart as hexadecimal text of their bytes."""
    if kind == 0x01:
        return struct.unpack_from(DOUBLE, data, at)[0]
    if kind in TEXTS:
        return data[at + 4:stop - 1].decode("utf-8", "replace")
    if kind == DOCUMENT:
        return {n: decoded(data, k, a, b) for n, k, a, b in elements(data, at)}
    if kind == ARRAY:
        return [decoded(data, k, a, b) for _, k, a, b in elements(data, at)]
    if kind == BINARY:
        return data[at + 5:stop]
    if kind == 0x08:
        return bool(data[at])
    if kind == 0x09:
        return Instant(struct.unpack_from(LONG, data, at)[0])
    if kind == 0x10:
        return struct.unpack_from(INT, data, at)[0]
    if kind in (0x11, 0x12):
        return struct.unpack_from(LONG, data, at)[0]
    if kind in (0x06, 0x0A, 0x7F, 0xFF):
        return None
    return data[at:stop].hex()


class Instant(int):
    """Milliseconds since 1970 (UTC)."""


def _text(value):
    if isinstance(value, str):
        return value
    if isinstance(value, Instant):
        try:
            return (EPOCH + dt.timedelta(milliseconds=value)).isoformat()
        except OverflowError:
            return str(int(value))
    return value.hex() if isinstance(value, bytes) else json.dumps(value, ensure_ascii=False, default=str)


def _number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, (bool, Instant))


def _whole(bits: int):
    least, most = -(1 << bits - 1), (1 << bits - 1) - 1

    def fit(value):
        if type(value) is int:
            return value if least <= value <= most else None
        return int(value) if type(value) is float and value.is_integer() and least <= value <= most else None
    return fit


def fitter(wanted: DataType):
    """A function that gives a value, null excepted, as Arrow takes it for a Spark type; null where it doesn't fit."""
    if isinstance(wanted, StringType):
        return _text
    if isinstance(wanted, BooleanType):
        return lambda v: v if isinstance(v, bool) else None
    if isinstance(wanted, (TimestampType, TimestampNTZType)):
        return lambda v: v * 1000 if isinstance(v, Instant) and abs(v) < 1 << 53 else None
    if isinstance(wanted, DateType):
        return lambda v: v // 86_400_000 if isinstance(v, Instant) and abs(v) < 1 << 53 else None
    if isinstance(wanted, (DoubleType, FloatType)):
        return lambda v: float(v) if _number(v) else None
    bits = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64}.get(type(wanted))
    if bits:
        return _whole(bits)
    if isinstance(wanted, BinaryType):
        return lambda v: v if isinstance(v, bytes) else None
    if isinstance(wanted, ArrayType):
        item = fitter(wanted.elementType)
        return lambda v: [None if x is None else item(x) for x in v] if isinstance(v, list) else None
    if isinstance(wanted, MapType):
        item = fitter(wanted.valueType)
        return lambda v: [(k, None if x is None else item(x)) for k, x in v.items()] if isinstance(v, dict) else None
    if isinstance(wanted, StructType):
        inner = [(f.name, fitter(f.dataType)) for f in wanted]
        return lambda v: ({n: None if v.get(n) is None else fit(v[n]) for n, fit in inner}
                          if isinstance(v, dict) else None)
    raise ValueError(f"{FORMAT} has no {wanted.simpleString()}")


def _millis(value) -> int:
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return ((value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)) - EPOCH) // dt.timedelta(milliseconds=1)


def encoder(wanted: DataType):
    """(kind, function from a value, null excepted, to its bytes) for a Spark type."""
    if isinstance(wanted, StringType):
        def text(value):
            data = value.encode()
            return struct.pack(INT, len(data) + 1) + data + b"\0"
        return b"\x02", text
    if isinstance(wanted, BooleanType):
        return b"\x08", lambda v: b"\1" if v else b"\0"
    if isinstance(wanted, (ByteType, ShortType, IntegerType)):
        return b"\x10", struct.Struct(INT).pack
    if isinstance(wanted, LongType):
        return b"\x12", struct.Struct(LONG).pack
    if isinstance(wanted, (DoubleType, FloatType)):
        return b"\x01", struct.Struct(DOUBLE).pack
    if isinstance(wanted, BinaryType):
        return b"\x05", lambda v: struct.pack(INT, len(v)) + b"\0" + v
    if isinstance(wanted, (TimestampType, TimestampNTZType, DateType)):
        return b"\x09", lambda v: struct.pack(LONG, _millis(v))
    if isinstance(wanted, ArrayType):
        kind, pack = encoder(wanted.elementType)
        return b"\x04", lambda v: _framed([_element(kind, pack, b"%d\0" % i, x) for i, x in enumerate(v)])
    if isinstance(wanted, MapType):
        kind, pack = encoder(wanted.valueType)
        return b"\x03", lambda v: _framed([_element(kind, pack, k.encode() + b"\0", x) for k, x in v])
    if isinstance(wanted, StructType):
        fields = [(f.name, f.name.encode() + b"\0", *encoder(f.dataType)) for f in wanted]
        return b"\x03", lambda v: _framed([_element(kind, pack, key, v[name]) for name, key, kind, pack in fields])
    raise ValueError(f"{FORMAT} has no {wanted.simpleString()}")


def _element(kind: bytes, pack, key: bytes, value) -> bytes:
    return b"\x0a" + key if value is None else kind + key + pack(value)


def _framed(parts: list[bytes]) -> bytes:
    body = b"".join(parts)
    return struct.pack(INT, len(body) + 5) + body + b"\0"


def record(schema: StructType):
    """A function from a row as a dictionary to its document."""
    return encoder(schema)[1]


# --------------------------------------------------------------------------- files

def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def dump_files(path: str) -> list[pafs.FileInfo]:
    """The files of a collection: not hidden, not empty, by name."""
    files, inner = opened(path)
    found = files.get_file_info(inner)
    if found.type == pafs.FileType.File:
        return [found]
    if found.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    inside = files.get_file_info(pafs.FileSelector(inner))
    return sorted((f for f in inside if f.type == pafs.FileType.File and f.size and f.base_name[0] not in "._"),
                  key=lambda f: f.path)


class Bytes:
    """A window that moves over a file; offsets are the file's."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.low, self.data = handle, size, 0, b""

    def window(self, at: int, n: int) -> tuple[bytes, int]:
        """Bytes that hold ``n`` from ``at`` on, or all up to the file's end, and where ``at`` is in them."""
        stop = min(at + n, self.size)
        if at < self.low or stop > self.low + len(self.data):
            kept = self.data[at - self.low:] if self.low <= at <= self.low + len(self.data) else b""
            self.handle.seek(at + len(kept))
            self.low, self.data = at, kept + self.handle.read(max(stop - at - len(kept), READ_BYTES))
        return self.data, at - self.low

    def length(self, at: int) -> int | None:
        """The length that a document at ``at`` states, None if none can."""
        data, here = self.window(at, 4)
        size = struct.unpack_from(INT, data, here)[0] if here + 4 <= len(data) else 0
        return size if 5 <= size <= MAX_DOCUMENT else None

    def end_of(self, at: int) -> int:
        """Where the document at ``at`` ends, walking all of it."""
        if at + 4 > self.size:
            raise Short
        size = self.length(at)
        if size is None:
            raise Broken
        data, here = self.window(at, size)
        return at + document_end(data, here, min(here + size, len(data))) - here


def next_document(file: Bytes, at: int) -> int:
    """The first offset from ``at`` on where a whole document is followed by another one, by the file's end or by a
    document that the file's end cuts off; the file's size if there is none."""
    while at + 5 <= file.size:
        data, here = file.window(at, READ_BYTES)
        if len(data) - here < 5:
            break
        for i in range(here, len(data) - 4):
            size = struct.unpack_from(INT, data, i)[0]
            if not 5 <= size <= file.size - (at + i - here) or size > MAX_DOCUMENT or (i + size <= len(data) and data[i + size - 1]):
                continue
            start = at + i - here
            try:
                stop = file.end_of(start)
            except Broken:
                continue
            try:
                if stop < file.size:
                    file.end_of(stop)
            except Short:
                if file.size - stop < 5:  # the end of an outer document as well may be
                    continue
            except Broken:
                continue
            return start
        at += len(data) - 4 - here
    return file.size


def split_documents(file: Bytes, path: str, start: int, stop: int, skip_torn: bool):
    """(bytes, place) of each document that starts in [start, stop).

    A later split finds its first document by its shape.  Each split also looks where the one after it will begin,
    and raises if that isn't where its own last document ends: so either all splits of a file fit together, from
    its first byte on, or the read fails.
    """
    at = next_document(file, start) if start else 0
    while at < file.size:
        size = file.length(at)
        if size is None and at + 4 <= file.size:
            raise ValueError(f"{path}: no document at byte {at}")
        if size is None or at + size > file.size:
            if not skip_torn:
                raise ValueError(f"{path}: torn document at byte {at}")
            at = file.size
        if at >= stop:
            break
        yield file.window(at, size)
        at += size
    if stop < file.size and next_document(file, stop) != at:
        raise ValueError(f"{path}: the borders at byte {stop} are unclear; read it with a larger splitBytes")


# --------------------------------------------------------------------------- the source

@dataclass
class Split(InputPartition):
    path: str
    size: int
    start: int
    stop: int


class BsonReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.wanted, self.path = schema, options["path"]
        self.step = int(options.get("splitbytes", SPLIT_BYTES))
        self.skip_torn = options.get("torn", "error") == "skip"

    def partitions(self):
        """Byte ranges of the files: from their sizes alone, nothing is read here."""
        return [Split(f.path, f.size, a, min(a + self.step, f.size))
                for f in dump_files(self.path) for a in range(0, f.size, self.step)] or [Split("", 0, 0, 0)]

    def read(self, split: Split):
        if not split.size:
            return
        schema = to_arrow_schema(self.wanted)
        fit = {f.name: fitter(f.dataType) for f in self.wanted}
        files, _ = opened(self.path)
        with files.open_input_file(split.path) as handle:
            rows, held = [], 0
            for data, here in split_documents(Bytes(handle, split.size), split.path, split.start, split.stop, self.skip_torn):
                row = dict.fromkeys(fit)
                for name, kind, at, stop in elements(data, here):
                    if name in fit:  # other fields are stepped over
                        value = decoded(data, kind, at, stop)
                        row[name] = None if value is None else fit[name](value)
                        held += stop - at
                rows.append(row)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class BsonWriter(DataSourceArrowWriter):
    """Each task writes a hidden file; the commit shows those of the tasks that Spark took, and no others."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.fields, self.path, self.overwrite = schema, options["path"], overwrite

    def write(self, iterator):
        files, inner = opened(self.path)
        files.create_dir(inner, recursive=True)
        bytes_of = record(self.fields)
        name, handle = f"part-{uuid.uuid4().hex}.bson", None
        for batch in iterator:
            if handle is None and batch.num_rows:
                handle = files.open_output_stream(f"{inner}/_{name}")
            for row in batch.to_pylist():
                handle.write(bytes_of(row))
        if handle is None:
            return Written(None)
        handle.close()
        return Written(name)

    def commit(self, messages):
        files, inner = opened(self.path)
        files.create_dir(inner, recursive=True)
        old = dump_files(self.path) if self.overwrite else []
        for m in messages:
            if m is not None and m.name:
                files.move(f"{inner}/_{m.name}", f"{inner}/{m.name}")
        for f in old:
            files.delete_file(f.path)

    def abort(self, messages):
        """The hidden files stay; no reader looks at them."""


class BsonDump(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        raise ValueError(f"{FORMAT} needs a schema: the fields to read")

    def reader(self, schema):
        return BsonReader(schema, self.options)

    def writer(self, schema, overwrite):
        return BsonWriter(schema, self.options, overwrite)


def read_bson(spark: SparkSession, path: str, schema: StructType | str, split_bytes: int = SPLIT_BYTES,
              torn: str = "error") -> DataFrame:
    """The documents of a dump file, or of a folder of them.

    ``schema`` names the top-level fields to read; others are stepped over without being decoded.  A field that is
    missing, or whose value doesn't fit its type, is null; any value fits a string (documents and arrays as JSON text).
    Files are read in splits of ``split_bytes``.  A document cut off by its file's end is an error, or left out with
    ``torn="skip"``.
    """
    if torn not in ("error", "skip"):
        raise ValueError("torn must be 'error' or 'skip'")
    spark.dataSource.register(BsonDump)
    return spark.read.format(FORMAT).schema(schema).option("splitBytes", split_bytes).option("torn", torn).load(path)


def write_bson(df: DataFrame, path: str, mode: str = "append") -> None:
    """One dump file for each task that has rows; times are kept to the millisecond.

    ``mode="overwrite"`` removes the earlier files once the new ones are in place.
    """
    df.sparkSession.dataSource.register(BsonDump)
    df.write.format(FORMAT).mode(mode).save(path)
