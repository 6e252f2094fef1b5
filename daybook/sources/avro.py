"""A Spark data source for Avro container files, such as a table's manifests.

``spark.read.format("avro_blocks").load(path)`` reads container files block by
block, one task per file, so a task holds one block and its rows. The schema is
given by the caller or taken from the first file; every file's own schema is
resolved against it: fields are matched by name, numbers are widened, fields
that only the file has are passed over, and fields that it lacks are null.
``df.write.format("avro_blocks").mode("append").save(path)`` writes one file per
task; a file gets its visible name when the job commits.

Types: null, boolean, int, long, float, double, bytes, string, enum, fixed,
arrays, maps and records; unions of null with one other type; the logical types
date, timestamp-millis, timestamp-micros, decimal and uuid. Codecs: null,
deflate, zstandard, bzip2, xz.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import struct
import sys
import uuid
from decimal import Decimal

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from daybook.sources import listing
from daybook.sources.listing import open_location

MAGIC = b"Obj\x01"
#: Rows of a written block.
BLOCK_ROWS = 4096
_DAY0 = _dt.date(1970, 1, 1)
_TIME0 = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(listing)


# --- values ---------------------------------------------------------------------

class Cursor:
    """A position in the bytes of one block."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        """A zig-zag variable-length integer."""
        value = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def blob(self) -> bytes:
        return self.take(self.long())


def put_long(value: int) -> bytes:
    value, out = (value << 1) ^ (value >> 63), bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _blocks(c: Cursor):
    """Item counts of the blocks of an array or map; a negative count is followed by the block's bytes."""
    while n := c.long():
        if n < 0:
            n = -n
            c.long()
        yield n


def _logical(schema: dict, read):
    """``read`` with the logical type of its schema applied."""
    kind = schema.get("logicalType") if isinstance(schema, dict) else None
    if kind == "date":
        return lambda c: _DAY0 + _dt.timedelta(days=read(c))
    if kind in ("timestamp-micros", "timestamp-millis"):
        unit = 1 if kind == "timestamp-micros" else 1000
        return lambda c: _TIME0 + _dt.timedelta(microseconds=read(c) * unit)
    if kind == "decimal":
        return lambda c: Decimal(int.from_bytes(read(c), "big", signed=True)).scaleb(-schema.get("scale", 0))
    return read


_PLAIN = {
    "null": lambda c: None,
    "boolean": lambda c: c.take(1) == b"\x01",
    "int": Cursor.long,
    "long": Cursor.long,
    "float": lambda c: struct.unpack("<f", c.take(4))[0],
    "double": lambda c: struct.unpack("<d", c.take(8))[0],
    "bytes": Cursor.blob,
    "string": lambda c: c.blob().decode(),
}


def decoder(schema, want: T.DataType | None, names: dict):
    """A function that reads a value of ``schema`` as ``want``; with None it only passes over it."""
    if isinstance(schema, str) and schema in names:
        schema = names[schema]
    if isinstance(schema, list):
        inner = [decoder(s, want, names) for s in schema]
        return lambda c: inner[c.long()](c)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return decoder(kind, want, names)
    if kind in ("record", "enum", "fixed"):
        names[schema["name"]] = names[f"{schema.get('namespace', '')}.{schema['name']}"] = schema
    if kind == "record":
        if want is not None and not isinstance(want, T.StructType):
            raise TypeError(f"record {schema['name']} cannot be read as {want.simpleString()}")
        wanted = {f.name: f.dataType for f in want.fields} if want is not None else {}
        fields = [(f["name"], f["name"] in wanted, decoder(f["type"], wanted.get(f["name"]), names)) for f in schema["fields"]]
        absent = dict.fromkeys(wanted)

        def record(c: Cursor):
            out = dict(absent)
            for name, kept, read in fields:
                value = read(c)
                if kept:
                    out[name] = value
            return out

        return record
    if kind == "array":
        item = decoder(schema["items"], want.elementType if isinstance(want, T.ArrayType) else None, names)
        return lambda c: [item(c) for n in _blocks(c) for _ in range(n)]
    if kind == "map":
        value = decoder(schema["values"], want.valueType if isinstance(want, T.MapType) else None, names)
        return lambda c: [(c.blob().decode(), value(c)) for n in _blocks(c) for _ in range(n)]
    if kind == "enum":
        return lambda c: schema["symbols"][c.long()]
    read = (lambda c: c.take(schema["size"])) if kind == "fixed" else _PLAIN[kind]
    read = _logical(schema, read)
    if isinstance(want, (T.FloatType, T.DoubleType)) and kind in ("int", "long"):
        return lambda c: float(read(c))
    if isinstance(want, T.StringType) and kind == "bytes":
        return lambda c: read(c).decode()
    return read


def spark_type(schema, names: dict) -> T.DataType:
    """The Spark type of an Avro schema."""
    if isinstance(schema, str) and schema in names:
        schema = names[schema]
    if isinstance(schema, list):
        some = [s for s in schema if s != "null"]
        if len(some) != 1:
            raise TypeError(f"unions of several types are not supported: {schema}")
        return spark_type(some[0], names)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return spark_type(kind, names)
    if kind in ("record", "enum", "fixed"):
        names[schema["name"]] = names[f"{schema.get('namespace', '')}.{schema['name']}"] = schema
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"], names)) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"], names))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], names))
    logical = schema.get("logicalType") if isinstance(schema, dict) else None
    if logical == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0))
    if logical in ("date", "timestamp-millis", "timestamp-micros"):
        return T.DateType() if logical == "date" else T.TimestampType()
    plain = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType()}
    return plain.get(kind, T.BinaryType() if kind in ("bytes", "fixed") else T.StringType())


def avro_type(dt: T.DataType, name: str = "row"):
    """The Avro schema of a Spark type; every field may be null."""
    if isinstance(dt, T.StructType):
        return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", avro_type(f.dataType, f"{name}_{f.name}")], "default": None} for f in dt.fields]}
    if isinstance(dt, T.ArrayType):
        return {"type": "array", "items": ["null", avro_type(dt.elementType, f"{name}_item")]}
    if isinstance(dt, T.MapType):
        return {"type": "map", "values": ["null", avro_type(dt.valueType, f"{name}_value")]}
    if isinstance(dt, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(dt, T.TimestampType):
        return {"type": "long", "logicalType": "timestamp-micros"}
    names = {"boolean": "boolean", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "long", "float": "float", "double": "double", "string": "string", "binary": "bytes"}
    if dt.simpleString() not in names:
        raise TypeError(f"{dt.simpleString()} cannot be written")
    return names[dt.simpleString()]


def encoder(dt: T.DataType):
    """A function from a value of a Spark type to its bytes, with the branch of the union with null."""
    if isinstance(dt, T.StructType):
        parts = [encoder(f.dataType) for f in dt.fields]
        put = lambda v: b"".join(p(x) for p, x in zip(parts, v, strict=True))
    elif isinstance(dt, T.ArrayType):
        item = encoder(dt.elementType)
        put = lambda v: (put_long(len(v)) + b"".join(map(item, v)) if v else b"") + b"\x00"
    elif isinstance(dt, T.MapType):
        item = encoder(dt.valueType)
        put = lambda v: (put_long(len(v)) + b"".join(_text(k) + item(x) for k, x in v.items()) if v else b"") + b"\x00"
    elif isinstance(dt, T.DateType):
        put = lambda v: put_long((v - _DAY0).days)
    elif isinstance(dt, T.TimestampType):
        put = lambda v: put_long((v.astimezone(_dt.timezone.utc) - _TIME0) // _dt.timedelta(microseconds=1))
    elif isinstance(dt, T.BooleanType):
        put = lambda v: b"\x01" if v else b"\x00"
    elif isinstance(dt, (T.FloatType, T.DoubleType)):
        put = struct.Struct("<f" if isinstance(dt, T.FloatType) else "<d").pack
    elif isinstance(dt, T.StringType):
        put = _text
    elif isinstance(dt, T.BinaryType):
        put = lambda v: put_long(len(v)) + bytes(v)
    else:
        put = put_long
    return lambda v: b"\x00" if v is None else b"\x02" + put(v)


def _text(v: str) -> bytes:
    raw = v.encode()
    return put_long(len(raw)) + raw


# --- files ----------------------------------------------------------------------

def _decompress(codec: str, data: bytes) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        import zlib

        return zlib.decompress(data, -15)
    if codec == "bzip2":
        import bz2

        return bz2.decompress(data)
    if codec == "xz":
        import lzma

        return lzma.decompress(data)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"codec {codec!r} is not supported")


class Container:
    """A container file: its header, then its blocks one after another."""

    def __init__(self, path: str):
        files, name = open_location(path)
        self.path, self.stream = path, files.open_input_stream(name)
        if self.stream.read(4) != MAGIC:
            raise ValueError(f"{path} is no Avro container file")
        meta = {}
        while n := self._long():
            if n < 0:
                n = -n
                self._long()
            for _ in range(n):
                key = self.stream.read(self._long()).decode()
                meta[key] = self.stream.read(self._long())
        self.schema = json.loads(meta["avro.schema"])
        self.codec = meta.get("avro.codec", b"null").decode()
        self.sync = self.stream.read(16)

    def _long(self) -> int | None:
        """The next integer of the stream, None at its end."""
        raw = b""
        while True:
            byte = self.stream.read(1)
            if not byte:
                return None
            raw += byte
            if byte[0] < 0x80:
                return Cursor(raw).long()

    def blocks(self):
        """``(rows, bytes)`` of every block."""
        while (n := self._long()) is not None:
            data = self.stream.read(self._long())
            if self.stream.read(16) != self.sync:
                raise ValueError(f"{self.path}: a block does not end in the file's marker")
            yield n, _decompress(self.codec, data)


def container_files(options: dict) -> list[str]:
    """The files of ``path`` or of the JSON list ``paths``; a folder stands for the visible files in it."""
    from pyarrow import fs

    out = []
    for path in json.loads(options["paths"]) if "paths" in options else [options["path"]]:
        files, name = open_location(path)
        if files.get_file_info(name).type == fs.FileType.Directory:
            inside = files.get_file_info(fs.FileSelector(name))
            out += sorted(f"{path.rstrip('/')}/{x.base_name}" for x in inside if x.type == fs.FileType.File and x.base_name[:1] not in ("_", "."))
        else:
            out.append(path)
    return out


class ContainerReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self):
        return [InputPartition(x) for x in container_files(self.options)] or [InputPartition(None)]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.value is None:
            return
        arrow = to_arrow_schema(self.schema)
        file = Container(partition.value)
        read = decoder(file.schema, self.schema, {})
        for n, data in file.blocks():
            c = Cursor(data)
            yield pa.RecordBatch.from_pylist([read(c) for _ in range(n)], schema=arrow)


class Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class ContainerWriter(DataSourceWriter):
    """One container file per task, hidden until the job commits."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.job = schema, options["path"].rstrip("/"), uuid.uuid4().hex

    def write(self, iterator):
        import zlib

        from pyspark import TaskContext

        put = [encoder(f.dataType) for f in self.schema.fields]
        sync, task = os.urandom(16), TaskContext.get()
        meta = {"avro.schema": json.dumps(avro_type(self.schema)).encode(), "avro.codec": b"deflate"}
        files, base = open_location(self.path)
        files.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():05d}-{self.job}-{task.taskAttemptId()}.avro"
        with files.open_output_stream(f"{base}/_{name}") as out:
            out.write(MAGIC + put_long(len(meta)) + b"".join(_text(k) + put_long(len(v)) + v for k, v in meta.items()) + b"\x00" + sync)
            rows: list[bytes] = []

            def block():
                packer = zlib.compressobj(wbits=-15)
                data = packer.compress(b"".join(rows)) + packer.flush()
                out.write(put_long(len(rows)) + put_long(len(data)) + data + sync)
                rows.clear()

            for row in iterator:
                rows.append(b"".join(p(v) for p, v in zip(put, row, strict=True)))
                if len(rows) == BLOCK_ROWS:
                    block()
            if rows:
                block()
        return Written(name)

    def commit(self, messages) -> None:
        files, base = open_location(self.path)
        for m in messages:
            if m is not None:
                files.move(f"{base}/_{m.name}", f"{base}/{m.name}")

    def abort(self, messages) -> None:
        """Hidden files stay hidden: no reader sees them."""


class AvroBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "avro_blocks"

    def schema(self):
        files = container_files(dict(self.options))
        if not files:
            raise ValueError("no container file to take the schema from: give the schema")
        return spark_type(Container(files[0]).schema, {})

    def reader(self, schema) -> DataSourceReader:
        return ContainerReader(schema, dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("avro_blocks appends: write to a new folder instead of overwriting one")
        return ContainerWriter(schema, dict(self.options))


def read_avro(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Container files (or folders of them) as rows; with a schema, resolved against it."""
    spark.dataSource.register(AvroBlocks)
    reader = spark.read.format("avro_blocks")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("paths", json.dumps(list(paths))).load()


def write_avro(df: DataFrame, path: str) -> None:
    """Adds the rows of ``df`` to a folder, one container file per task."""
    df.sparkSession.dataSource.register(AvroBlocks)
    df.write.format("avro_blocks").mode("append").save(path)
