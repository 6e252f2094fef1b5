"""Avro container files: round trips, schema resolution, codecs, files written by the container's definition."""

import datetime as dt
import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from daybook.sources.avro import MAGIC, Cursor, container_files, put_long, read_avro, write_avro


def text(s):
    return put_long(len(s.encode())) + s.encode()


def container(path, schema, blocks, codec="null", sync=b"0123456789abcdef"):
    meta = {"avro.schema": json.dumps(schema), "avro.codec": codec}
    pack = {"null": lambda b: b, "deflate": lambda b: zlib.compress(b)[2:-4]}.get(codec)
    if codec == "zstandard":
        import zstandard

        pack = zstandard.ZstdCompressor().compress
    out = MAGIC + put_long(len(meta)) + b"".join(text(k) + text(v) for k, v in meta.items()) + b"\x00" + sync
    for n, data in blocks:
        data = pack(data)
        out += put_long(n) + put_long(len(data)) + data + sync
    with open(path, "wb") as f:
        f.write(out)


ENTRY = {
    "type": "record", "name": "entry", "namespace": "x", "fields": [
        {"name": "status", "type": "int"},
        {"name": "gone", "type": ["null", "long"], "default": None},
        {"name": "kind", "type": {"type": "enum", "name": "kind", "symbols": ["DATA", "DELETES"]}},
        {"name": "tags", "type": {"type": "map", "values": "double"}},
        {"name": "file", "type": {"type": "record", "name": "file", "fields": [
            {"name": "path", "type": "string"},
            {"name": "day", "type": ["null", {"type": "int", "logicalType": "date"}]},
            {"name": "splits", "type": ["null", {"type": "array", "items": "long"}]},
            {"name": "key", "type": {"type": "fixed", "name": "k", "size": 2}},
        ]}},
    ],
}


def entry(status, path, day, splits):
    out = put_long(status) + b"\x00" + put_long(1) + put_long(1) + text("a") + struct.pack("<d", 0.5) + b"\x00" + text(path)
    out += b"\x00" if day is None else b"\x02" + put_long(day)
    # A block of items may say its bytes after a negative count.
    items = b"".join(map(put_long, splits))
    return out + b"\x02" + put_long(-len(splits)) + put_long(len(items)) + items + b"\x00" + b"\x01\x02"


@pytest.mark.parametrize("codec", ["null", "deflate", "zstandard"])
def test_reads_blocks_by_the_definition(spark, scratch, codec):
    path = scratch("avro").replace("file:", "") + ".avro"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    container(path, ENTRY, [(2, entry(1, "p", 19_000, [1, 300, -7]) + entry(2, "é", None, [5])), (1, entry(0, "q", -1, [2**40]))], codec)
    rows = read_avro(spark, path).orderBy("status").collect()
    assert [r["status"] for r in rows] == [0, 1, 2] and rows[1]["kind"] == "DELETES" and rows[0]["tags"] == {"a": 0.5}
    assert [r["file"]["day"] for r in rows] == [dt.date(1969, 12, 31), dt.date(2022, 1, 8), None]
    assert [r["file"]["splits"] for r in rows] == [[2**40], [1, 300, -7], [5]] and bytes(rows[0]["file"]["key"]) == b"\x01\x02"
    # Resolved against another schema: fewer fields, wider numbers, fields that the file lacks.
    wanted = "status bigint, more string, file struct<path: string, rows: bigint>"
    assert [tuple(r) for r in read_avro(spark, path, schema=wanted).orderBy("status").collect()] == [(0, None, ("q", None)), (1, None, ("p", None)), (2, None, ("é", None))]
    with pytest.raises(Exception, match="record file cannot be read as"):
        read_avro(spark, path, schema="file string").collect()


def test_round_trip_of_all_types(spark, scratch):
    df = spark.range(10_000).select(
        "id", (F.col("id") % 7).cast("int").alias("i"), (F.col("id") / 3).alias("d"), (F.col("id") / 3).cast("float").alias("f"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("ü"), F.col("id").cast("string"))).alias("s"), (F.col("id") % 2 == 0).alias("b"),
        F.date_add(F.lit("1960-01-01"), (F.col("id") % 9000).cast("int")).alias("day"), F.timestamp_micros(F.col("id") * 1_000_003 - 5).alias("at"),
        F.array(F.col("id"), F.lit(None)).alias("a"), F.create_map(F.lit("k"), F.col("id")).alias("m"),
        F.struct(F.col("id").cast("string").alias("x"), F.array(F.struct(F.lit(-1).cast("long").alias("y"))).alias("z")).alias("r"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("raw"),
    ).repartition(3)
    root = scratch("avro")
    write_avro(df, root)
    back = read_avro(spark, root)
    assert [f.dataType.simpleString() for f in back.schema] == [f.dataType.simpleString() for f in df.schema] and back.rdd.getNumPartitions() == 3
    assert back.drop("m").exceptAll(df.drop("m")).count() == 0 and back.count() == 10_000
    assert back.select("id", F.col("m")["k"].alias("v")).where("id <> v").count() == 0
    write_avro(df.limit(5), root)
    assert read_avro(spark, root).count() == 10_005
    assert all(x.endswith(".avro") for x in container_files({"path": root}))
    with pytest.raises(Exception, match="appends"):
        df.write.format("avro_blocks").mode("overwrite").save(root)


def test_empty_and_broken_files(spark, scratch):
    root = scratch("avro")
    write_avro(spark.createDataFrame([], "x long").repartition(1), root)
    assert read_avro(spark, root, schema="x long").count() == 0
    path = scratch("bad").replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/a.avro", "wb") as f:
        f.write(b"PAR1")
    with pytest.raises(Exception, match="no Avro container file"):
        read_avro(spark, path, schema="x long").collect()
    none = scratch("none").replace("file:", "")
    os.makedirs(none)
    with pytest.raises(Exception, match="give the schema"):
        read_avro(spark, none)


def test_numbers():
    for v in (0, -1, 1, 63, 64, -65, 2**31, -(2**63), 2**63 - 1):
        assert Cursor(put_long(v)).long() == v
