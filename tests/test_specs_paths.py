"""G1/G2 spec grammar and tags; P7 location kinds."""

import pytest

from daybook.functions.paths import location_kind, location_name
from daybook.functions.specs import decode_tags, parse_spec, spec_to_tag
from daybook.operators.inventory import classify


@pytest.mark.parametrize(
    "spec,name,n,unit",
    [
        ("raw:4d", "raw", 4, "day"),
        ("raw:12M", "raw", 12, "month"),
        ("raw:2q", "raw", 2, "quarter"),
        ("raw:1Y", "raw", 1, "year"),
        ("raw:7", "raw", 7, "day"),
        ("raw:*", "raw", None, None),
        ("raw:", "raw", None, None),
        ("raw", "raw", None, None),
        ("a:b:3d", "a", None, None),
        ("raw:0d", "raw", None, None),
        ("raw:d", "raw", None, None),
        ("raw:-3d", "raw", None, None),
        ("raw:007d", "raw", 7, "day"),
    ],
)
def test_parse_spec(spark, spec, name, n, unit):
    r = spark.createDataFrame([(spec,)], "s string").select(parse_spec("s").alias("p")).first()["p"]
    assert (r["name"], r["n"], r["unit"]) == (name, n, unit)


def test_spec_to_tag(spark):
    rows = spark.createDataFrame([("data:4d",), ("data:4m",), ("raw_data:7",), ("x:*",), ("plain",)], "s string")
    got = [r[0] for r in rows.select(spec_to_tag("input", "s")).collect()]
    assert got == ["input--data--4--day", "input--data--4--month", "input--raw_data--7", "input--x--0", None]


def test_decode_tags_last_one_wins(spark):
    tags = spark.createDataFrame(
        [
            ("n1", 1, "input--raw--5--day"),
            ("n1", 2, "input--raw--2--month"),   # later tag for the same name wins
            ("n1", 3, "output--raw--9--day"),    # other prefix dropped
            ("n1", 4, "input--bad--x--day"),     # non-integer dropped
            ("n1", 5, "input--zero--0"),         # non-positive dropped
            ("n1", 6, "input--old--7"),          # old form: unit day
        ],
        "step string, pos int, tag string",
    )
    got = {r["name"]: (r["n"], r["unit"]) for r in decode_tags(tags, ["step"], "tag", ["pos"], "input").collect()}
    assert got == {"raw": (2, "month"), "old": (7, "day")}


@pytest.mark.parametrize(
    "loc,kind,name",
    [
        ("s3a://warehouse/raw", "object_store", "raw"),
        ("s3://bucket/x/", "object_store", "x"),
        ("hdfs://nn:8020/data/events", "hdfs", "events"),
        ("file:///tmp/a/b", "local", "b"),
        ("/tmp/a/b/", "local", "b"),
        ("data/raw", "local", "raw"),
        ("cat.ns.table", "table", "cat.ns.table"),
        ("cat.a.b.table", "table", "cat.a.b.table"),
        ("http://example.com/x", "unsupported", "x"),
    ],
)
def test_location_kind(spark, loc, kind, name):
    r = spark.createDataFrame([(loc,)], "l string").select(location_kind("l").alias("k"), location_name("l").alias("n")).first()
    assert (r["k"], r["n"]) == (kind, name)
    if kind == "unsupported":
        with pytest.raises(ValueError):
            classify(loc)
    else:
        assert classify(loc) == kind
