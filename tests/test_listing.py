"""The listing data source: what it probes, what it finds, and both ways of listing against each other."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daybook.sources.listing import DatedFolderReader, PushingReader, month_days, open_location, read_dated_folders


def tree(root, names):
    root = root.replace("file:", "")
    for name in names:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        if not name.endswith("/"):
            with open(f"{root}/{name}", "w") as f:
                f.write("x")
    return root


NAMES = [
    "d=2024-01-30/a.parquet", "d=2024-01-31/h=1/b.parquet", "d=2024-02-01/_SUCCESS", "d=2024-02-02/.hidden/c", "d=2024-02-03/",
    "d=2024-02-04/_temporary/0/part", "d=2024-2-5/a", "d=2024-02-30/a", "d=2024-02-29/x/y/z", "other=2024-02-06/a", "2024-02-07/a", "d=2024-02-08",
]
HELD = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 29)]


def dates(df):
    return sorted(r["d"] for r in df.collect())


@pytest.mark.parametrize("arrow", [True, False])
def test_dates_with_data(spark, scratch, arrow):
    root = tree(scratch("tree"), NAMES)
    assert dates(read_dated_folders(spark, root, "d=", arrow=arrow)) == HELD
    assert dates(read_dated_folders(spark, "file://" + root, "d=", arrow=arrow)) == HELD
    assert dates(read_dated_folders(spark, root, "", arrow=arrow)) == [dt.date(2024, 2, 7)]
    assert dates(read_dated_folders(spark, root, "d=", ["2024-02-*"], arrow=arrow)) == HELD[2:]
    assert dates(read_dated_folders(spark, root, "d=", ["2024-01-31", "2024-02-01", "2023-02-29"], arrow=arrow)) == HELD[1:2]
    assert dates(read_dated_folders(spark, root, "d=", [], arrow=arrow)) == []
    assert dates(read_dated_folders(spark, root + "-none", "d=", arrow=arrow)) == []


def test_slices_are_partitions(spark, scratch):
    root = tree(scratch("tree"), NAMES)
    sliced = read_dated_folders(spark, root, "d=", ["2024-01-*", "2024-02-*"], slice_folders=7)
    assert sliced.rdd.getNumPartitions() == 9  # 60 days
    assert dates(sliced) == HELD


def test_pushed_bounds_cut_the_probes(spark, scratch):
    root = tree(scratch("tree"), NAMES)
    reader = PushingReader({"path": root, "prefix": "d="})
    from pyspark.sql.datasource import GreaterThan, In, LessThanOrEqual

    assert len(list(reader.pushFilters([GreaterThan(("d",), dt.date(2024, 1, 30)), LessThanOrEqual(("d",), dt.date(2024, 2, 10))]))) == 2
    assert reader.dates() == [dt.date(2024, 1, 31) + dt.timedelta(days=i) for i in range(11)]  # no listing
    among = PushingReader({"path": "/nowhere", "prefix": "d="})
    list(among.pushFilters([In(("d",), (dt.date(2024, 1, 31), None))]))
    assert among.dates() == [dt.date(2024, 1, 31)]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = read_dated_folders(spark, root, "d=").where(F.col("d") >= dt.date(2024, 1, 31)).where(F.col("d") <= dt.date(2024, 2, 10))
        assert dates(df) == HELD[1:2]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert dates(read_dated_folders(spark, root, "d=").where(F.col("d") > dt.date(2024, 1, 31))) == HELD[2:]


def test_unreadable_folders(spark, scratch, monkeypatch):
    reader = DatedFolderReader({"path": "nosuch://x/y", "only": '["2024-01-01"]', "lenient": "true"})
    assert month_days("2024-02-*")[-1] == dt.date(2024, 2, 29)
    with pytest.raises(ValueError):
        month_days("junk-*")
    monkeypatch.setattr("daybook.sources.listing.open_location", lambda x: (_ for _ in ()).throw(PermissionError(x)))
    (part,) = reader.partitions()
    assert [b.num_rows for b in reader.read(part)] == [0]
    reader.lenient = False
    with pytest.raises(PermissionError):
        list(reader.read(part))


def test_locations():
    assert open_location("/a/b")[1] == "/a/b" and open_location("file:/a/b")[1] == "/a/b" and open_location("file:///a/b")[1] == "/a/b"
