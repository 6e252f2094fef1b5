"""P1-P4 inventory edge cases and P6 completeness with the reference's own data."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daybook.operators.inventory import completeness, list_partitions, missing_dates
from tests.test_sources_sinks import raw_folders


def _touch_parquet(spark, path):
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(path)


def test_folder_name_edge_cases(spark, scratch):
    root = scratch("inv")
    _touch_parquet(spark, f"{root}/d=2025-01-01")
    _touch_parquet(spark, f"{root}/d=2025-1-1")        # not zero-padded: not a partition date
    _touch_parquet(spark, f"{root}/d=2025-02-30")      # impossible date
    _touch_parquet(spark, f"{root}/d=junk")
    _touch_parquet(spark, f"{root}/other=2025-01-02")  # other partition column
    os.makedirs(f"{root}/d=2025-01-03".replace("file:", ""), exist_ok=True)  # empty folder: no data file
    _touch_parquet(spark, f"{root}/d=2025-01-04/h=1")  # nested partition level
    got = sorted(r["d"] for r in list_partitions(spark, root, "d").collect())
    assert got == [dt.date(2025, 1, 1), dt.date(2025, 1, 4)]
    assert list_partitions(spark, root + "-missing", "d").count() == 0


def test_bare_folder_inventory(spark, scratch):
    root = raw_folders(spark, scratch("raw"))
    _touch_parquet(spark, f"{root}/not-a-date")
    got = sorted(str(r["d"]) for r in list_partitions(spark, root, None).collect())
    assert got == ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04"]
    assert list_partitions(spark, root, "none").count() == 4


@pytest.mark.parametrize(
    "date,n,missing",
    [
        ("2025-01-01", 5, ["2024-12-28", "2024-12-29", "2024-12-30", "2024-12-31"]),
        ("2025-01-03", 3, []),
        ("2025-01-04", 4, []),
        ("2025-01-04", 5, ["2024-12-31"]),
    ],
)
def test_completeness_reference_data(spark, scratch, date, n, missing):
    root = raw_folders(spark, scratch("raw"))
    name, got = completeness(spark, root, date, n, "day", shape="period_end")
    assert [str(d) for d in got] == missing
    assert name.startswith("raw")


def test_completeness_keeps_window_order(spark, scratch):
    root = raw_folders(spark, scratch("raw"))
    m = missing_dates(spark, root, "2025-01-04", 3, "month", shape="period_end").orderBy("pos").collect()
    assert [(r["pos"], str(r["d"])) for r in m] == [(0, "2025-01-31"), (1, "2024-12-31"), (2, "2024-11-30")]


def test_completeness_month_needs_whole_month(spark, scratch):
    from daybook.sinks.files import write_partitioned

    root = scratch("ev")
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("processed_date", F.to_date("ts"))
    write_partitioned(e, root, "processed_date")
    _, miss = completeness(spark, root, "2024-01-30", 1, "month", partition_column="processed_date")
    assert [str(d) for d in miss] == ["2024-01-31"]
    _, miss = completeness(spark, root, "2024-01-15", 5, "day", partition_column="processed_date")
    assert miss == []


def test_relative_root(spark, scratch):
    """A relative root resolves against the JVM's working directory (the
    process cwd at start-up); the inventory must still find its folders."""
    root = scratch("rel")
    _touch_parquet(spark, f"{root}/d=2025-01-01")
    rel = os.path.relpath(root.replace("file:", "").rstrip("/"), os.getcwd())
    got = [str(r["d"]) for r in list_partitions(spark, rel, "d").collect()]
    assert got == ["2025-01-01"]
