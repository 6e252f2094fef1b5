"""S1-S9 scans and K1-K7 sinks on scratch folders and the session catalog."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daybook.session import scratch_table_name
from daybook.sinks.catalog import save_table
from daybook.sinks.files import write_folder, write_partitioned
from daybook.sources.catalog import read_table, table_exists
from daybook.sources.folder import folder_dates, read_folders
from daybook.sources.partitioned import read_partitioned

# The reference's four raw daily files, with invented names: 2, 3, 4, 5 rows.
RAW = {
    "2025-01-01": [(1, "ann"), (2, "bo")],
    "2025-01-02": [(3, "cy"), (4, "di"), (5, "ed")],
    "2025-01-03": [(6, "fay"), (7, "gus"), (8, "hal"), (9, "ivy")],
    "2025-01-04": [(10, "jo"), (11, "kim"), (12, "lu"), (13, "max"), (14, "ned")],
}


def raw_folders(spark, root):
    for day, rows in RAW.items():
        df = spark.createDataFrame([(i, n, dt.date.fromisoformat(day)) for i, n in rows], "id int, name string, processed_date date")
        write_folder(df, root, day)
    return root


def test_folder_window_reads_only_window_and_ignores_missing(spark, scratch):
    root = raw_folders(spark, scratch("raw"))
    assert folder_dates(spark, "2025-01-04", 3, "day") == ["2025-01-02", "2025-01-03", "2025-01-04"]
    assert read_folders(spark, root, processing_date="2025-01-04", n=3).count() == 12
    # 5-day window at 2025-01-02: 2024-12-29..31 do not exist and are skipped
    assert read_folders(spark, root, processing_date="2025-01-02", n=5).count() == 5
    assert read_folders(spark, root).count() == 14
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_folders(spark, root, processing_date="2024-06-30", n=2, unit="day")


def test_folder_month_end_window(spark, scratch):
    root = raw_folders(spark, scratch("raw"))
    assert folder_dates(spark, "2025-01-04", 2, "month") == ["2025-01-31", "2024-12-31"]


def test_static_filters_win_over_window(spark, scratch):
    root = scratch("p")
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("processed_date", F.to_date("ts"))
    write_partitioned(e, root, "processed_date")
    w = read_partitioned(spark, root, partition_column="processed_date", processing_date="2024-01-15", n=5,
                         filters="event_type = 'click'")
    assert w.count() == e.where("event_type = 'click'").count()
    with pytest.raises(ValueError):
        read_partitioned(spark, root, partition_column="processed_date", processing_date="2024-01-15", n=5, filters=5)
    schema = "event_id bigint, event_type string, processed_date date"
    s = read_partitioned(spark, root, schema=schema)
    assert s.columns == ["event_id", "event_type", "processed_date"]


def test_dynamic_keeps_other_partitions_static_drops_them(spark, scratch):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("processed_date", F.to_date("ts"))
    day = e.where("processed_date = date'2024-01-05'").where("event_type = 'click'")
    for mode, expected_days in (("dynamic", 30), ("static", 1)):
        root = scratch("ow")
        write_partitioned(e, root, "processed_date")
        write_partitioned(day, root, "processed_date", overwrite=mode)
        back = spark.read.parquet(root)
        assert back.select("processed_date").distinct().count() == expected_days
        assert back.where("processed_date = date'2024-01-05'").count() == day.count()
    # dynamic with zero rows changes nothing
    root = scratch("ow0")
    write_partitioned(e, root, "processed_date")
    write_partitioned(e.limit(0), root, "processed_date", overwrite="dynamic")
    assert spark.read.parquet(root).count() == e.count()
    with pytest.raises(ValueError):
        write_partitioned(e, scratch("bad"), "processed_date", overwrite="sometimes")


def test_catalog_table_create_append_overwrite(spark, scratch):
    name = scratch_table_name("t")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("processed_date", F.to_date("ts"))
    first = e.where("processed_date <= date'2024-01-05'")
    assert not table_exists(spark, name)
    assert save_table(first, name, partition_by=["processed_date", "event_type"], location=scratch("tbl")) == "create"
    # all partition columns are kept, not only the last one
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    assert parts == ["processed_date", "event_type"]
    n0 = spark.table(name).count()
    assert save_table(first.limit(3), name, mode="append") == "append"
    assert spark.table(name).count() == n0 + 3
    kept = spark.table(name).where("processed_date = date'2024-01-01'").count()
    new = e.where("processed_date = date'2024-01-06' AND event_type = 'click'")
    save_table(new, name, mode="overwrite")
    back = spark.table(name)
    assert back.where("processed_date = date'2024-01-01'").count() == kept
    assert back.where("processed_date = date'2024-01-06'").count() == new.count()
    w = read_table(spark, name, partition_column="processed_date", processing_date="2024-01-06", n=1)
    assert w.count() == new.count()
    with pytest.raises(ValueError):
        save_table(new, name, mode="merge")
    with pytest.raises(TypeError):
        save_table([1, 2], name)


def test_overwrite_of_table_created_elsewhere_stays_dynamic(spark, scratch):
    name = scratch_table_name("foreign")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("processed_date", F.to_date("ts"))
    e.write.partitionBy("processed_date").option("path", scratch("foreign")).saveAsTable(name)
    n_days = e.select("processed_date").distinct().count()
    new = e.where("processed_date = date'2024-01-03' AND event_type = 'view'")
    save_table(new, name, mode="overwrite")
    back = spark.table(name)
    assert back.select("processed_date").distinct().count() == n_days
    assert back.where("processed_date = date'2024-01-03'").count() == new.count()
    assert back.where("processed_date = date'2024-01-04'").count() == e.where("processed_date = date'2024-01-04'").count()


def test_existence_check_only_not_found_is_absent(spark):
    assert table_exists(spark, scratch_table_name("nothing_here")) is False
    with pytest.raises(Exception):
        table_exists(spark, "bad..name")      # a malformed name is an error, not "absent"


def test_window_scan_lists_only_its_folders(spark, scratch):
    root = scratch("thirty")
    days = spark.range(30).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"), "id")
    days.write.partitionBy("d").parquet(root)
    five = read_partitioned(spark, root, partition_column="d", processing_date="2024-01-15", n=5)
    assert len(five.inputFiles()) == 5 and dict(five.dtypes)["d"] == "date" and five.count() == 5
    assert len(five._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().inputFiles()) == 5
    assert read_partitioned(spark, root, partition_column="d", processing_date="2030-01-15", n=5).count() == 0
    assert read_partitioned(spark, root, partition_column="d", processing_date="2024-01-30", n=1, unit="month").count() == 30
