"""Partition inventory (P1-P4, P7) and the completeness check.

An inventory is the set of dates for which a dataset really holds data, as a
DataFrame ``(d date)``.  One operator serves every storage kind:

* files (local, ``s3a://``, ``hdfs://`` …): a data source whose tasks probe a
  slice of the date folders each, for a window only the folders that it can
  touch, up to the first data file.  The work is bounded by folders (window
  dates), not by files or bytes, and no folder is visited by the driver.
  A partition counts as present when it holds a data file; empty folders and
  ``_``/``.``-prefixed files are not data;
* catalog tables: ``SHOW PARTITIONS`` — catalog metadata only.

Completeness is ``expected LEFT ANTI inventory`` where *expected* is the
exploded window.  The expected side has a proven size bound (see
:func:`daybook.functions.calendar.window_size_bound`), and the inventory is
cut to the window's date range first, so its build side is bounded by the
same number and is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.calendar import (
    validate_window,
    window_bounds,
    window_dates,
    window_size_bound,
)
from daybook.functions.paths import location_kind

_STRICT_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
BROADCAST_ROW_LIMIT = 1_000_000


def _empty_dates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "d date")


def _strict_date(text):
    return F.when(text.rlike(_STRICT_DATE), F.try_to_date(text, "yyyy-MM-dd"))


def classify(location: str) -> str:
    """P7 for one location, evaluated with plain Python on the driver."""
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):", location)
    scheme = m.group(1).lower() if m else ""
    if scheme in ("s3", "s3a"):
        return "object_store"
    if scheme == "hdfs":
        return "hdfs"
    if scheme == "file" or (scheme == "" and "/" in location):
        return "local"
    if scheme == "" and location:
        return "table"
    raise ValueError(f"unsupported dataset location {location!r}")


def glob_parts(d, n, unit, shape) -> Column:
    """``array<string>`` of folder-name globs covering a window (Column form).

    Period-end windows and day windows of at most 62 days give their exact
    dates; longer contiguous windows give one ``yyyy-MM-*`` per month they
    touch (at most ``12·n + 1``).  Bounded by the window parameters, never by
    the data.
    """
    exact = F.transform(window_dates(d, n, unit, shape), lambda x: F.date_format(x, "yyyy-MM-dd"))
    start, end = window_bounds(d, n, unit)
    months = F.transform(
        F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH")),
        lambda x: F.concat(F.date_format(x, "yyyy-MM"), F.lit("-*")),
    )
    return F.when((shape == "period_end") | ((unit == "day") & (n <= 62)), exact).otherwise(months)


def window_glob_parts(spark: SparkSession, processing_date, n: int, unit: str, shape: str = "contiguous") -> list[str]:
    """:func:`glob_parts` for one window, evaluated once on a one-row frame."""
    spec = validate_window(processing_date, n, unit)
    row = spark.range(1).select(
        glob_parts(F.lit(spec.processing_date), F.lit(spec.n), F.lit(spec.unit), F.lit(shape)).alias("g")
    ).first()
    return list(row["g"])


def list_file_partitions(
    spark: SparkSession, root: str, partition_column: str | None = None, only: list[str] | None = None,
    arrow: bool | None = None, lenient: bool = False,
) -> DataFrame:
    """Dates present under a folder tree (P1-P4), listed by executors (:mod:`daybook.sources.listing`).

    With a partition column the child folders must be ``<col>=<date>``;
    without one (or with the text ``none``) the folder name is the date.
    A root that does not exist gives an empty inventory.

    ``only`` restricts the listing to folder names matching those globs (see
    :func:`window_glob_parts`), so a completeness check on a long-lived table
    lists the window's folders instead of the whole tree.  ``arrow`` says
    whether tasks open the folders themselves through pyarrow (the default for
    local paths; S3 and HDFS with pyarrow's own credentials) or Spark's file
    index lists the files (the default for every other scheme).  ``lenient``
    takes folders that cannot be opened for empty ones.
    """
    from daybook.sources.listing import read_dated_folders

    column = partition_column if partition_column and partition_column.lower() != "none" else None
    if arrow is None:
        arrow = classify(root) == "local"
    return read_dated_folders(spark, root.rstrip("/"), f"{column}=" if column else "", only, arrow=arrow, lenient=lenient)


def list_table_partitions(spark: SparkSession, table: str, partition_column: str) -> DataFrame:
    """Dates present in a catalog table, from partition metadata only.

    Session-catalog tables answer ``SHOW PARTITIONS``.  Table-format tables
    (Iceberg) expose a ``<table>.partitions`` metadata table with one row per
    partition that still holds live files, which is exactly the live-partition
    set of P5 (untested here: no such runtime in this environment).
    """
    from daybook.sources.catalog import table_provider

    if not spark.catalog.tableExists(table):
        return _empty_dates(spark)
    if (table_provider(spark, table) or "") == "iceberg":
        meta = spark.read.table(f"{table}.partitions")
        return meta.select(F.col(f"partition.{partition_column}").cast("date").alias("d")).where("d IS NOT NULL").distinct()
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    text = F.regexp_extract("partition", f"(?:^|/){re.escape(partition_column)}=([^/]+)", 1)
    return parts.select(_strict_date(text).alias("d")).where("d IS NOT NULL").distinct()


def list_partitions(
    spark: SparkSession, location: str, partition_column: str | None = None, only: list[str] | None = None, lenient: bool = False
) -> DataFrame:
    """Inventory of any location: a path (any scheme) or a catalog table.

    ``only`` (folder-name globs) narrows a file listing; catalog tables are
    answered from partition metadata and ignore it.
    """
    if classify(location) == "table":
        if not partition_column:
            raise ValueError(f"table {location!r} needs a partition column")
        return list_table_partitions(spark, location, partition_column)
    return list_file_partitions(spark, location, partition_column, only, lenient=lenient)


def expected_dates(spark: SparkSession, processing_date, n: int, unit: str, shape: str = "contiguous") -> DataFrame:
    """``(pos bigint, d date)``: the window's dates with their list position."""
    spec = validate_window(processing_date, n, unit)
    return spark.range(1).select(
        F.posexplode(
            window_dates(F.lit(spec.processing_date), F.lit(spec.n), F.lit(spec.unit), F.lit(shape))
        ).alias("pos", "d")
    ).select(F.col("pos").cast("bigint").alias("pos"), "d")


def missing_dates(
    spark: SparkSession,
    location: str,
    processing_date,
    n: int,
    unit: str,
    *,
    shape: str = "contiguous",
    partition_column: str | None = None,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Expected dates that have no data, ``(pos, d)``, window order in ``pos``.

    ``shape="period_end"`` is used for dated-folder datasets, ``"contiguous"``
    for partitioned files and tables.
    """
    spec = validate_window(processing_date, n, unit)
    expected = expected_dates(spark, spec.processing_date, spec.n, spec.unit, shape)
    if inventory is None:
        inventory = list_partitions(
            spark, location, partition_column, window_glob_parts(spark, spec.processing_date, spec.n, spec.unit, shape)
        )
    return anti_by_window(expected, inventory, spec.processing_date, spec.n, spec.unit, shape)


def anti_by_window(expected: DataFrame, inventory: DataFrame, processing_date, n, unit, shape) -> DataFrame:
    """``expected LEFT ANTI inventory`` on ``d`` with a size-checked broadcast."""
    # Period-end dates always lie inside the contiguous bounds of the same window.
    start, end = window_bounds(F.lit(processing_date), F.lit(n), F.lit(unit))
    present = inventory.where((F.col("d") >= start) & (F.col("d") <= end)).select("d").distinct()
    if window_size_bound(n, unit, "contiguous") <= BROADCAST_ROW_LIMIT:
        present = F.broadcast(present)
    return expected.join(present, "d", "left_anti").select("pos", "d")


def completeness(
    spark: SparkSession,
    location: str,
    processing_date,
    n: int,
    unit: str,
    *,
    shape: str = "contiguous",
    partition_column: str | None = None,
) -> tuple[str, list]:
    """Driver-facing form of P6: ``(dataset name, [missing dates…])``.

    The missing list has at most ``n`` × 366 entries, so collecting it is bounded.
    """
    miss = missing_dates(
        spark, location, processing_date, n, unit, shape=shape, partition_column=partition_column
    )
    name = location.rstrip("/").rsplit("/", 1)[-1]
    return name, [r["d"] for r in miss.orderBy("pos").collect()]


__all__ = [
    "classify",
    "completeness",
    "expected_dates",
    "list_file_partitions",
    "list_partitions",
    "list_table_partitions",
    "location_kind",
    "missing_dates",
]
