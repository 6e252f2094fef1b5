"""Dated-folder scans: ``root/<YYYY-MM-DD>/…`` with the date only in the path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.calendar import period_end_dates, validate_window


def folder_dates(spark: SparkSession, processing_date, n: int, unit: str) -> list[str]:
    """The folder names of a period-end window (C2), in window order.

    Evaluated by Spark from the same expression used everywhere else; the
    result has at most ``n`` entries, so bringing it to the driver is bounded.
    It has to come to the driver: a scan takes its paths from the driver.
    """
    spec = validate_window(processing_date, n, unit)
    row = spark.range(1).select(
        F.transform(
            period_end_dates(F.lit(spec.processing_date), F.lit(spec.n), F.lit(spec.unit)),
            lambda x: F.date_format(x, "yyyy-MM-dd"),
        ).alias("dates")
    ).first()
    return list(row["dates"])


def folder_glob(root: str, dates: list[str]) -> str:
    """``root/{d1,d2,…}``: one brace glob, so missing folders are skipped."""
    return f"{root.rstrip('/')}/{{{','.join(dates)}}}"


def read_folders(
    spark: SparkSession,
    root: str,
    *,
    file_format: str = "parquet",
    processing_date=None,
    n: int | None = None,
    unit: str = "day",
    schema: StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Read a window of dated folders (S1) or all of them (S2, ``n is None``).

    With a window the path is a brace glob of the period-end dates, so only
    those folders are listed; folders that do not exist are ignored, and if
    none exists the read fails with ``PATH_NOT_FOUND``.  ``basePath`` keeps
    Spark from treating the date folder as a partition directory.
    """
    reader = spark.read.format(file_format).option("basePath", root.rstrip("/"))
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    if n is None:
        return reader.load(f"{root.rstrip('/')}/*")
    return reader.load(folder_glob(root, folder_dates(spark, processing_date, n, unit)))
