"""Hive-partitioned file scans with a date window or static filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.calendar import validate_window, window_dates, window_predicate, window_valid


def _field_type(df: DataFrame, column: str):
    for f in df.schema.fields:
        if f.name == column:
            return f.dataType
    raise ValueError(f"column {column!r} not in {df.columns}")


def apply_window_or_filters(
    df: DataFrame,
    *,
    partition_column: str | None = None,
    processing_date=None,
    n: int | None = None,
    unit: str = "day",
    filters: str | Sequence[str] | None = None,
) -> DataFrame:
    """Restrict a frame to a window or to static filters.

    Static filters (one SQL text or a list, ANDed) win over the window.  With
    neither a window nor a partition column the frame is returned as is.
    Filters are applied with ``DataFrame.filter``; Catalyst combines them and
    pushes them into the scan (``PartitionFilters`` / ``PushedFilters``).
    """
    if filters is not None and not isinstance(filters, (str, list, tuple)):
        raise ValueError(f"invalid filters type: {type(filters).__name__}")
    conditions: list = []
    if filters:
        conditions.extend([filters] if isinstance(filters, str) else list(filters))
    elif partition_column and n is not None:
        spec = validate_window(processing_date, n, unit)
        conditions.append(window_predicate(partition_column, spec, _field_type(df, partition_column)))
    for c in conditions:
        df = df.filter(c)
    return df


def read_partitioned(
    spark: SparkSession,
    root: str,
    *,
    file_format: str = "parquet",
    partition_column: str | None = None,
    processing_date=None,
    n: int | None = None,
    unit: str = "day",
    filters: str | Sequence[str] | None = None,
    schema: StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Read ``root`` (laid out as ``root/<col>=<date>/…``) and keep a window.

    * no window (``n is None``) and no filters → whole dataset (S3);
    * a window on ``partition_column`` → contiguous-window predicate (S4);
    * ``filters`` → static SQL predicates, winning over the window (S5);
    * ``schema`` → explicit read schema, no inference (S6).

    With a window only the folders it can touch are listed: the paths are the
    window's folder globs below ``root``, and the predicate then keeps the
    exact dates.  Where no such folder exists (an empty window, or a data
    column instead of a partition column) the whole root is loaded and the
    predicate alone decides, so the result is the same.
    """
    if n is not None:
        validate_window(processing_date, n, unit)
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    df = None
    if n is not None and partition_column and not filters:
        from daybook.operators.inventory import window_glob_parts

        parts = window_glob_parts(spark, processing_date, n, unit)
        base = root.rstrip("/")
        try:
            df = reader.option("basePath", base).load(f"{base}/{partition_column}={{{','.join(parts)}}}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
    if df is None:
        df = reader.load(root)
    return apply_window_or_filters(
        df,
        partition_column=partition_column,
        processing_date=processing_date,
        n=n,
        unit=unit,
        filters=filters,
    )


def read_windows(
    spark: SparkSession, root: str, partition_column: str, specs: DataFrame, *, shape: str = "contiguous", file_format: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Rows of ``root`` in any window of a table ``specs(processing_date, n, unit)`` (S4 for windows that are data).

    The dates of the windows are rows, so no predicate can be built from them before the scan. They are joined to the
    partition column instead: Spark broadcasts them and prunes the partitions with them at run time
    (``dynamicpruning`` among the ``PartitionFilters``). Windows that cannot be valid (C4) ask for nothing, and a row
    in several windows comes once. The dates that are broadcast are distinct days, so their number is bounded by
    the span of the calendar.
    """
    valid = specs.where(window_valid(F.col("n"), F.col("unit")) & F.col("processing_date").isNotNull())
    dates = valid.select(F.explode(window_dates(F.col("processing_date"), F.col("n"), F.col("unit"), F.lit(shape))).alias("_window_date")).distinct()
    reader = spark.read.format(file_format)
    df = (reader.schema(schema) if schema is not None else reader).load(root)
    dates = F.broadcast(dates.where(F.col("_window_date") >= "0001-01-01"))
    return df.join(dates, df[partition_column] == dates["_window_date"], "left_semi")
