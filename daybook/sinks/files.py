"""File sinks: one dated folder per run (K1) and hive-partitioned writes (K2, K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daybook.functions.calendar import validate_window


def write_folder(
    df: DataFrame,
    root: str,
    processing_date,
    *,
    file_format: str = "parquet",
    mode: str = "overwrite",
    options: dict | None = None,
) -> str:
    """Save the frame to ``root/<processing_date>`` (K1); returns that path."""
    spec = validate_window(processing_date, 1, "day")
    path = f"{root.rstrip('/')}/{spec.processing_date.isoformat()}"
    writer = df.write.mode(mode).format(file_format)
    if options:
        writer = writer.options(**options)
    writer.save(path)
    return path


def write_partitioned(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] | str | None = None,
    *,
    file_format: str = "parquet",
    mode: str = "overwrite",
    overwrite: str = "dynamic",
    rebalance: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """Write ``df`` under ``root`` partitioned by ``partition_by`` (K2, K7).

    ``overwrite="dynamic"`` (default) replaces only the partitions present in
    ``df`` and keeps every other one; ``"static"`` replaces the whole folder
    (Spark's own default).  The mode is a per-write option; the session
    configuration is left alone.

    ``rebalance`` inserts a ``REBALANCE(partition columns)`` hint: adaptive
    execution then splits a date that holds a large share of the rows over
    several tasks (several files) and merges tiny ones, so one hot date never
    becomes a single huge task and quiet dates do not produce many tiny
    files.
    """
    if overwrite not in ("dynamic", "static"):
        raise ValueError(f"overwrite must be 'dynamic' or 'static', not {overwrite!r}")
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if cols and rebalance:
        df = df.hint("rebalance", *cols)
    writer = df.write.mode(mode).format(file_format)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", overwrite)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(root)
