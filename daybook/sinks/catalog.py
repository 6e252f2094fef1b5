"""Catalog-table sink: create, append, overwrite touched partitions (K3-K6)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from daybook.session import scratch_path
from daybook.sources.catalog import table_exists, table_location, table_provider, table_storage_properties

_V2_PROVIDERS = ("iceberg", "delta")
#: Partitions that one statement registers.
STATEMENT_PARTITIONS = 500


def _dynamic_table(spark, name: str) -> bool:
    props = table_storage_properties(spark, name) or ""
    return re.search(r"(?:^|[\[ ,])partitionOverwriteMode=dynamic(?:$|[\],])", props, re.IGNORECASE) is not None


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] | str | None = None,
    location: str | None = None,
    provider: str = "parquet",
    rebalance: bool = True,
) -> str:
    """Save to a catalog table; returns the action taken.

    * table absent → create it, partitioned by **all** ``partition_by``
      columns (K3), whatever the mode;
    * ``mode="append"`` → append (K4);
    * ``mode="overwrite"`` → replace only the partitions present in ``df``
      (K5);
    * any other mode on an existing table → ``ValueError``; a non-DataFrame →
      ``TypeError`` (K6).  Both are checked before any job starts.

    V2 tables (Iceberg, Delta) use ``writeTo(...).append()`` /
    ``overwritePartitions()``; session-catalog file tables use
    ``insertInto`` with a per-write dynamic overwrite, after reordering the
    columns to the table's order (``insertInto`` matches by position).
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a pyspark DataFrame, got {type(df).__name__}")
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported mode {mode!r} for a table write")
    spark = df.sparkSession
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if not table_exists(spark, name):
        if cols and rebalance:
            df = df.hint("rebalance", *cols)
        writer = df.writeTo(name).using(provider)
        if location:
            writer = writer.option("path", location)
        if cols:
            # Stored with the table: later overwrites replace touched partitions only.
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionedBy(*[F.col(c) for c in cols])
        writer.create()
        return "create"
    # An existing table is written with *its* partition columns, whatever
    # the caller passed; the rebalance follows them too.
    part_cols = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if part_cols and rebalance:
        df = df.hint("rebalance", *part_cols)
    existing = table_provider(spark, name) or ""
    if existing in _V2_PROVIDERS:
        if mode == "append":
            df.writeTo(name).append()
        else:
            df.writeTo(name).overwritePartitions()
        return mode
    ordered = df.select(*spark.read.table(name).columns)
    if mode == "append":
        ordered.write.insertInto(name)
        return mode
    if not part_cols or _dynamic_table(spark, name):
        # Tables created here carry partitionOverwriteMode=dynamic in their
        # options: insertInto replaces the touched partitions and registers
        # only the new ones in the catalog.
        ordered.write.insertInto(name, overwrite=True)
        return mode
    # A table created elsewhere follows the session setting, and insertInto
    # ignores a per-write partitionOverwriteMode (static would drop every
    # partition).  The rows are written once to a folder of their own; what they
    # touch is read from that write, and the touched partitions go into the
    # table's folder with a per-write dynamic overwrite.  They are registered
    # with one statement per STATEMENT_PARTITIONS of them.
    location = table_location(spark, name)
    staged = scratch_path(spark, "staged_partitions")
    ordered.write.partitionBy(*part_cols).parquet(staged)
    written = spark.read.schema(ordered.schema).parquet(staged).select(*ordered.columns)
    (
        (written.hint("rebalance", *part_cols) if rebalance else written).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(existing or provider)
        .partitionBy(*part_cols)
        .save(location)
    )
    specs = []
    for row in written.select(*part_cols).distinct().toLocalIterator():
        specs.append(f"PARTITION ({', '.join(f'{c} = {_literal(row[c])}' for c in part_cols)})")
        if len(specs) == STATEMENT_PARTITIONS:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
            specs.clear()
    if specs:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(name)
    return mode


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str] | str, buckets: int, *, location: str | None = None, provider: str = "parquet") -> None:
    """Save to a new table bucketed and sorted by ``keys``.

    Tables with the same number of buckets on their join keys are joined, and a
    table is aggregated by its keys, without an exchange: equal keys are in
    files of the same number already. The rows are dealt out by the keys first,
    so that each bucket is one file.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    writer = df.repartition(buckets, *keys).write.format(provider).bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", location)
    writer.mode("errorifexists").saveAsTable(name)
