"""Catalog-table scans and catalog introspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from daybook.sources.partitioned import apply_window_or_filters


def read_table(
    spark: SparkSession,
    name: str,
    *,
    partition_column: str | None = None,
    processing_date=None,
    n: int | None = None,
    unit: str = "day",
    filters: str | Sequence[str] | None = None,
) -> DataFrame:
    """Scan a catalog table with the same three cases as the file scans.

    ``spark.read.table`` resolves through whatever catalog the name points
    at (the session catalog or a V2 catalog such as Iceberg), so the window
    predicate is pruned by that catalog's partition metadata.
    """
    return apply_window_or_filters(
        spark.read.table(name),
        partition_column=partition_column,
        processing_date=processing_date,
        n=n,
        unit=unit,
        filters=filters,
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    """Does the table exist (S17)?  Only "not found" means absent; any other
    catalog error propagates instead of being read as "absent"."""
    return bool(spark.catalog.tableExists(name))


def list_namespaces(spark: SparkSession, parent: str | None = None) -> DataFrame:
    """``SHOW NAMESPACES [IN parent]``."""
    return spark.sql(f"SHOW NAMESPACES IN {parent}" if parent else "SHOW NAMESPACES")


def describe_namespace(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE NAMESPACE EXTENDED``."""
    return spark.sql(f"DESCRIBE NAMESPACE EXTENDED {name}")


def metadata_log(spark: SparkSession, table: str) -> DataFrame:
    """The ``metadata_log_entries`` metadata table of a table-format table.

    Only catalogs that expose metadata tables (Iceberg) answer this.
    """
    return spark.read.table(f"{table}.metadata_log_entries")


def _table_detail(spark: SparkSession, name: str, key: str) -> str | None:
    # A table that cannot be described raises: guessing its provider would pick the wrong write path.
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(f"col_name = '{key}'").collect()
    return rows[0]["data_type"] if rows else None


def table_provider(spark: SparkSession, name: str) -> str | None:
    """The table's provider (``parquet``, ``iceberg``, …) from the catalog."""
    p = _table_detail(spark, name, "Provider")
    return p.lower() if p else None


def table_storage_properties(spark: SparkSession, name: str) -> str | None:
    """The table's storage properties (its ``OPTIONS``) as catalog text."""
    return _table_detail(spark, name, "Storage Properties")


def table_location(spark: SparkSession, name: str) -> str | None:
    """The table's storage folder from the catalog."""
    return _table_detail(spark, name, "Location")
