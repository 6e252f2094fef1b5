"""Scans: dated folders, hive-partitioned files, catalog tables, plain files."""

from daybook.sources.catalog import describe_namespace, list_namespaces, read_table, table_exists  # noqa: F401
from daybook.sources.files import read_csv, read_json_metadata, read_parquet  # noqa: F401
from daybook.sources.folder import folder_glob, read_folders  # noqa: F401
from daybook.sources.partitioned import apply_window_or_filters, read_partitioned  # noqa: F401
