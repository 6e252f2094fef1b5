"""Writes: dated folders, partition-overwrite of files, catalog tables."""

from daybook.sinks.catalog import save_table  # noqa: F401
from daybook.sinks.files import write_folder, write_partitioned  # noqa: F401
