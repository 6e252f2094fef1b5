"""daybook — date-partition-aware incremental batch processing on Spark.

A processing date plus a window spec (``5d``, ``1m``, ``2q``, ``1y``) decides
which date partitions a step reads and writes.  Everything that touches data
is a DataFrame operation: windows are exploded date sequences, partition
inventories come from folder listings, completeness checks are
anti joins, step gating is a grouped aggregate, and the run log is an
append-only table folded with ``max_by``.

Sub-packages
------------
functions  Column-level helpers: calendar windows, spec grammar, path kinds.
sources    Scans: dated folders, hive-partitioned files, catalog tables, CSV,
           Parquet globs, table-format metadata.
sinks      Writes: dated folders, partition-overwrite, catalog tables.
operators  Inventory, completeness, table-format live partitions, date joins,
           gating, run log, evaluation.
plans      Step declarations and the gated runner that executes them.
llm        Operators for training data; on its own, nothing else imports it.
"""

__version__ = "0.1.0"
