"""Storage-kind classification of a dataset location (P7), as a Column.

The Hadoop file-system layer already reads every scheme, so what matters for
the library is *path or table*; the finer kinds are kept for reporting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def location_scheme(location: Column | str) -> Column:
    loc = F.col(location) if isinstance(location, str) else location
    return F.lower(F.regexp_extract(loc, _SCHEME, 1))


def location_kind(location: Column | str) -> Column:
    """One of ``object_store``, ``hdfs``, ``local``, ``table``, ``unsupported``.

    ``s3``/``s3a`` → object_store; ``hdfs`` → hdfs; ``file`` or a scheme-less
    text with a ``/`` → local; scheme-less text without ``/`` → a catalog
    table name (any number of dotted parts); anything else is unsupported.
    """
    loc = F.col(location) if isinstance(location, str) else location
    scheme = location_scheme(loc)
    return (
        F.when(scheme.isin("s3", "s3a"), F.lit("object_store"))
        .when(scheme == "hdfs", F.lit("hdfs"))
        .when((scheme == "file") | ((scheme == "") & (F.instr(loc, "/") > 0)), F.lit("local"))
        .when((scheme == "") & (F.length(loc) > 0), F.lit("table"))
        .otherwise(F.lit("unsupported"))
    )


def location_name(location: Column | str) -> Column:
    """The dataset's short name: last path segment, or the table name itself."""
    loc = F.col(location) if isinstance(location, str) else location
    no_scheme = F.regexp_replace(loc, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    trimmed = F.regexp_replace(no_scheme, "/+$", "")
    return F.regexp_extract(trimmed, r"([^/]*)$", 1)
