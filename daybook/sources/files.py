"""Plain file scans used by the notebooks and the table-format metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, *, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with a header (S8).  Pass ``schema`` in production; without it the
    types are inferred, which costs one extra pass over the files."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def read_parquet(spark: SparkSession, *paths: str, base_path: str | None = None) -> DataFrame:
    """Parquet from one folder, a ``/*`` wildcard, a brace glob or many paths.

    ``base_path`` keeps partition columns (``col=value`` folders below it)
    when the paths point inside a partitioned tree.
    """
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    return reader.parquet(*paths)


def read_json_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON documents such as table-format metadata files.

    Hyphenated field names stay addressable as ``col("current-snapshot-id")``.
    """
    return spark.read.option("multiLine", "true").json(path)
