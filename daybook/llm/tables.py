"""Small helpers shared by the operators: stored tables, size-checked broadcasts, crc folds."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path

#: A side is broadcast only when it was counted and holds at most this many rows
#: (of a few fixed-width columns: some 50 MB at most); larger sides are shuffled.
BROADCAST_ROWS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of varying size (texts, arrays, maps) are broadcast only up to so many bytes in all.
BROADCAST_BYTES = 32_000_000


def broadcast_if_small(df: DataFrame, rows: int | None = None, size=None) -> DataFrame:
    """A broadcast hint where ``df`` has at most :data:`BROADCAST_ROWS` rows, else ``df`` as it is.

    ``size`` is the bytes of a row as a column, for rows that are not of a few fixed-width columns:
    their sum must stay below :data:`BROADCAST_BYTES` too. ``df`` should be a stored table, since it
    is counted first.
    """
    if size is not None:
        held = df.agg(F.count("*"), F.sum(size)).first()
        return F.broadcast(df) if held[0] <= BROADCAST_ROWS and (held[1] or 0) <= BROADCAST_BYTES else df
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def bounded_sample(df: DataFrame, at: str, n: int) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest md5 digests in ``at``; rows of equal digest are one.

    They are cut out by a threshold on the digest before they are sorted, so that no task
    sends more than its share of about ``1.5 n`` rows. ``df`` should be cheap to read twice.
    """
    rows = df.count()
    if rows > 2 * n:
        share = min(1.0, (1.5 * n + 50) / rows)
        df = df.where(F.col(at) < F.lit(f"{int(share * (16**8 - 1)):08x}"))
    return df.dropDuplicates([at]).orderBy(at).limit(n)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named ``c0, c1, …``, and the new name of each: no other name can clash with them."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers where they would not find it by themselves.

    They do where it came as ``--py-files`` (a zip), where its folder is on ``PYTHONPATH`` or is the
    working directory. Otherwise it goes along once per application, as ``addPyFile`` sends any module.
    """
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    known = [Path(p or ".").resolve() for p in (*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()) if p]
    if app in _SENT or not root.is_dir() or root in known:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='daybook-')}/daybook", "zip", root, "daybook")
    spark.sparkContext.addPyFile(archive)
    _SENT.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(id_column, folds: int = 5):
    """``crc32(id as text) mod folds``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds
