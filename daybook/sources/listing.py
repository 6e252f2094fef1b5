"""A Spark data source that lists dated folders on the executors.

``spark.read.format("dated_folders").load(root)`` gives ``(d date)``: the dates
for which ``root/<prefix><yyyy-MM-dd>/`` holds a data file. The folders are cut
into slices, one input partition each, and every task probes its own slice up
to the first data file of each folder.

What is probed comes from the window where there is one: from the folder names
in the option ``only`` (a JSON list of dates or ``yyyy-MM-*``), or from date
bounds that Spark pushes down. The driver then makes no file-system call.
Without a window it lists the root once, one level deep.

Folders are opened with :mod:`pyarrow.fs`, which knows local files, S3, HDFS and
GCS. :func:`read_dated_folders` falls back to Spark's own file listing for
locations that pyarrow is not to open.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Folders that one task probes.
SLICE = 256
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")

# Python workers get this module's classes by value, so they need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parse_date(text: str) -> _dt.date | None:
    """A strict ``yyyy-MM-dd`` date, else None."""
    if not _DATE.fullmatch(text):
        return None
    try:
        return _dt.date.fromisoformat(text)
    except ValueError:
        return None


def open_location(location: str):
    """``(pyarrow file system, path in it)`` of a location."""
    from pyarrow import fs

    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", location)
    if scheme is None:
        return fs.LocalFileSystem(), location
    if scheme[1].lower() == "file":
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", location, flags=re.I)
    return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", location, flags=re.I))


def holds_data(files, folder: str) -> bool:
    """Is there a file below ``folder`` outside hidden (``_``/``.``) files and folders?

    Depth first, one level at a time, until the first one.
    """
    from pyarrow import fs

    below = []
    try:
        inside = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    except NotADirectoryError:  # a file of that name
        return False
    for info in inside:
        if info.base_name[:1] in ("_", "."):
            continue
        if info.type == fs.FileType.File:
            return True
        below.append(info.path)
    return any(holds_data(files, x) for x in below)


def month_days(glob: str) -> list[_dt.date]:
    """The dates of one folder glob: a date itself, or the days of ``yyyy-MM-*``."""
    if glob.endswith("-*"):
        first = parse_date(glob[:-1] + "01")
        if first is None:
            raise ValueError(f"not a date or a month: {glob!r}")
        return [d for i in range(31) if (d := first + _dt.timedelta(days=i)).month == first.month]
    d = parse_date(glob)
    return [] if d is None else [d]


class DatedFolderReader(DataSourceReader):
    """Options: ``path``, ``prefix`` (``col=`` or empty), ``only`` (JSON list or absent), ``slice``, ``lenient``
    (a slice that cannot be listed holds nothing)."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.prefix = options.get("prefix", "")
        self.only = json.loads(options["only"]) if "only" in options else None
        self.slice, self.lenient = int(options.get("slice", SLICE)), options.get("lenient") == "true"
        self.low, self.high, self.among = _dt.date.min, _dt.date.max, None

    def dates(self) -> list[_dt.date]:
        """Dates to probe; the root is listed only where nothing bounds them."""
        bounded = self.low > _dt.date.min and self.high < _dt.date.max
        if self.only is not None:
            found = {d for x in self.only for d in month_days(x)}
        elif self.among is not None:
            found = set(self.among)
        elif bounded and (self.high - self.low).days <= 366:
            found = {self.low + _dt.timedelta(days=i) for i in range((self.high - self.low).days + 1)}
        else:
            from pyarrow import fs

            files, base = open_location(self.root)
            names = (x.base_name for x in files.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.type == fs.FileType.Directory)
            found = {d for x in names if x.startswith(self.prefix) and (d := parse_date(x[len(self.prefix):]))}
        found = {d for d in found if self.low <= d <= self.high}
        return sorted(found if self.among is None else found & set(self.among))

    def partitions(self):
        dates = self.dates()
        return [InputPartition(dates[i : i + self.slice]) for i in range(0, len(dates), self.slice)] or [InputPartition([])]

    def read(self, partition):
        try:
            files, base = open_location(self.root)
            held = [d for d in partition.value if holds_data(files, f"{base}/{self.prefix}{d.isoformat()}")]
        except OSError:
            if not self.lenient:
                raise
            held = []
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.date32())], names=["d"])


class PushingReader(DatedFolderReader):
    """The reader where Spark pushes filters down: bounds on ``d`` cut the folders that are probed."""

    def pushFilters(self, filters):
        day = _dt.timedelta(days=1)
        for f in filters:
            if isinstance(f, (GreaterThanOrEqual, GreaterThan)) and f.value is not None:
                self.low = max(self.low, f.value if isinstance(f, GreaterThanOrEqual) else f.value + day)
            elif isinstance(f, (LessThanOrEqual, LessThan)) and f.value is not None:
                self.high = min(self.high, f.value if isinstance(f, LessThanOrEqual) else f.value - day)
            elif isinstance(f, EqualTo) and f.value is not None:
                self.low, self.high = max(self.low, f.value), min(self.high, f.value)
            elif isinstance(f, In) and self.among is None:
                self.among = tuple(x for x in f.value if x is not None)
            yield f  # Spark checks every filter again


class DatedFolders(DataSource):
    """``(d date)``, one row per date with data."""

    @classmethod
    def name(cls) -> str:
        return "dated_folders"

    def schema(self) -> str:
        return "d date"

    def reader(self, schema) -> DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else DatedFolderReader)(dict(self.options))


def read_dated_folders(
    spark: SparkSession, root: str, prefix: str = "", only: list[str] | None = None, *,
    slice_folders: int = SLICE, arrow: bool = True, lenient: bool = False,
) -> DataFrame:
    """``(d)``: dates whose folder holds data. ``only`` names the folders: dates or ``yyyy-MM-*``.

    A filter on ``d`` narrows the probing too, where the session has
    ``spark.sql.python.filterPushdown.enabled``. With ``arrow=False`` Spark's file index lists
    the files instead (any scheme that Spark reads).
    """
    if only is not None and not only:
        return spark.createDataFrame([], "d date")
    if not arrow:
        return _listed_by_spark(spark, root, prefix, only)
    spark.dataSource.register(DatedFolders)
    reader = spark.read.format("dated_folders").option("prefix", prefix).option("slice", slice_folders).option("lenient", lenient)
    reader = reader.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    if only is not None:
        reader = reader.option("only", json.dumps(sorted(set(only))))
    return reader.load(root)


def _listed_by_spark(spark: SparkSession, root: str, prefix: str, only: list[str] | None) -> DataFrame:
    """The same dates from Spark's file index; paths only, no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = f"{prefix}[0-9]*" if only is None else f"{prefix}{{{','.join(sorted(set(only)))}}}"
    if not (files.exists(path) and files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, names))):
        return spark.createDataFrame([], "d date")
    base = files.makeQualified(path).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{base}/{names}").select("path")
    # Paths are compared without their scheme: it may come back as file:/x or file:///x.
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", base)
    below = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    parts = F.split(F.substr(below, F.lit(len(bare) + 2)), "/")
    folder = F.when(F.size(parts) > 1, parts[0])
    text = F.when(folder.startswith(prefix), F.substr(folder, F.lit(len(prefix) + 1)))
    d = F.when(text.rlike(f"^{_DATE.pattern}$"), F.try_to_date(text, "yyyy-MM-dd"))
    return found.select(d.alias("d")).where("d IS NOT NULL").distinct()
