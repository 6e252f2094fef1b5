"""As-of lookups: the latest log entry at or before each asked time.

There is no range join. Asked times and log entries are put into one sorted
sequence and the last entry is carried forward. So that the sequence need not
pass through one task, time is cut into cells (months by default): inside a
cell a window carries the last entry forward, and what a cell starts with comes
from a table with one row per cell, whose size is bounded by the time span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_INNER = ("_t", "_cell", "_asked", "_entry", "_carry")


def as_of(
    asks: DataFrame, log: DataFrame, ask_time: str, log_time: str, values: Sequence[str],
    by: Sequence[str] = (), grain: str = "month",
) -> DataFrame:
    """Every row of ``asks`` with ``values`` of the latest row of ``log`` at or before its time.

    ``by`` names columns of both sides that have to agree (a null agrees with
    nothing). Rows without an earlier entry, or with a null time, get nulls. Of
    several entries at one time the greatest (by ``values``, in order) counts;
    entries with a null time do not. Equal rows of ``asks`` all come back.

    Each distinct asked time is looked up once; ``grain`` should be fine enough
    for the distinct times and entries of one cell to fit a task.
    """
    by, values = list(by), list(values)
    clash = sorted((set(asks.columns) & (set(values) | set(_INNER))) | (set(by) & set(values)))
    if clash:
        raise ValueError(f"columns {clash} are in the way of the looked-up values")
    entry = F.struct(*[F.col(v) for v in values])
    entries = log.where(F.col(log_time).isNotNull()).groupBy(*by, F.col(log_time).cast("timestamp").alias("_t")).agg(F.max(entry).alias("_entry"))
    times = asks.select(*by, F.col(ask_time).cast("timestamp").alias("_t")).where("_t IS NOT NULL").distinct()
    for c in by:
        times = times.where(F.col(c).isNotNull())
    blank = F.lit(None).cast(entries.schema["_entry"].dataType)
    both = entries.withColumn("_asked", F.lit(False)).unionByName(times.select("*", blank.alias("_entry"), F.lit(True).alias("_asked")))
    both = both.withColumn("_cell", F.date_trunc(grain, "_t"))

    last = both.groupBy(*by, "_cell").agg(F.max_by("_entry", F.when(~F.col("_asked"), F.col("_t"))).alias("_entry"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = last.select(*by, "_cell", F.last("_entry", ignorenulls=True).over(before).alias("_carry"))
    # An entry at the asked time itself counts: entries sort before asked times.
    upto = Window.partitionBy(*by, "_cell").orderBy("_t", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.join(starts, [*by, "_cell"]).withColumn("_entry", F.coalesce(F.last("_entry", ignorenulls=True).over(upto), F.col("_carry")))
    found = filled.where("_asked").select(*by, "_t", "_entry")
    keyed = asks.withColumn("_t", F.col(ask_time).cast("timestamp"))
    return keyed.join(found, [*by, "_t"], "left").select(*asks.columns, *[F.col(f"_entry.{v}").alias(v) for v in values])
