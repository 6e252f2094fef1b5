"""Completeness of a whole table of windows from spans of the inventory.

The dates of an inventory are numbered once, in date order. A contiguous window
``[lo, hi]`` then lacks ``(hi - lo + 1) - (N(hi) - N(lo - 1))`` dates, where
``N(x)`` is the number of inventory dates up to ``x``: two as-of lookups per
window, however long it is. No window is exploded into its dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.asof import as_of


def numbered_dates(inventory: DataFrame) -> DataFrame:
    """``(d, nth)``: the distinct dates with their number from 1, in date order.

    Numbered month by month; the months' totals (a row per month) are added up apart.
    """
    dates = inventory.select(F.col("d").cast("date").alias("d")).where("d IS NOT NULL").distinct().withColumn("m", F.trunc("d", "month"))
    totals = dates.groupBy("m").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("m", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("m").orderBy("d"))
    return dates.withColumn("k", nth).join(offsets, "m").select("d", (F.col("k") + F.col("before")).cast("bigint").alias("nth"))


def date_spans(inventory: DataFrame) -> DataFrame:
    """``(first, last, n_dates)``: the islands of consecutive dates.

    Inside an island a date and its number rise together, so their difference names it.
    """
    dates = numbered_dates(inventory)
    island = F.date_sub("d", F.col("nth").cast("int"))
    return dates.groupBy(island.alias("island")).agg(
        F.min("d").alias("first"), F.max("d").alias("last"), F.count("*").alias("n_dates")
    ).drop("island")


def date_gaps(inventory: DataFrame) -> DataFrame:
    """``(first, last, n_dates)``: the stretches of absent dates between two islands."""
    dates = numbered_dates(inventory)
    follows = dates.select((F.col("nth") - 1).alias("nth"), F.col("d").alias("then"))
    gaps = dates.join(follows, "nth").where(F.datediff("then", "d") > 1)
    return gaps.select(
        F.date_add("d", 1).alias("first"), F.date_sub("then", 1).alias("last"), (F.datediff("then", "d") - 1).cast("bigint").alias("n_dates")
    )


def missing_counts(windows: DataFrame, inventory: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    """``windows`` with ``n_expected`` and ``n_missing`` dates of each contiguous window ``[low, high]``.

    A window with a null bound has nulls; one that ends before it starts expects nothing.
    """
    dates = numbered_dates(inventory)
    upto = dates.select(F.col("d").alias("at"), F.col("nth").alias("n_high"))
    below = dates.select(F.col("d").alias("at"), F.col("nth").alias("n_below"))
    out = windows.withColumn("_below", F.date_sub(low, 1))
    out = as_of(out, upto, high, "at", ["n_high"])
    out = as_of(out, below, "_below", "at", ["n_below"])
    size = F.greatest(F.datediff(high, low) + 1, F.lit(0)).cast("bigint")
    held = F.greatest(F.coalesce("n_high", F.lit(0)) - F.coalesce("n_below", F.lit(0)), F.lit(0))
    known = F.col(low).isNotNull() & F.col(high).isNotNull()
    return out.select(*windows.columns, F.when(known, size).alias("n_expected"), F.when(known, size - held).cast("bigint").alias("n_missing"))
