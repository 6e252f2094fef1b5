"""Calendar windows as Spark Column expressions.

A window is ``(n, unit)`` with ``n > 0`` and unit one of day/month/quarter/year,
anchored on a processing date ``d``.  Two shapes exist:

* contiguous (C1): every day from the start of the window to its end.
  ``day``: the n days ending on ``d``.  ``month``/``quarter``/``year``: from the
  first day of the period n-1 periods back to the **last day of the period
  containing d** (which may lie after ``d``).
* period-end (C2): ``day`` is the same ascending list; the other units give
  exactly n period-end dates, newest first.

All helpers accept Columns (or plain Python values, turned into literals), so
the same code builds a one-off scan predicate (Catalyst folds it to literal
dates, which then prune partitions) and a whole table of windows for many
datasets at once.  No UDFs are involved.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# The window units and the one-letter codes of the spec grammar.
UNITS = ("day", "month", "quarter", "year")
UNIT_LETTERS = {"d": "day", "m": "month", "q": "quarter", "y": "year"}

# Upper bound on days per period, used to size expected-date frames.
_MAX_DAYS = {"day": 1, "month": 31, "quarter": 92, "year": 366}

ColumnLike = Union[Column, str, int, _dt.date]


def _lit(x: ColumnLike) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.lit(x)
    return F.lit(x)


def _date(x: ColumnLike) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.to_date(F.lit(x))
    return F.lit(x)


@dataclass(frozen=True)
class WindowSpec:
    """A validated window: processing date, length and unit."""

    processing_date: _dt.date
    n: int
    unit: str

    @property
    def single_day(self) -> bool:
        return self.unit == "day" and self.n == 1


def validate_window(processing_date, n, unit: str) -> WindowSpec:
    """Check one window's arguments on the driver (C4); raise ``ValueError``.

    The date must be ISO ``YYYY-MM-DD`` (a ``datetime.date`` is accepted too),
    ``n`` a positive ``int`` (not a numeric string, not a bool) and the unit one
    of :data:`UNITS`.
    """
    if isinstance(processing_date, _dt.datetime):
        d = processing_date.date()
    elif isinstance(processing_date, _dt.date):
        d = processing_date
    elif isinstance(processing_date, str):
        try:
            d = _dt.datetime.strptime(processing_date, "%Y-%m-%d").date()
        except ValueError:
            raise ValueError(
                f"invalid processing date {processing_date!r}; expected YYYY-MM-DD"
            ) from None
    else:
        raise ValueError(f"invalid processing date {processing_date!r}; expected YYYY-MM-DD")
    if isinstance(n, bool) or not isinstance(n, int) or n <= 0:
        raise ValueError(f"invalid window length {n!r}; it must be a positive integer")
    if unit not in UNITS:
        raise ValueError(f"invalid window unit {unit!r}; must be one of {list(UNITS)}")
    return WindowSpec(d, n, unit)


def window_size_bound(n: int, unit: str, shape: str = "contiguous") -> int:
    """Largest number of dates a window can expand to (a proven size bound)."""
    if shape == "period_end" or unit == "day":
        return n
    return n * _MAX_DAYS[unit]


def window_bounds(d: ColumnLike, n: ColumnLike, unit: ColumnLike) -> tuple[Column, Column]:
    """``(start, end)`` of the contiguous window (C1) as date Columns.

    Rows whose unit is not one of :data:`UNITS` get NULL bounds.
    """
    d, n, unit = _date(d), _lit(n), _lit(unit)
    start = (
        F.when(unit == "day", F.date_sub(d, n - 1))
        .when(unit == "month", F.add_months(F.trunc(d, "month"), (n - 1) * -1))
        .when(unit == "quarter", F.add_months(F.trunc(d, "quarter"), (n - 1) * -3))
        .when(unit == "year", F.make_date(F.year(d) - (n - 1), F.lit(1), F.lit(1)))
    )
    end = (
        F.when(unit == "day", d)
        .when(unit == "month", F.last_day(d))
        .when(unit == "quarter", F.last_day(F.add_months(F.trunc(d, "quarter"), 2)))
        .when(unit == "year", F.make_date(F.year(d), F.lit(12), F.lit(31)))
    )
    return start, end


def contiguous_dates(d: ColumnLike, n: ColumnLike, unit: ColumnLike) -> Column:
    """Ascending ``array<date>`` of every day in the contiguous window."""
    start, end = window_bounds(d, n, unit)
    return F.sequence(start, end)


def period_end_dates(d: ColumnLike, n: ColumnLike, unit: ColumnLike) -> Column:
    """``array<date>`` of the period-end window (C2), in the reference order.

    ``day`` is ascending; ``month``/``quarter``/``year`` give n period ends,
    newest first.  Keep the array position when exploding: the order is part
    of the result.
    """
    d, n, unit = _date(d), _lit(n), _lit(unit)
    back = F.sequence(F.lit(0), n - 1)
    return (
        F.when(unit == "day", F.sequence(F.date_sub(d, n - 1), d))
        .when(unit == "month", F.transform(back, lambda i: F.last_day(F.add_months(d, -i))))
        .when(
            unit == "quarter",
            F.transform(back, lambda i: F.last_day(F.add_months(F.trunc(d, "quarter"), 2 - i * 3))),
        )
        .when(unit == "year", F.transform(back, lambda i: F.make_date(F.year(d) - i, F.lit(12), F.lit(31))))
    )


def window_dates(d: ColumnLike, n: ColumnLike, unit: ColumnLike, shape: ColumnLike) -> Column:
    """C2 for ``shape == 'period_end'`` (dated folders), else C1."""
    shape = _lit(shape)
    return F.when(shape == "period_end", period_end_dates(d, n, unit)).otherwise(
        contiguous_dates(d, n, unit)
    )


def window_valid(n: ColumnLike, unit: ColumnLike) -> Column:
    """Per-row form of C4 for a table of window specs."""
    n, unit = _lit(n), _lit(unit)
    return n.isNotNull() & (n > 0) & unit.isin(*UNITS)


def is_valid_iso_date(s: ColumnLike) -> Column:
    """Does the text parse as ``%Y-%m-%d`` the way Python's ``strptime`` does?

    Four-digit year (>= 1), month 1-12 with optional leading zero, day 1-31
    with an optional leading zero or space, and the day must exist in that
    month.  NULL or non-text gives false.
    """
    s = _lit(s).cast("string")
    pattern = r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"
    y = F.regexp_extract(s, pattern, 1)
    m = F.regexp_extract(s, pattern, 2)
    dd = F.trim(F.regexp_extract(s, pattern, 3))
    padded = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(dd, 2, "0"))
    ok = (
        s.rlike(pattern)
        & (y != "0000")
        & F.try_to_date(padded, "yyyy-MM-dd").isNotNull()
    )
    return F.coalesce(ok, F.lit(False))


def _is_timestamp(dt: DataType | None) -> bool:
    return isinstance(dt, (TimestampType, TimestampNTZType))


def window_predicate(column: str, spec: WindowSpec, data_type: DataType | None = None) -> Column:
    """The filter that selects a window from a date (or timestamp) column.

    ``col = d`` for a one-day window, else ``start <= col <= end``.  The bounds
    are Column expressions over literals, which Catalyst folds to constant
    dates, so the predicate reaches the scan as ``PartitionFilters`` (for a
    partition column) or ``PushedFilters`` (for a data column).

    For a timestamp column the day bounds become ``[start 00:00, end+1 00:00)``
    so rows after midnight of the last day are kept while the comparison
    stays on the bare column (and keeps pushing down).
    """
    start, end = window_bounds(F.lit(spec.processing_date), F.lit(spec.n), F.lit(spec.unit))
    c = F.col(column)
    if _is_timestamp(data_type):
        ts = "timestamp_ntz" if isinstance(data_type, TimestampNTZType) else "timestamp"
        lo = start.cast(ts)
        hi = F.date_add(end, 1).cast(ts)
        return (c >= lo) & (c < hi)
    if spec.single_day:
        return c == F.lit(spec.processing_date)
    return (c >= start) & (c <= end)
