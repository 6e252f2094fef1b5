"""C1-C5 against an independent Python calendar, plus the edge cases of FIXTURES §4."""

import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.functions.calendar import (
    contiguous_dates,
    is_valid_iso_date,
    period_end_dates,
    validate_window,
    window_predicate,
)


def _month_add(d: dt.date, k: int) -> tuple[int, int]:
    m = d.year * 12 + (d.month - 1) + k
    return m // 12, m % 12 + 1


def _last(y, m):
    return dt.date(y, m, calendar.monthrange(y, m)[1])


def ref_contiguous(d, n, unit):
    if unit == "day":
        lo, hi = d - dt.timedelta(days=n - 1), d
    elif unit == "month":
        y, m = _month_add(d, -(n - 1))
        lo, hi = dt.date(y, m, 1), _last(d.year, d.month)
    elif unit == "quarter":
        qm = (d.month - 1) // 3 * 3 + 1
        y, m = _month_add(dt.date(d.year, qm, 1), -3 * (n - 1))
        lo, hi = dt.date(y, m, 1), _last(d.year, qm + 2)
    else:
        lo, hi = dt.date(d.year - (n - 1), 1, 1), dt.date(d.year, 12, 31)
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def ref_period_end(d, n, unit):
    if unit == "day":
        return [d - dt.timedelta(days=n - 1 - i) for i in range(n)]
    out = []
    for i in range(n):
        if unit == "month":
            out.append(_last(*_month_add(d, -i)))
        elif unit == "quarter":
            y, m = _month_add(d, -3 * i)
            out.append(_last(y, (m - 1) // 3 * 3 + 3))
        else:
            out.append(dt.date(d.year - i, 12, 31))
    return out


def test_windows_match_python_calendar(spark):
    rng = random.Random(7)
    start = dt.date(2023, 1, 1)
    cases = []
    for _ in range(600):
        d = start + dt.timedelta(days=rng.randrange(0, 900))
        cases.append((d, rng.choice([1, 2, 3, 5, 12]), rng.choice(["day", "month", "quarter", "year"])))
    # every month end and leap day explicitly
    for y in (2023, 2024):
        for m in range(1, 13):
            for unit in ("day", "month", "quarter", "year"):
                cases.append((_last(y, m), 3, unit))
    df = spark.createDataFrame(cases, "d date, n int, unit string")
    got = df.select(
        "d", "n", "unit",
        contiguous_dates(F.col("d"), F.col("n"), F.col("unit")).alias("c"),
        period_end_dates(F.col("d"), F.col("n"), F.col("unit")).alias("p"),
    ).collect()
    assert len(got) == len(cases)
    for r in got:
        assert list(r["c"]) == ref_contiguous(r["d"], r["n"], r["unit"]), (r["d"], r["n"], r["unit"])
        assert list(r["p"]) == ref_period_end(r["d"], r["n"], r["unit"]), (r["d"], r["n"], r["unit"])


@pytest.mark.parametrize(
    "d,n,unit,first,last,count",
    [
        ("2025-01-01", 5, "day", "2024-12-28", "2025-01-01", 5),
        ("2025-01-01", 1, "month", "2025-01-01", "2025-01-31", 31),
        ("2024-05-15", 2, "quarter", "2024-01-01", "2024-06-30", 182),
        ("2024-02-29", 2, "year", "2023-01-01", "2024-12-31", 731),
    ],
)
def test_contiguous_edge_cases(spark, d, n, unit, first, last, count):
    r = spark.range(1).select(contiguous_dates(d, n, unit).alias("c")).first()["c"]
    assert (str(r[0]), str(r[-1]), len(r)) == (first, last, count)


@pytest.mark.parametrize(
    "d,n,unit,expected",
    [
        ("2024-03-31", 3, "month", ["2024-03-31", "2024-02-29", "2024-01-31"]),
        ("2024-05-15", 3, "quarter", ["2024-06-30", "2024-03-31", "2023-12-31"]),
        ("2024-05-15", 2, "year", ["2024-12-31", "2023-12-31"]),
        ("2025-01-03", 3, "day", ["2025-01-01", "2025-01-02", "2025-01-03"]),
    ],
)
def test_period_end_edge_cases(spark, d, n, unit, expected):
    r = spark.range(1).select(period_end_dates(d, n, unit).alias("p")).first()["p"]
    assert [str(x) for x in r] == expected


@pytest.mark.parametrize(
    "d,n,unit",
    [("2025-01-01", 0, "day"), ("2025-01-01", -1, "day"), ("2025-01-01", "5", "day"),
     ("2025-01-01", 1, "week"), ("2025/01/01", 1, "day"), ("2025-02-30", 1, "day"), ("2025-01-01", True, "day")],
)
def test_validate_window_rejects(d, n, unit):
    with pytest.raises(ValueError):
        validate_window(d, n, unit)


def test_iso_date_check_matches_strptime(spark):
    texts = [
        "2025-01-01", "2025-1-1", "2025-02-30", "2024-02-29", "2023-02-29", "2025-01-01x", "2025-01-01 ",
        " 2025-01-01", "", "2025/01/01", "0000-01-01", "0001-01-01", "20250-1-1", "2025-13-01", "2025-00-10",
        "2025-1-31", "2025-04-31", "2025-12-31", "abcd-ef-gh", "2025-01-1", "2025-001-01",
        "2025-01- 5", "2025-1- 5", "2025- 1-05", "2025-01-  5", "2025-02- 9",
    ]

    def py(s):
        try:
            dt.datetime.strptime(s, "%Y-%m-%d")
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s string")
    got = {r["s"]: r["v"] for r in df.select("s", is_valid_iso_date(F.col("s")).alias("v")).collect()}
    for t in texts:
        assert got[t] == py(t), t
    assert got[None] is False


def test_window_predicate_prunes_partitions(spark, scratch):
    from daybook.sinks.files import write_partitioned
    from daybook.sources.partitioned import read_partitioned

    root = scratch("ev")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("processed_date", F.to_date("ts"))
    write_partitioned(e, root, "processed_date")
    df = read_partitioned(spark, root, partition_column="processed_date", processing_date="2024-01-15", n=5)
    assert "PartitionFilters: [isnotnull(processed_date" in df._jdf.queryExecution().executedPlan().toString()
    # The plan's text is cut at 100 characters: the files listed and the whole filter are looked at instead.
    assert {f.split("processed_date=")[1][:10] for f in df.inputFiles()} == {f"2024-01-{d}" for d in range(11, 16)}
    condition = df._jdf.queryExecution().optimizedPlan().condition().sql()
    assert "DATE '2024-01-11'" in condition and "DATE '2024-01-15'" in condition
    single = read_partitioned(spark, root, partition_column="processed_date", processing_date="2024-01-15", n=1)
    assert "(processed_date" in single._jdf.queryExecution().executedPlan().toString()
    assert single.count() == e.where("processed_date = date'2024-01-15'").count()


def test_timestamp_window_keeps_last_day(spark):
    spec = validate_window("2024-01-15", 5, "day")
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    pred = window_predicate("ts", spec, e.schema["ts"].dataType)
    assert e.where(pred).count() == 1678
    plan = e.where(pred)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
