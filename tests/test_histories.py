"""As-of lookups, spans of dates, exact and equality deletes, windows as rows, folded logs, order of steps, Newton steps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import evaluate, joins, runlog, spans, table_format as tf
from daybook.operators.asof import as_of
from daybook.plans.steps import Step, in_dependency_order
from daybook.queries import registry
from tests.conftest import SMALL

DAY = dt.date(2024, 1, 1)


def day(k):
    return DAY + dt.timedelta(days=k)


# --- as-of ---------------------------------------------------------------------------

@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_as_of_matches_brute_force(spark, grain):
    draw = random.Random(4)
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randrange(24 * 200)) for _ in range(80)]
    log = [(draw.choice(["a", "b", None]), t, draw.randrange(5), f"f{draw.randrange(9)}") for t in times[:40]] + [("a", None, 9, "x")]
    asks = [(i, draw.choice(["a", "b", "c", None]), draw.choice(times)) for i in range(60)] + [(99, "a", None), (98, "a", times[0]), (98, "a", times[0])]
    got = as_of(
        spark.createDataFrame(asks, "id int, k string, t timestamp"), spark.createDataFrame(log, "k string, at timestamp, n int, f string"),
        "t", "at", ["n", "f"], by=["k"], grain=grain,
    )
    assert got.columns == ["id", "k", "t", "n", "f"]
    want = []
    for i, k, t in asks:
        held = [(at, (n, f)) for kk, at, n, f in log if k is not None and kk == k and at is not None and t is not None and at <= t]
        want.append((i, k, t, *(max(held)[1] if held else (None, None))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_as_of_without_keys_and_empty_sides(spark):
    asks = spark.createDataFrame([(day(3),), (day(0),)], "t date")
    log = spark.createDataFrame([(day(1), 7), (day(3), 8), (day(3), 6)], "at date, v int")
    assert sorted(map(tuple, as_of(asks, log, "t", "at", ["v"]).collect())) == [(day(0), None), (day(3), 8)]
    assert sorted(map(tuple, as_of(asks, log.limit(0), "t", "at", ["v"]).collect())) == [(day(0), None), (day(3), None)]
    assert as_of(asks.limit(0), log, "t", "at", ["v"]).count() == 0
    with pytest.raises(ValueError, match="in the way"):
        as_of(asks.withColumn("v", F.lit(1)), log, "t", "at", ["v"])


def test_metadata_log_and_snapshots(spark):
    docs = spark.createDataFrame([
        ("v1", 1_000, 1, [(1, "l1")], []), ("v2", 5_000, 2, [(1, "l1"), (2, "l2")], [("v1", 1_000)]), ("v3", 9_000, 1, [(1, "l1"), (2, "l2")], [("v1", 1_000), ("v2", 5_000)]),
    ], "`metadata-file` string, `last-updated-ms` long, `current-snapshot-id` long, snapshots array<struct<`snapshot-id`: long, `manifest-list`: string>>, `metadata-log` array<struct<`metadata-file`: string, `timestamp-ms`: long>>")
    log = tf.metadata_log_of(docs)
    assert sorted(r["file"] for r in log.collect()) == ["v1", "v2", "v3"]
    asks = spark.sql("SELECT timestamp_millis(ms) AS t, ms FROM VALUES (999L), (1000L), (6000L), (9001L) AS v(ms)")
    got = {r["ms"]: (r["snapshot_id"], r["manifest_list"]) for r in tf.snapshots_as_of(asks, "t", log, docs).collect()}
    assert got == {999: (None, None), 1000: (1, "l1"), 6000: (2, "l2"), 9001: (1, "l1")}  # rolled back


# --- spans ---------------------------------------------------------------------------

def test_spans_and_missing_counts(spark):
    draw = random.Random(1)
    held = sorted({draw.randrange(120) for _ in range(70)})
    inv = spark.createDataFrame([(day(k),) for k in held + held[:5]] + [(None,)], "d date")
    islands = [tuple(r) for r in spans.date_spans(inv).orderBy("first").collect()]
    flat = [day(k) for k in held]
    assert sum(n for *_, n in islands) == len(held) and all(a - dt.timedelta(days=1) not in flat and b + dt.timedelta(days=1) not in flat for a, b, _ in islands)
    gaps = [tuple(r) for r in spans.date_gaps(inv).orderBy("first").collect()]
    assert sum(n for *_, n in gaps) == held[-1] - held[0] + 1 - len(held) and len(gaps) == len(islands) - 1
    windows = [(day(a), day(a + n)) for a in range(-5, 130, 3) for n in (-2, 0, 1, 30, 200)] + [(None, day(1)), (day(1), None)]
    got = spans.missing_counts(spark.createDataFrame(windows, "lo date, hi date"), inv).collect()
    assert len(got) == len(windows)
    for r in got:
        if r["lo"] is None or r["hi"] is None:
            assert r["n_expected"] is None and r["n_missing"] is None
        else:
            n = max(0, (r["hi"] - r["lo"]).days + 1)
            assert r["n_expected"] == n and r["n_missing"] == n - sum(r["lo"] <= d <= r["hi"] for d in flat), r
    none = spans.missing_counts(spark.createDataFrame(windows[2:4], "lo date, hi date"), inv.limit(0)).collect()
    assert all(r["n_missing"] == r["n_expected"] for r in none)


# --- deletes -------------------------------------------------------------------------

def test_bitmaps_count_distinct_positions(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "b", "c"]), draw.choice([0, 1, 32_767, 32_768, 32_769, 10**6, draw.randrange(100)])) for _ in range(400)] + [("a", None), (None, 3)]
    df = spark.createDataFrame(rows, "file_path string, pos long")
    one, two = tf.deleted_positions(df.where("pos % 2 = 0")), tf.deleted_positions(df)
    got = {r["file_path"]: r["n_deleted"] for r in tf.deleted_counts(tf.merged_positions(one, two)).collect()}
    assert got == {f: len({p for g, p in rows if g == f and p is not None}) for f in "abc"}


def test_live_rows(spark):
    entry = "status int, data_file struct<content: int, file_path: string, partition: struct<d: date>, record_count: long>"
    rows = [(1, (0, "a", (day(1),), 3)), (0, (0, "b", (day(1),), 2)), (1, (0, "c", (day(2),), 1)), (2, (0, "b", (day(1),), 2)), (1, (0, "e", (day(3),), 4)), (1, (1, "x", (None,), 4))]
    deletes = spark.createDataFrame([("a", 0), ("a", 0), ("c", 0), ("z", 1)], "file_path string, pos long")
    got = tf.live_rows(spark.createDataFrame(rows, entry), "d", tf.deleted_positions(deletes)).collect()
    assert sorted(map(tuple, got)) == [(day(1), 1, 2), (day(3), 1, 4)]


@pytest.mark.parametrize("spread", [1, 3])
def test_equality_deletes(spark, spread):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, None]), draw.choice(["x", None]), draw.choice([None, *range(9)]), i) for i in range(200)]
    deletes = [(draw.choice([1, 3, None]), draw.choice(["x", None]), draw.randrange(9)) for _ in range(6)]
    schema = "k int, `_k` string, sequence int, salt int"
    got = tf.drop_equal(
        spark.createDataFrame(rows, schema), spark.createDataFrame(deletes, "k int, `_k` string, sequence int"), ["k", "_k"], spread=spread)
    assert got.columns == ["k", "_k", "sequence", "salt"]
    want = [r for r in rows if not any(d[:2] == r[:2] and r[2] is not None and d[2] > r[2] for d in deletes)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and 0 < len(want) < 200
    none = tf.drop_equal(spark.createDataFrame(rows, schema), spark.createDataFrame([], "k int, `_k` string, sequence int"), ["k", "_k"], spread=spread)
    assert none.count() == 200


# --- layouts -------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_as_rows_prune_at_run_time(spark):
    df = registry.scan_windows_table(spark, SMALL)
    assert "dynamicpruning" in df._jdf.queryExecution().sparkPlan().toString()


def test_windows_table(spark, scratch):
    from daybook.sinks.files import write_partitioned
    from daybook.sources.partitioned import read_windows

    root = scratch("w")
    write_partitioned(spark.createDataFrame([(k, day(k)) for k in range(40)], "id int, d date"), root, "d")
    specs = [(day(10), 3, "day"), (day(11), 2, "day"), (day(30), 0, "day"), (day(30), 2, "week"), (None, 2, "day"), (day(35), 1, "day"), (day(35), None, "day")]
    specs = spark.createDataFrame(specs, "processing_date date, n int, unit string")
    assert sorted(r["id"] for r in read_windows(spark, root, "d", specs).collect()) == [8, 9, 10, 11, 35]
    assert read_windows(spark, root, "d", specs.limit(0)).count() == 0
    ends = read_windows(spark, root, "d", spark.createDataFrame([(day(35), 2, "month")], specs.schema), shape="period_end")
    assert sorted(r["id"] for r in ends.collect()) == [30]


def test_bucketed_joins_have_no_exchange(spark):
    for q in (registry.join_primary_bucketed, registry.join_feature_bucketed):
        df = q(spark, SMALL)
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
        df.count()
        assert "Exchange" not in plan(df)
    a, b = registry.join_primary(spark, SMALL), registry.join_primary_bucketed(spark, SMALL)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_bucketed_null_and_hot_keys(spark, scratch):
    from daybook.session import scratch_table_name
    from daybook.sinks.catalog import save_bucketed

    rows = spark.createDataFrame([(1, i) for i in range(500)] + [(None, 1), (2, 2)], "k int, v int")
    left, right = scratch_table_name("l"), scratch_table_name("r")
    save_bucketed(rows, left, "k", 4, location=scratch("l"))
    save_bucketed(spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int"), right, ["k"], 4, location=scratch("r"))
    out = joins.join_on_date(spark.read.table(left), spark.read.table(right), "k", "k", strategy="merge")
    assert out.count() == 1000 and "Exchange" not in plan(out)


# --- folded logs -----------------------------------------------------------------------

def test_folded_log_takes_late_and_repeated_events(spark, scratch):
    import time

    log = runlog.FoldedLog(spark, scratch("log"), "k string, at int, v int", ["k"], ["at"], margin_ms=0)
    rows = [("a", 5, 1), ("b", 3, 2)]
    log.append(spark.createDataFrame(rows, "k string, at int, v int"))
    assert log.marks() == [] and sorted(map(tuple, log.state().collect())) == rows
    mark = log.snapshot()
    time.sleep(0.01)
    late = [("c", 1, 9), ("b", 4, 3), ("a", 4, 7), ("a", 5, 1)]  # a new key and a newer one, both older than the snapshot's newest; an old one; a repeat
    log.append(spark.createDataFrame(late, "k string, at int, v int"))
    want = [("a", 5, 1), ("b", 4, 3), ("c", 1, 9)]
    assert sorted(map(tuple, log.state().collect())) == want
    assert log.events(mark).count() == 4 and log.events().count() == 6
    assert log.snapshot() > mark and sorted(map(tuple, log.state().collect())) == want
    assert log.events(log.marks()[-1]).count() == 0
    wide = runlog.FoldedLog(spark, log.root, log.schema, ["k"], ["at"])  # a margin folds events again: same state
    assert wide.events(log.marks()[-1] - wide.margin_ms).count() == 6 and sorted(map(tuple, wide.state().collect())) == want


def test_run_log_compacts(spark, scratch):
    log = runlog.RunLog(spark, scratch("runlog"))
    for status in ("RUNNING", "SUCCESS"):
        log.append_step(run_id="r", seq=0, name="s", func="f", status=status, start_time="2024-01-01 00:00:00")
        log.append_run(run_id="r", status=status, start_time="2024-01-01 00:00:00")
        log.compact()
    log.append_step(run_id="r", seq=1, name="t", func="f", status="SKIP", start_time="2024-01-01 00:00:01")
    assert {(r["name"], r["status"]) for r in log.steps().collect()} == {("s", "SUCCESS"), ("t", "SKIP")}
    assert [r["status"] for r in log.runs().collect()] == ["SUCCESS"] and log.report("r").count() == 2
    log.record_metrics("r", evaluate.run_metrics(spark.createDataFrame([([1.0, 2.0], 1)], "x array<double>, y int"), "x", "y", {"solver": "newton", "rounds": 12}))
    got = {r["metric"]: (r["value"], r["text"]) for r in log.metrics("r").collect()}
    assert got["solver"] == (None, "newton") and got["rounds"] == (12.0, None) and got["n_features"] == (2.0, None)
    log.record_metrics("q", spark.createDataFrame([("m", 1.0)], "metric string, value double"))
    assert [tuple(r)[1:] for r in log.metrics("q").collect()] == [("m", 1.0, None)]


# --- order of steps ------------------------------------------------------------------

def step(name, reads, writes):
    return Step(name, lambda *a: None, reads, writes)


def test_steps_run_after_what_they_read():
    a, b, c, d = step("a", "raw:5d", "x:5d"), step("b", ["x:1m", "params:p"], "y"), step("c", {"one": "y:1d", "two": "x"}, "z:1d"), step("d", None, "q")
    order = [s.name for s in in_dependency_order([c, b, d, a])]
    assert order.index("a") < order.index("b") < order.index("c") and set(order) == set("abcd")
    assert [s.name for s in in_dependency_order([a, b, c, d])] != [] and in_dependency_order([]) == []
    first, second = step("first", "raw", "x"), step("second", "raw", "x")
    assert [s.name for s in in_dependency_order([b, first, second])] == ["first", "second", "b"]
    with pytest.raises(ValueError, match=r"\['p', 'q'\] wait for each other"):
        in_dependency_order([step("p", "n", "m"), step("q", "m", "n"), a])


# --- Newton steps --------------------------------------------------------------------

def test_newton_sums_match_plain_python(spark):
    import numpy as np

    draw = np.random.default_rng(3)
    x, y, w = draw.normal(size=(50, 3)), draw.integers(0, 3, 50), draw.normal(size=(3, 4))
    train = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(3)
    got = {(r["k"], r["j"]): (r["g"], r["c"]) for r in evaluate.newton_sums(train, w.tolist(), [0, 1, 2]).collect()}
    g, c = np.zeros((3, 4)), np.zeros((3, 4))
    for a, b in zip(x, y):
        a = np.append(a, 1.0)
        p = np.exp(w @ a) / np.exp(w @ a).sum()
        g += np.outer(p - (np.arange(3) == b), a)
        c += np.outer(p * (1 - p), a * a)
    assert all(np.allclose(got[k, j], (g[k, j], c[k, j])) for k in range(3) for j in range(4)) and len(got) == 12


def test_newton_agrees_with_the_other_solver(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    w, a = evaluate.train_newton(e, "embedding", "label", "vec_id")
    _, b = evaluate.train_logistic(e, "embedding", "label", "vec_id")
    a, b = ({r["vec_id"]: int(r["_prediction"]) for r in x.collect()} for x in (a, b))
    assert len(w) == 10 and a.keys() == b.keys() and sum(a[k] == b[k] for k in a) >= 0.98 * len(a)
    none, pred = evaluate.train_newton(e.limit(0), "embedding", "label", "vec_id")
    assert none == {} and pred.count() == 0
