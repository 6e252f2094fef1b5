"""Decision table and the gated runner with its run log."""

import pytest
from pyspark.sql import functions as F

from daybook.operators import gating
from daybook.operators.runlog import RunLog
from daybook.plans import Dataset, GatedRunner, Step
from daybook.plans.steps import datasets_table, specs_table
from daybook.sinks.files import write_partitioned


@pytest.fixture()
def events_root(spark, scratch):
    root = scratch("ev")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("processed_date", F.to_date("ts"))
    write_partitioned(e, root, "processed_date")
    return root


def _decide(spark, steps, dsets, date):
    specs = specs_table(spark, steps)
    dt_ = datasets_table(spark, dsets)
    return {r["step"]: (r["decision"], r["reason"], list(r["missing_inputs"]))
            for r in gating.gate_decision(specs, dt_, gating.inventory_for(spark, dt_), date).collect()}


def test_decision_table(spark, scratch, events_root):
    nothing = scratch("nothing")
    dsets = [
        Dataset("ev", "partitioned", events_root, "processed_date"),
        Dataset("ev_free", "partitioned", events_root, "processed_date", validate=False),
        Dataset("none", "partitioned", nothing, "processed_date"),
    ]
    f = lambda x: x
    steps = [
        Step("complete_in_missing_out", f, "ev:5d", "none:5d"),
        Step("missing_in", f, "ev:1m", "none:1m"),
        Step("unvalidated_in_complete_out", f, "ev_free:1m", "ev:3d"),
        Step("both_incomplete_input_wins", f, ["ev:1m", "none:2d"], "ev:3d"),
        Step("no_window_out", f, "ev:2d", "ev"),
        Step("no_window_in", f, "none", "none:1d"),
    ]
    got = _decide(spark, steps, dsets, "2024-01-15")
    assert got["complete_in_missing_out"] == ("RUN", None, [])
    assert got["missing_in"] == ("SKIP", "inputs", ["ev"])
    assert got["unvalidated_in_complete_out"] == ("SKIP", "outputs", [])
    assert got["both_incomplete_input_wins"] == ("SKIP", "inputs", ["ev", "none"])
    assert got["no_window_out"] == ("RUN", None, [])
    assert got["no_window_in"] == ("RUN", None, [])


def test_runner_runs_skips_and_logs(spark, scratch, events_root):
    stage, clicks = scratch("stage"), scratch("clicks")
    dsets = [
        Dataset("raw", "partitioned", events_root, "processed_date"),
        Dataset("stage", "partitioned", stage, "processed_date"),
        Dataset("clicks", "partitioned", clicks, "processed_date"),
    ]
    steps = [
        Step("copy", lambda df: df, "raw:5d", "stage:5d"),
        Step("month", lambda df: df, "raw:1m", "stage:1m"),
        Step("clicks", lambda df: df.where("event_type = 'click'"), {"df": "stage:3d"}, "clicks:3d"),
    ]
    log = RunLog(spark, scratch("log"))
    runner = GatedRunner(spark, dsets, log)
    first = {r["step"]: r["status"] for r in runner.run(steps, "2024-01-15", run_id="a").collect()}
    assert first == {"copy": "SUCCESS", "month": "SKIP", "clicks": "SUCCESS"}
    assert spark.read.parquet(stage).select("processed_date").distinct().count() == 5
    assert spark.read.parquet(clicks).select("processed_date").distinct().count() <= 3
    second = {r["step"]: (r["status"], r["reason"]) for r in runner.run(steps, "2024-01-15", run_id="b").collect()}
    assert second == {"copy": ("SKIP", "outputs"), "month": ("SKIP", "inputs"), "clicks": ("SKIP", "outputs")}
    rep = log.report("a").collect()
    assert [r["name"] for r in rep] == ["copy", "month", "clicks"]
    events = log.step_events().where("run_id = 'a' AND name = 'copy'").orderBy("event_seq")
    assert [r["status"] for r in events.collect()] == ["RUNNING", "SUCCESS"]   # start and finish, folded per key
    assert {r["run_id"]: r["status"] for r in log.runs().collect()} == {"a": "SUCCESS", "b": "SUCCESS"}


def test_runner_failure_is_logged_and_raised(spark, scratch, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("out", "partitioned", scratch("out"), "processed_date")]

    def boom(df):
        raise RuntimeError("bad step")

    log = RunLog(spark, scratch("log"))
    with pytest.raises(RuntimeError, match="bad step"):
        GatedRunner(spark, dsets, log).run([Step("boom", boom, "raw:2d", "out:2d")], "2024-01-15", run_id="x")
    r = log.steps().first()
    assert r["status"] == "ERROR" and "bad step" in r["detail"]


def test_wrong_number_of_outputs(spark, scratch, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("a", "partitioned", scratch("a"), "processed_date"),
             Dataset("b", "partitioned", scratch("b"), "processed_date")]
    with pytest.raises(ValueError, match="returned 1 frame"):
        GatedRunner(spark, dsets).run([Step("two", lambda df: df, "raw:1d", ["a:1d", "b:1d"])], "2024-01-15")


def test_undeclared_input_rejected(spark, scratch, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("out", "partitioned", scratch("out"), "processed_date")]
    with pytest.raises(ValueError, match="ghost"):
        GatedRunner(spark, dsets).run([Step("s", lambda a, b: a, ["raw:1d", "ghost:1d"], "out:1d")], "2024-01-15")


def test_dataset_declaration_checks():
    with pytest.raises(ValueError):
        Dataset("x", "weird", "/tmp/x")
    with pytest.raises(ValueError):
        Dataset("x", "partitioned", "/tmp/x", overwrite="some")
    assert not Dataset("x", "partitioned", "/tmp/x").checked and Dataset("x", "folder", "/tmp/x").checked


def test_unpartitioned_dataset_schema_and_parameters(spark, scratch):
    src, out, static = scratch("src"), scratch("out"), scratch("static")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").write.option("header", "true").csv(src)
    dsets = [
        Dataset("dim", "partitioned", src, file_format="csv", schema="id bigint, name string", options={"header": "true"}),
        Dataset("out", "partitioned", out),
        Dataset("by_name", "partitioned", static, "name", overwrite="static", validate=False),
    ]

    def keep(df, least):
        return df.where(F.col("id") >= least)

    steps = [
        Step("filter", keep, {"df": "dim:5d", "least": "params:least"}, "out:5d"),
        Step("split", lambda df: df, "out", "by_name"),
    ]
    with pytest.raises(ValueError, match="not given"):
        GatedRunner(spark, dsets).run(steps, "2024-01-15")
    for least, names in ((1, ["a", "b"]), (2, ["b"])):
        done = GatedRunner(spark, dsets, params={"least": least}).run(steps, "2024-01-15").collect()
        assert [r["status"] for r in done] == ["SUCCESS", "SUCCESS"]
        assert sorted(r["name"] for r in spark.read.parquet(static).collect()) == names
    assert dict(spark.read.parquet(out).dtypes) == {"id": "bigint", "name": "string"}


def test_undeclared_products_stop_the_run_before_it_starts(spark, scratch, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date")]
    with pytest.raises(ValueError, match="tmp"):
        GatedRunner(spark, dsets).run([Step("a", lambda df: df, "raw:1d", "tmp:1d"), Step("b", lambda df: df, "tmp:1d", "raw:1d")], "2024-01-15")


def test_unvalidated_inputs_are_not_listed(spark, events_root):
    from daybook.operators.gating import inventory_for
    from daybook.plans.steps import datasets_table, specs_table

    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"), Dataset("far", "partitioned", "ftp://nowhere/x", "d", validate=False)]
    steps = [Step("a", None, ["raw:2d", "far:3d"], "raw"), Step("b", None, ["far", "raw"], None)]
    inv = inventory_for(spark, datasets_table(spark, dsets), specs_table(spark, steps), "2024-01-15")
    assert sorted(str(r["d"]) for r in inv.collect()) == ["2024-01-14", "2024-01-15"]


def test_failing_gate_closes_the_log(spark, scratch):
    from daybook.operators.runlog import RunLog

    log = RunLog(spark, scratch("log"))
    dsets = [Dataset("far", "partitioned", "ftp://nowhere/x", "d")]
    with pytest.raises(Exception):
        GatedRunner(spark, dsets, log).run([Step("a", lambda df: None, "far:1d", None)], "2024-01-15")
    assert [r["status"] for r in log.runs().collect()] == ["ERROR"]
    assert [r["status"] for r in log.steps().collect()] == ["ERROR"]


def test_runner_without_log_and_dry_run(spark, scratch, events_root):
    out = scratch("out")
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("out", "partitioned", out, "processed_date")]
    steps = [Step("copy", lambda df: df, "raw:2d", "out:2d")]
    runner = GatedRunner(spark, dsets)          # logging off: no run-log writes at all
    plan = {r["step"]: r["decision"] for r in runner.plan(steps, "2024-01-15").collect()}
    assert plan == {"copy": "RUN"}
    assert [r["status"] for r in runner.run(steps, "2024-01-15").collect()] == ["SUCCESS"]
    assert {r["step"]: r["decision"] for r in runner.plan(steps, "2024-01-15").collect()} == {"copy": "SKIP"}


def test_step_may_not_overwrite_its_input(spark, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date")]
    with pytest.raises(ValueError, match="also reads"):
        GatedRunner(spark, dsets).run([Step("loop", lambda df: df, "raw:1d", "raw:1d")], "2024-01-15")


def test_windows_table(spark, scratch):
    dsets = [Dataset("f", "folder", scratch("f")), Dataset("p", "partitioned", scratch("p"), "processed_date")]
    steps = [Step("s", lambda a, b: a, ["f:2m", "p:3d"], "p:1d")]
    w = gating.windows(specs_table(spark, steps), datasets_table(spark, dsets), "2024-03-15")
    got = {(r["dataset"], r["pos"], str(r["d"])) for r in w.collect()}
    assert got == {("f", 0, "2024-03-31"), ("f", 1, "2024-02-29"),                        # input f:2m
                   ("p", 0, "2024-03-13"), ("p", 1, "2024-03-14"), ("p", 2, "2024-03-15"),  # input p:3d
                   ("p", 0, "2024-03-15")}                                                  # output p:1d


def test_runner_across_folder_partitioned_and_table(spark, scratch):
    """The reference's demo flow: raw dated folders → partitioned intermediate →
    catalog table joined with a mapping table, gated by windows."""
    import datetime as dt

    from daybook.operators.joins import join_on_date
    from daybook.session import scratch_table_name
    from daybook.sinks.catalog import save_table
    from tests.test_sources_sinks import raw_folders

    raw = raw_folders(spark, scratch("raw"))                      # 2025-01-01 … 04, 14 rows
    mapping = scratch_table_name("mapping")
    days = [dt.date(2025, 1, d) for d in (1, 2, 3, 3, 4)]         # 01-03 twice: rows multiply
    save_table(spark.createDataFrame([(d, d) for d in days], "created_at date, k date"), mapping,
               partition_by="k", location=scratch("mapping"))
    primary = scratch_table_name("primary")
    dsets = [
        Dataset("raw", "folder", raw),
        Dataset("intermediate", "partitioned", scratch("inter"), "processed_date"),
        Dataset("mapping", "table", mapping, "k"),
        Dataset("primary", "table", primary, "processed_date"),
    ]
    steps = [
        Step("raw_to_intermediate", lambda df: df, "raw:4d", "intermediate:4d"),
        Step("to_primary", lambda a, m: join_on_date(a, m), ["intermediate:4d", "mapping:4d"], "primary:4d"),
    ]
    runner = GatedRunner(spark, dsets)
    first = {r["step"]: r["status"] for r in runner.run(steps, "2025-01-04").collect()}
    assert first == {"raw_to_intermediate": "SUCCESS", "to_primary": "SUCCESS"}
    assert spark.table(primary).count() == 14 + 4                # the 4 rows of 01-03 appear twice
    again = {r["step"]: (r["status"], r["reason"]) for r in runner.run(steps, "2025-01-04").collect()}
    assert again == {"raw_to_intermediate": ("SKIP", "outputs"), "to_primary": ("SKIP", "outputs")}
    # the configured date of the reference: a 5-day raw window lacks 2024-12-28 … 31
    early = [Step("raw_to_intermediate", lambda df: df, "raw:5d", "intermediate:5d")]
    r = runner.run(early, "2025-01-01").first()
    assert (r["status"], r["reason"]) == ("SKIP", "inputs")


def test_output_check_error_means_incomplete_input_error_raises(spark, events_root):
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("broken", "partitioned", "nosuchfs://bucket/out", "processed_date")]
    runner = GatedRunner(spark, dsets)
    plan = {r["step"]: r["decision"] for r in runner.plan([Step("s", lambda df: df, "raw:1d", "broken:1d")], "2024-01-15").collect()}
    assert plan == {"s": "RUN"}
    with pytest.raises(Exception):
        runner.plan([Step("t", lambda df: df, "broken:1d", "raw:1d")], "2024-01-15").collect()


def test_step_without_inputs_or_outputs(spark, scratch, events_root):
    out = scratch("gen")
    dsets = [Dataset("raw", "partitioned", events_root, "processed_date"),
             Dataset("gen", "partitioned", out, "processed_date")]
    seen = []
    steps = [
        Step("generate", lambda: spark.read.parquet(events_root).where("processed_date = date'2024-01-15'"), None, "gen:1d"),
        Step("inspect", lambda df: seen.append(df.count()), "gen:1d", None),
        Step("side_effect_only", lambda: seen.append(-1), None, None),
    ]
    got = {r["step"]: r["status"] for r in GatedRunner(spark, dsets).run(steps, "2024-01-15").collect()}
    assert got == {"generate": "SUCCESS", "inspect": "SUCCESS", "side_effect_only": "SUCCESS"}
    assert seen and seen[0] > 0
