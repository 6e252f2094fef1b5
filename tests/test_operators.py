"""P5 live partitions, T1-T3 joins, L1-L6 run log, M2 metrics."""

import datetime as dt
import random

from pyspark.sql import functions as F


from daybook.operators import evaluate, joins, runlog, table_format


def _entries(spark, rows):
    return spark.createDataFrame(
        [(s, (c, p, (dt.date.fromisoformat(d),))) for s, c, p, d in rows],
        "status int, data_file struct<content:int, file_path:string, partition:struct<processed_date:date>>",
    )


def test_live_partitions_small(spark):
    entries = _entries(spark, [
        (1, 0, "a", "2025-01-01"),   # live
        (0, 0, "b", "2025-01-02"),   # removed below by status 2
        (2, 0, "b", "2025-01-02"),
        (1, 0, "c", "2025-01-03"),   # first row deleted → gone
        (1, 0, "d", "2025-01-03"),   # only a later row deleted → live
        (1, 1, "del1", "2025-01-03"),
    ])
    deletes = spark.createDataFrame([("c", 0), ("d", 5)], "file_path string, pos bigint")
    assert sorted(r[0] for r in table_format.delete_files(entries).collect()) == ["del1"]
    got = sorted(str(r[0]) for r in table_format.live_partitions(entries, "processed_date", deletes).collect())
    assert got == ["2025-01-01", "2025-01-03"]
    no_del = sorted(str(r[0]) for r in table_format.live_partitions(entries, "processed_date").collect())
    assert no_del == ["2025-01-01", "2025-01-03"]
    only_c = _entries(spark, [(1, 0, "c", "2025-01-03")])
    assert table_format.live_partitions(only_c, "processed_date", deletes).count() == 0


def test_metadata_steps(spark):
    log = spark.createDataFrame(
        [("m1.json", dt.datetime(2025, 1, 1)), ("m3.json", dt.datetime(2025, 1, 3)), ("m2.json", dt.datetime(2025, 1, 2))],
        "file string, timestamp timestamp",
    )
    assert table_format.latest_metadata_file(log).collect()[0]["file"] == "m3.json"
    assert table_format.latest_metadata_file(log.limit(0)).count() == 0
    meta = spark.createDataFrame(
        [(7, [(5, "ml5"), (7, "ml7")])],
        "`current-snapshot-id` bigint, snapshots array<struct<`snapshot-id`:bigint, `manifest-list`:string>>",
    )
    r = table_format.current_snapshot(meta).collect()
    assert [(x["snapshot_id"], x["manifest_list"]) for x in r] == [(7, "ml7")]


def test_join_keep_left_equals_plain_join(spark):
    rng = random.Random(3)
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(6)] + [None]
    left = spark.createDataFrame([(i, f"n{i}", rng.choice(days)) for i in range(300)], "id int, name string, processed_date date")
    right = spark.createDataFrame([(rng.choice(days), i) for i in range(80)], "created_at date, x int")
    third = spark.createDataFrame([(d,) for d in days[:4]] * 2, "processed_date date")
    plain = left.join(right, left.processed_date == right.created_at).select(left["*"])
    ours = joins.join_on_date(left, right, "processed_date", "created_at")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    plain3 = plain.join(third, "processed_date").select("id", "name", "processed_date")
    ours3 = joins.join_on_two_dates(left, right.withColumnRenamed("created_at", "primary_date"), third, mapping_bound=10)
    assert sorted(map(tuple, ours3.select("id", "name", "processed_date").collect())) == sorted(map(tuple, plain3.collect()))
    hints = ours3._jdf.queryExecution().analyzed().toString().count("ResolvedHint (strategy=broadcast)")
    assert hints == 1  # the side with a stated bound, not the other one


def test_join_counts_above_the_chunk(spark):
    left = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2)), (3, None)], "id int, processed_date date")
    right = spark.range(25).select(F.when(F.col("id") < 24, F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("date").alias("created_at"))
    for chunk in (1, 5, 24, 25):
        ours = joins.join_on_date(left, right, "processed_date", "created_at", chunk=chunk)
        assert {r["id"]: r["count"] for r in ours.groupBy("id").count().collect()} == {1: 24, 2: 1}
    spread = joins.join_on_date(left, right, "processed_date", "created_at", chunk=5, spread=True)
    assert spread.count() == 25
    counts = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "least(5," in counts and "REBALANCE" in counts.upper()


def test_latest_per_key_and_report(spark):
    ev = spark.createDataFrame(
        [
            ("r1", "a", "RUNNING", "2025-01-01 00:00:00", None, None, 1),
            ("r1", "a", "SUCCESS", "2025-01-01 00:00:00", "2025-01-01 00:01:00", None, 2),
            ("r1", "b", "SKIP", "2025-01-01 00:02:00", "2025-01-01 00:02:01", "lack", 3),
            ("r1", "b", "SKIP", "2025-01-01 00:02:00", "2025-01-01 00:02:01", "lack", 3),
            ("r2", "a", "ERROR", "2025-01-02 00:00:00", None, None, 4),
        ],
        "run_id string, name string, status string, start_time string, finish_time string, detail string, event_seq bigint",
    )
    cur = runlog.latest_per_key(ev, ["run_id", "name"], ["event_seq"])
    got = {(r["run_id"], r["name"]): r["status"] for r in cur.collect()}
    assert got == {("r1", "a"): "SUCCESS", ("r1", "b"): "SKIP", ("r2", "a"): "ERROR"}
    rep = runlog.run_report(cur, "r2").collect()
    assert [(r["name"], r["finish_time"], r["detail"]) for r in rep] == [("a", "", "")]
    assert runlog.max_id(spark.range(0).withColumnRenamed("id", "ID"), "ID").first()["max_id"] == 0


def test_run_log_roundtrip(spark, scratch):
    log = runlog.RunLog(spark, scratch("log"))
    log.append_step(run_id="r1", seq=0, name="s", func=len, status="RUNNING", start_time="2025-01-01 00:00:00",
                    inputs="raw", outputs=["x"], tags={"t"})
    log.append_step(run_id="r1", seq=0, name="s", func="f", status="SUCCESS", start_time="2025-01-01 00:00:00",
                    finish_time="2025-01-01 00:00:05", inputs={"a": "raw"})
    steps = log.steps().collect()
    assert len(steps) == 1 and steps[0]["status"] == "SUCCESS"
    assert steps[0]["inputs"] == ["raw"]
    first = log.step_events().orderBy("event_seq").first()
    assert first["func"] == "len" and first["tags"] == ["t"] and first["outputs"] == ["x"]


def test_metrics_match_definitions(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.randrange(4)) for _ in range(500)]  # class 3 is predicted but never true
    rows += [(4, 0)] * 7  # class 4 is true but never predicted
    df = spark.createDataFrame(rows, "y int, p int")
    m = evaluate.classification_metrics(df, "y", "p").first()
    classes = sorted({y for y, _ in rows} | {p for _, p in rows})
    n = len(rows)
    acc = sum(y == p for y, p in rows) / n
    prec = rec = f1 = 0.0
    for c in classes:
        tp = sum(1 for y, p in rows if y == c and p == c)
        sup = sum(1 for y, _ in rows if y == c)
        pred = sum(1 for _, p in rows if p == c)
        pc = tp / pred if pred else 0.0
        rc = tp / sup if sup else 0.0
        fc = 2 * pc * rc / (pc + rc) if pc + rc else 0.0
        prec += sup * pc / n
        rec += sup * rc / n
        f1 += sup * fc / n
    for got, want in ((m["accuracy"], acc), (m["precision"], prec), (m["recall"], rec), (m["f1"], f1)):
        assert abs(got - want) < 1e-8


def test_train_logistic_runs(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    model, pred = evaluate.train_logistic(emb, "embedding", "label", "vec_id", max_iter=20)
    assert pred.count() > 0
    metrics = evaluate.run_metrics(emb, "embedding", "label", {"max_iter": 20}).collect()
    assert {r["metric"] for r in metrics} == {"n_features", "n_classes", "n_rows", "max_iter"}


def test_exact_delete_mode(spark):
    entries = spark.createDataFrame(
        [(1, (0, "a", 2, (dt.date(2025, 1, 1),))), (1, (0, "b", 3, (dt.date(2025, 1, 2),)))],
        "status int, data_file struct<content:int, file_path:string, record_count:bigint, partition:struct<processed_date:date>>",
    )
    deletes = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 0)], "file_path string, pos bigint")
    exact = sorted(str(r[0]) for r in table_format.live_partitions(entries, "processed_date", deletes, "exact").collect())
    assert exact == ["2025-01-02"]  # a: 2 of 2 rows deleted; b: 1 of 3
    assert table_format.live_partitions(entries, "processed_date", deletes).count() == 0  # first-row heuristic


def test_metadata_json_and_delete_files(spark, scratch):
    import os

    from daybook.sources.files import read_json_metadata

    folder = scratch("meta").replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/v3.metadata.json", "w") as fh:
        fh.write('{\n  "format-version": 2,\n  "current-snapshot-id": 22,\n  "snapshots": [\n'
                 '    {"snapshot-id": 21, "manifest-list": "s3://b/ml-21.avro"},\n'
                 '    {"snapshot-id": 22, "manifest-list": "s3://b/ml-22.avro"}\n  ]\n}\n')
    meta = read_json_metadata(spark, f"{folder}/v3.metadata.json")
    assert [r["manifest_list"] for r in table_format.current_snapshot(meta).collect()] == ["s3://b/ml-22.avro"]
    # position deletes read from the delete files the entries list
    del_path = scratch("deletes")
    spark.createDataFrame([("a", 0)], "file_path string, pos bigint").write.parquet(del_path)
    entries = spark.createDataFrame(
        [(1, (0, "a", (dt.date(2025, 1, 1),))), (1, (0, "b", (dt.date(2025, 1, 2),))), (1, (1, del_path, (dt.date(2025, 1, 2),)))],
        "status int, data_file struct<content:int, file_path:string, partition:struct<processed_date:date>>",
    )
    deletes = table_format.read_position_deletes(spark, entries)
    got = sorted(str(r[0]) for r in table_format.live_partitions(entries, "processed_date", deletes).collect())
    assert got == ["2025-01-02"]
    none = entries.where("data_file.content = 0")
    assert table_format.read_position_deletes(spark, none) is None


def test_run_log_batch_and_metrics(spark, scratch):
    log = runlog.RunLog(spark, scratch("log"))
    log.append_steps([
        dict(run_id="r", seq=0, name="a", func="f", status="RUNNING", start_time="2025-01-01 00:00:00"),
        dict(run_id="r", seq=1, name="b", func="g", status="SKIP", start_time="2025-01-01 00:00:01", detail="lack"),
        dict(run_id="r", seq=0, name="a", func="f", status="SUCCESS", start_time="2025-01-01 00:00:00",
             finish_time="2025-01-01 00:00:09"),
    ])
    assert {r["name"]: r["status"] for r in log.steps().collect()} == {"a": "SUCCESS", "b": "SKIP"}
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    log.record_metrics("r", evaluate.run_metrics(emb, "embedding", "label", {"max_iter": 1000}))
    got = {r["metric"]: r["value"] for r in log.metrics("r").collect()}
    assert got["n_features"] == 64.0 and got["max_iter"] == 1000.0
