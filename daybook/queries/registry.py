"""The registered queries: one per operator group of the survey inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the SQL oracle in :mod:`daybook.queries.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.calendar import contiguous_dates, is_valid_iso_date, period_end_dates, window_bounds, window_valid
from daybook.functions.paths import location_kind, location_name
from daybook.functions.specs import decode_tags, parse_spec
from daybook.operators import evaluate, gating, inventory, joins, runlog, spans, table_format
from daybook.plans.runner import GatedRunner
from daybook.plans.steps import Dataset, Step, datasets_table, parse_specs, resolve_specs
from daybook.queries import fixtures as fx
from daybook.session import scratch_path, scratch_table_name
from daybook.sinks.catalog import save_table
from daybook.sinks.files import write_partitioned
from daybook.sources.catalog import describe_namespace, list_namespaces, read_table, table_exists
from daybook.sources.files import read_csv, read_parquet
from daybook.sources.folder import read_folders
from daybook.sources.partitioned import apply_window_or_filters, read_partitioned, read_windows

Query = Callable[[SparkSession, str], DataFrame]

# Fixed window lengths of the calendar queries.
CONTIGUOUS_N = {"day": 5, "month": 2, "quarter": 2, "year": 2}
PERIOD_END_N = {"day": 5, "month": 3, "quarter": 3, "year": 2}


# --- calendar (C1-C4) -------------------------------------------------------

def _order_dates(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("processing_date")).distinct()


def _contiguous(unit: str) -> Query:
    def q(spark, sf_dir):
        n = CONTIGUOUS_N[unit]
        return _order_dates(spark, sf_dir).select(
            "processing_date",
            F.posexplode(contiguous_dates(F.col("processing_date"), F.lit(n), F.lit(unit))).alias("pos", "d"),
        ).select("processing_date", F.col("pos").cast("bigint").alias("pos"), "d")
    return q


def _period_end(unit: str) -> Query:
    def q(spark, sf_dir):
        n = PERIOD_END_N[unit]
        return _order_dates(spark, sf_dir).select(
            "processing_date",
            F.posexplode(period_end_dates(F.col("processing_date"), F.lit(n), F.lit(unit))).alias("pos", "d"),
        ).select("processing_date", F.col("pos").cast("bigint").alias("pos"), "d")
    return q


def date_texts(spark, sf_dir) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    y = F.year(d).cast("string")
    m = F.month(d).cast("string")
    dd = F.dayofmonth(d)
    padded = F.date_format(d, "yyyy-MM-dd")
    k = F.col("o_orderkey") % 5
    text = (
        F.when(k == 0, padded)
        .when(k == 1, F.concat_ws("-", y, m, dd.cast("string")))
        .when(k == 2, F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad((dd + 3).cast("string"), 2, "0")))
        .when(k == 3, F.concat(padded, F.lit(" ")))
        .otherwise(F.regexp_replace(padded, "-", "/"))
    )
    return o.select("o_orderkey", text.alias("s"))


def valid_iso_date(spark, sf_dir):
    return date_texts(spark, sf_dir).select("o_orderkey", "s", is_valid_iso_date(F.col("s")).alias("valid"))


# --- scans (S1-S13) and sinks (K1-K7) -----------------------------------------

def scan_partition_window(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return read_partitioned(spark, root, partition_column="processed_date", processing_date=fx.EVENTS_DATE, n=5, unit="day")


def scan_partition_single_day(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return read_partitioned(spark, root, partition_column="processed_date", processing_date=fx.EVENTS_DATE, n=1, unit="day")


def scan_partition_all(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return read_partitioned(spark, root, partition_column="processed_date")


def scan_static_filter_string(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return read_partitioned(
        spark, root, partition_column="processed_date", processing_date=fx.EVENTS_DATE, n=5,
        filters="event_type = 'click' AND value > 5",
    )


def scan_static_filter_list(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return read_partitioned(
        spark, root, partition_column="processed_date", processing_date=fx.EVENTS_DATE, n=5,
        filters=["event_type = 'click'", "value > 5"],
    )


def scan_folder_window(spark, sf_dir):
    root = fx.folder_orders(spark, sf_dir)
    return read_folders(spark, root, processing_date=fx.ORDERS_DATE, n=5, unit="day")


def scan_folder_month_ends(spark, sf_dir):
    root = fx.folder_orders(spark, sf_dir)
    return read_folders(spark, root, processing_date=fx.ORDERS_DATE, n=3, unit="month")


def scan_folder_all(spark, sf_dir):
    root = fx.folder_orders(spark, sf_dir)
    return read_folders(spark, root)


def scan_explicit_schema(spark, sf_dir):
    schema = "p_partkey bigint, p_name string, p_size int"
    return read_partitioned(spark, f"{sf_dir}/part.parquet", schema=schema)


def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "nation_csv")
    fx.table(spark, sf_dir, "nation").write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path)


def scan_parquet_glob(spark, sf_dir):
    root = scratch_path(spark, "nation_parquet")
    write_partitioned(fx.table(spark, sf_dir, "nation"), root, "n_regionkey", overwrite="static")
    return read_parquet(spark, f"{root}/n_regionkey=*", base_path=root)


@fx.input_time
def _new_orders_table(spark, sf_dir) -> str:
    """All of ``orders`` as a session-catalog table partitioned by day (fresh per call)."""
    name = scratch_table_name("orders")
    save_table(fx.orders_with_date(spark, sf_dir), name, partition_by="o_date", location=scratch_path(spark, "orders_table"))
    return name


def _orders_table(spark, sf_dir) -> str:
    """The read-only, shared catalog copy of ``orders``."""
    return fx.shared(spark, sf_dir, "orders_table", _new_orders_table)


def scan_catalog_window(spark, sf_dir):
    name = _orders_table(spark, sf_dir)
    return read_table(spark, name, partition_column="o_date", processing_date=fx.ORDERS_DATE, n=1, unit="month")


def sink_append(spark, sf_dir):
    name = scratch_table_name("orders_append")
    orders = fx.orders_with_date(spark, sf_dir)
    loc = scratch_path(spark, "orders_append")
    save_table(orders.where("o_orderstatus = 'F'"), name, mode="append", partition_by="o_date", location=loc)
    for status in ("O", "P"):
        save_table(orders.where(F.col("o_orderstatus") == status), name, mode="append", partition_by="o_date")
    return spark.read.table(name)


def _overwrite_new(spark, sf_dir) -> DataFrame:
    return fx.orders_with_date(spark, sf_dir).where("o_orderstatus = 'P' AND year(o_orderdate) = 1996")


def sink_overwrite_partitions(spark, sf_dir):
    root = fx.new_partitioned_orders(spark, sf_dir)
    write_partitioned(_overwrite_new(spark, sf_dir), root, "o_date", overwrite="dynamic")
    return spark.read.parquet(root)


def sink_overwrite_all(spark, sf_dir):
    root = fx.new_partitioned_orders(spark, sf_dir)
    write_partitioned(_overwrite_new(spark, sf_dir), root, "o_date", overwrite="static")
    return spark.read.parquet(root)


def sink_table_overwrite_partitions(spark, sf_dir):
    name = _new_orders_table(spark, sf_dir)
    save_table(_overwrite_new(spark, sf_dir), name, mode="overwrite", partition_by="o_date")
    return spark.read.table(name)


def sink_create_partitioned(spark, sf_dir):
    name = scratch_table_name("supplier")
    save_table(fx.table(spark, sf_dir, "supplier"), name, partition_by="s_nationkey", location=scratch_path(spark, "supplier"))
    return spark.read.table(name)


def catalog_exists(spark, sf_dir):
    """Probes of the session catalog around a table created from ``region``."""
    name = scratch_table_name("region")
    save_table(fx.table(spark, sf_dir, "region"), name, location=scratch_path(spark, "region"))
    absent = scratch_table_name("never_created")
    has_default = list_namespaces(spark).where("namespace = 'default'").count() > 0
    described = describe_namespace(spark, "default").count() > 0
    created = spark.read.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("created").alias("probe"), F.lit(table_exists(spark, name)).alias("table_exists"), "n_rows"
    )
    others = spark.createDataFrame(
        [("absent", table_exists(spark, absent), 0), ("namespace_default", has_default, 0),
         ("namespace_described", described, 0)],
        "probe string, table_exists boolean, n_rows bigint",
    )
    return created.unionByName(others)


# --- inventory and completeness (P1-P7) ---------------------------------------

def inventory_hive(spark, sf_dir):
    return inventory.list_partitions(spark, fx.partitioned_events(spark, sf_dir), "processed_date")


def inventory_folder(spark, sf_dir):
    return inventory.list_partitions(spark, fx.folder_orders(spark, sf_dir), None)


def inventory_table(spark, sf_dir):
    return inventory.list_partitions(spark, _orders_table(spark, sf_dir), "o_date")


def locations(spark, sf_dir) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages").select(F.col("url").alias("location"))
    nation = fx.table(spark, sf_dir, "nation")
    n = F.lower(F.col("n_name"))
    made = nation.select(
        F.explode(
            F.array(
                F.concat(F.lit("s3a://warehouse/"), n),
                F.concat(F.lit("S3://warehouse/"), n, F.lit("/")),
                F.concat(F.lit("hdfs://namenode:8020/data/"), n),
                F.concat(F.lit("file:///data/"), n),
                F.concat(F.lit("/data/raw/"), n),
                F.concat(F.lit("lake."), n, F.lit(".orders")),
                F.concat(F.lit("cat.db.sub."), n),
                n,
            )
        ).alias("location")
    )
    return pages.unionByName(made)


def path_kind(spark, sf_dir):
    loc = locations(spark, sf_dir)
    return loc.select("location", location_kind(F.col("location")).alias("kind"), location_name(F.col("location")).alias("name"))


def completeness_events_day(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return inventory.missing_dates(spark, root, fx.EVENTS_DATE, 5, "day", partition_column="processed_date")


def completeness_events_month(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    return inventory.missing_dates(spark, root, fx.EVENTS_MONTH_END_DATE, 1, "month", partition_column="processed_date")


def completeness_orders_year(spark, sf_dir):
    root = fx.partitioned_orders(spark, sf_dir)
    return inventory.missing_dates(spark, root, fx.ORDERS_YEAR_DATE, 1, "year", partition_column="o_date")


def completeness_folder_month_ends(spark, sf_dir):
    root = fx.folder_orders(spark, sf_dir)
    return inventory.missing_dates(spark, root, fx.FOLDER_END_DATE, 4, "month", shape="period_end")


# --- table-format live partitions (P5) ----------------------------------------

def latest_metadata_entry(spark, sf_dir):
    return table_format.latest_metadata_file(fx.metadata_log(spark, sf_dir))


def current_snapshot(spark, sf_dir):
    return table_format.current_snapshot(fx.metadata_documents(spark, sf_dir), keys=["table_id"])


def live_partitions(spark, sf_dir):
    return table_format.live_partitions(
        fx.manifest_entries(spark, sf_dir), "processed_date", fx.position_deletes(spark, sf_dir)
    )


def live_partitions_inserted(spark, sf_dir):
    return table_format.inserted_files(fx.manifest_entries(spark, sf_dir), "processed_date")


def live_partitions_removed(spark, sf_dir):
    return table_format.removed_files(fx.manifest_entries(spark, sf_dir), fx.position_deletes(spark, sf_dir))


# --- transforms (T1-T4) -------------------------------------------------------

def _join_inputs(spark, sf_dir):
    orders = apply_window_or_filters(
        fx.table(spark, sf_dir, "orders"), partition_column="o_orderdate", processing_date=fx.ORDERS_DATE, n=1, unit="month"
    )
    left = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.to_date("o_orderdate").alias("processed_date")
    )
    # A mapping has a bounded number of rows per date, so the result grows with the left rows:
    # the return flags of the items shipped that day, and the priorities of the orders placed that day.
    lineitem, all_orders = fx.table(spark, sf_dir, "lineitem"), fx.table(spark, sf_dir, "orders")
    mapping = lineitem.select(F.to_date("l_shipdate").alias("created_at"), "l_returnflag").distinct()
    third = all_orders.select(F.to_date("o_orderdate").alias("processed_date"), "o_orderpriority").distinct()
    return left, mapping, third


def join_primary(spark, sf_dir):
    left, mapping, _ = _join_inputs(spark, sf_dir)
    return joins.join_on_date(left, mapping, "processed_date", "created_at")


def join_primary_keyed(spark, sf_dir):
    left, mapping, _ = _join_inputs(spark, sf_dir)
    return joins.join_on_date(left, mapping.withColumnRenamed("created_at", "primary_date"), "processed_date", "primary_date")


def join_feature(spark, sf_dir):
    left, mapping, third = _join_inputs(spark, sf_dir)
    return joins.join_on_two_dates(left, mapping.withColumnRenamed("created_at", "primary_date"), third)


def passthrough_window(spark, sf_dir):
    root = fx.partitioned_events(spark, sf_dir)
    spec = spark.createDataFrame([("events:5d",)], "spec string").select(parse_spec("spec").alias("p")).first()["p"]
    df = read_partitioned(spark, root, partition_column="processed_date", processing_date="2024-01-20", n=spec["n"], unit=spec["unit"])
    return joins.passthrough(df)


# --- gating (G1-G10) ----------------------------------------------------------

def spec_texts(spark, sf_dir) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    n = (F.floor("value").cast("bigint") % 13).cast("string")
    k = F.col("event_id") % 7
    et = F.col("event_type")
    spec = (
        F.when(k == 0, et)
        .when(k == 1, F.concat(et, F.lit(":"), n, F.lit("d")))
        .when(k == 2, F.concat(et, F.lit(":"), n, F.lit("M")))
        .when(k == 3, F.concat(et, F.lit(":"), n, F.lit("q")))
        .when(k == 4, F.concat(et, F.lit(":"), n))
        .when(k == 5, F.concat(et, F.lit(":*")))
        .otherwise(F.concat(et, F.lit(":"), F.col("props"), F.lit(":1y")))
    )
    return e.select("event_id", spec.alias("spec"))


def parse_io_spec(spark, sf_dir):
    return spec_texts(spark, sf_dir).select("event_id", "spec", parse_spec("spec").alias("p")).select(
        "event_id", "spec", F.col("p.name").alias("name"), F.col("p.n").alias("n"), F.col("p.unit").alias("unit")
    )


def tag_texts(spark, sf_dir) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    n = (F.floor(F.col("value") / 40).cast("bigint")).cast("string")
    k = F.col("event_id") % 3
    units = F.array(*[F.lit(u) for u in ("day", "month", "quarter", "year")])
    unit = F.element_at(units, (F.col("user_id") % 4 + 1).cast("int"))
    tag = (
        F.when(k == 0, F.concat_ws("--", F.lit("input"), F.col("event_type"), n, unit))
        .when(k == 1, F.concat_ws("--", F.lit("input"), F.col("event_type"), n))
        .otherwise(F.concat_ws("--", F.lit("output"), F.col("event_type"), n, unit))
    )
    return e.select(F.col("user_id").alias("step"), "ts", "event_id", tag.alias("tag"))


def parse_tags(spark, sf_dir):
    return decode_tags(tag_texts(spark, sf_dir), ["step"], "tag", ["ts", "event_id"], "input")


def _event_datasets(spark, sf_dir) -> DataFrame:
    """Datasets table derived from the event types present in ``events``."""
    et = F.col("event_type")
    types = fx.table(spark, sf_dir, "events").select("event_type").distinct()
    return types.where(et != "error").select(
        et.alias("dataset"),
        F.when(et == "view", F.lit("folder")).when(et == "purchase", F.lit("table")).otherwise(F.lit("partitioned")).alias("kind"),
        F.when(et == "purchase", F.concat(F.lit("lake.sales."), et)).otherwise(F.concat(F.lit("s3a://warehouse/"), et)).alias("location"),
        F.when(et == "view", F.lit(None).cast("string")).otherwise(F.lit("processed_date")).alias("partition_column"),
        (et != "signup").alias("validate"),
    )


def resolve_dataset(spark, sf_dir):
    specs = parse_io_spec(spark, sf_dir).select("event_id", F.col("name").alias("dataset"), "n", "unit")
    return resolve_specs(specs, _event_datasets(spark, sf_dir)).select(
        "event_id", "dataset", "kind", "location", "partition_column", "n", "unit"
    )


def _user_specs(spark, sf_dir) -> DataFrame:
    """Steps derived from events: step ``u<user_id>`` reads the event types the
    user produced and writes ``u<user_id>_out``."""
    e = fx.table(spark, sf_dir, "events")
    step = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    ins = e.select(step.alias("step"), F.col("user_id").cast("int").alias("seq"), F.lit("input").alias("direction"), F.col("event_type").alias("dataset")).distinct()
    outs = e.select(step.alias("step"), F.col("user_id").cast("int").alias("seq"), F.lit("output").alias("direction"), F.concat(step, F.lit("_out")).alias("dataset")).distinct()
    return ins.unionByName(outs).select("*", F.lit(5).alias("n"), F.lit("day").alias("unit"))


def unsatisfied_inputs(spark, sf_dir):
    return gating.unsatisfied_inputs(_user_specs(spark, sf_dir), _event_datasets(spark, sf_dir))


GATE_SPECS = [
    # step, seq, direction, spec
    ("s1_copy", 1, "input", "ev:5d"),
    ("s1_copy", 1, "output", "out_missing:5d"),
    ("s2_month", 2, "input", "ev:1m"),
    ("s2_month", 2, "output", "out_missing:1m"),
    ("s3_done", 3, "input", "ev_unchecked:1m"),
    ("s3_done", 3, "output", "ev:5d"),
    ("s4_two_inputs", 4, "input", "ev:5d"),
    ("s4_two_inputs", 4, "input", "od:3m"),
    ("s4_two_inputs", 4, "output", "out_missing:5d"),
    ("s5_no_window", 5, "input", "ev"),
    ("s5_no_window", 5, "output", "ev"),
    ("s6_mixed_outputs", 6, "input", "ev:3d"),
    ("s6_mixed_outputs", 6, "output", "ev:5d"),
    ("s6_mixed_outputs", 6, "output", "od"),
    ("s7_folder_none", 7, "input", "od:1d"),
    ("s7_folder_none", 7, "output", "od:2m"),
    ("s8_folder_done", 8, "input", "evf:1d"),
    ("s8_folder_done", 8, "output", "evf:3d"),
]


GATE_DATE = "2024-01-15"


def _gate_tables(spark, sf_dir):
    ev = fx.partitioned_events(spark, sf_dir)
    od = fx.folder_orders(spark, sf_dir)
    missing_root = scratch_path(spark, "never_written")
    dsets = [
        Dataset("ev", "partitioned", ev, "processed_date", True),
        Dataset("ev_unchecked", "partitioned", ev, "processed_date", False),
        Dataset("od", "folder", od, None, True),
        Dataset("evf", "folder", fx.folder_events(spark, sf_dir), None, True),
        Dataset("out_missing", "partitioned", missing_root, "processed_date", True),
    ]
    raw = spark.createDataFrame(
        [(s, seq, d, None, 0, spec) for s, seq, d, spec in GATE_SPECS],
        "step string, seq int, direction string, arg string, pos int, spec string",
    )
    specs = parse_specs(raw)
    dtab = datasets_table(spark, dsets)
    return specs, dtab, gating.inventory_for(spark, dtab, specs, GATE_DATE)


def gate_inputs(spark, sf_dir):
    specs, dtab, inv = _gate_tables(spark, sf_dir)
    return gating.gate_inputs(specs, dtab, inv, GATE_DATE)


def gate_outputs(spark, sf_dir):
    specs, dtab, inv = _gate_tables(spark, sf_dir)
    return gating.gate_outputs(specs, dtab, inv, GATE_DATE)


def gate_decision(spark, sf_dir):
    specs, dtab, inv = _gate_tables(spark, sf_dir)
    return gating.gate_decision(specs, dtab, inv, GATE_DATE)


def _clicks(df: DataFrame) -> DataFrame:
    return df.where("event_type = 'click'")


def gated_run(spark, sf_dir):
    """G9 end to end: three steps over a partitioned copy of events, with a run log.

    One row per step: the outcome, and the rows its output then holds.
    """
    return _gated_run(spark, sf_dir, ("stage", "monthly", "clicks"))


def gated_run_unordered(spark, sf_dir):
    """The same steps, declared before what they depend on: they run in dependency order."""
    return _gated_run(spark, sf_dir, ("clicks", "stage", "monthly"))


def _gated_run(spark, sf_dir, declared):
    ev = fx.partitioned_events(spark, sf_dir)
    stage = scratch_path(spark, "staged")
    clicks = scratch_path(spark, "clicks")
    dsets = [
        Dataset("raw_events", "partitioned", ev, "processed_date"),
        Dataset("staged_events", "partitioned", stage, "processed_date"),
        Dataset("click_events", "partitioned", clicks, "processed_date"),
    ]
    steps = [
        Step("stage", joins.passthrough, "raw_events:5d", "staged_events:5d"),
        Step("monthly", joins.passthrough, "raw_events:1m", "staged_events:1m"),
        Step("clicks", _clicks, "staged_events:5d", "click_events:5d"),
    ]
    log = runlog.RunLog(spark, scratch_path(spark, "runlog"))
    steps = sorted(steps, key=lambda x: declared.index(x.name))
    outcome = GatedRunner(spark, dsets, log).run(steps, fx.EVENTS_DATE)
    held = None
    for step, root in (("stage", stage), ("monthly", stage), ("clicks", clicks)):
        n = spark.read.parquet(root).agg(F.lit(step).alias("step"), F.count("*").alias("n_rows"))
        held = n if held is None else held.unionByName(n)
    logged = log.steps().select(F.col("name").alias("step"), F.col("status").alias("logged"))
    return outcome.join(held, "step").join(logged, "step").select("step", "seq", "status", "reason", "logged", "n_rows")


# --- run log (L1-L6) ----------------------------------------------------------

def runlog_upsert_nodes(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return runlog.latest_per_key(e, ["user_id", "event_type"], ["ts", "event_id"])


def runlog_upsert_runs(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return runlog.latest_per_key(e, ["user_id"], ["ts", "event_id"])


def runlog_max_id(spark, sf_dir):
    return runlog.max_id(fx.table(spark, sf_dir, "orders"), "o_orderkey")


def runlog_max_id_empty(spark, sf_dir):
    return runlog.max_id(fx.table(spark, sf_dir, "orders").where("o_totalprice < 0"), "o_orderkey")


def step_log_from_events(spark, sf_dir) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).when(F.col("value") < 10, F.lit("SKIP")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.when(F.col("value") >= 50, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("finish_time"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("detail"),
    )


def run_report(spark, sf_dir):
    return runlog.run_report(step_log_from_events(spark, sf_dir))


def runlog_arrays(spark, sf_dir):
    """Scalars and arrays normalised to ``array<string>`` (NULL → [])."""
    e = fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("inputs"),
        F.when(F.col("value") > 20, F.array(F.col("event_type"), F.col("props"))).alias("tags"),
    )
    return e.select("event_id", runlog.as_text_array(e, "inputs").alias("inputs"), runlog.as_text_array(e, "tags").alias("tags"))


# --- evaluation (M1-M3) ---------------------------------------------------------

def classification_metrics(spark, sf_dir):
    return evaluate.classification_metrics(fx.table(spark, sf_dir, "labels"), "quality", "toxic")


def train_logistic(spark, sf_dir):
    _, pred = evaluate.train_newton(fx.table(spark, sf_dir, "embeddings"), "embedding", "label", "vec_id")
    return pred.select("vec_id", "label", F.col("_prediction").cast("int").alias("prediction"))


def train_logistic_lbfgs(spark, sf_dir):
    """M1 with MLlib's solver (no oracle: it stops where it has converged)."""
    _, pred = evaluate.train_logistic(fx.table(spark, sf_dir, "embeddings"), "embedding", "label", "vec_id", max_iter=1000)
    return pred.select("vec_id", "label", F.col("_prediction").cast("int").alias("prediction"))


def run_metrics_table(spark, sf_dir):
    params = {"max_iter": 1000, "seed": 42, "solver": "l-bfgs", "family": "multi'nomial"}
    return evaluate.run_metrics(fx.table(spark, sf_dir, "embeddings"), "embedding", "label", params)


def test_split(spark, sf_dir):
    """M1's split: the rows that the hash of the key puts into the test set."""
    e = fx.table(spark, sf_dir, "embeddings")
    return e.where(evaluate.hash_split("vec_id", 42, 0.2)).select("vec_id", "label")


def window_checks(spark, sf_dir):
    """C4 as a column: which ``(n, unit)`` derived from the events are valid windows."""
    unit = F.element_at(F.array(*map(F.lit, ("day", "month", "quarter", "year", "week"))), (F.col("event_id") % 5 + 1).cast("int"))
    e = fx.table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 7 - 2).cast("int").alias("n"), unit.alias("unit"))
    return e.select("event_id", "n", "unit", window_valid(F.col("n"), F.col("unit")).alias("valid"))


def live_partitions_table(spark, sf_dir):
    """P5 end to end: from a table's metadata files to its live dates (S11-S13, P5a-P5g)."""
    log, location = fx.table_format_files(spark, sf_dir)
    return table_format.live_partitions_of(spark, log, "processed_date", manifest_format="avro", base=location)


def live_rows_by_date(spark, sf_dir):
    """P5f, exact: files and rows that position deletes leave, per date."""
    returned, discounted = map(table_format.deleted_positions, fx.item_deletes(spark, sf_dir))
    return table_format.live_rows(fx.counted_entries(spark, sf_dir), "processed_date", table_format.merged_positions(returned, discounted))


def live_rows_equality(spark, sf_dir):
    """P5 with equality deletes: the rows that no later delete of their key removes."""
    rows, deletes = fx.equality_events(spark, sf_dir)
    return table_format.drop_equal(rows, deletes, ["user_id"], spread=4).select("event_id", "user_id", "event_type")


def live_dates_as_of(spark, sf_dir):
    """The live dates of the table as they were at midnight of every order date."""
    documents = fx.history_documents(spark, sf_dir)
    asks = _order_dates(spark, sf_dir).withColumnRenamed("processing_date", "asked")
    held = table_format.snapshots_as_of(asks, "asked", table_format.metadata_log_of(documents), documents, grain="year")
    entries = fx.history_entries(spark, sf_dir)
    live = entries.where("data_file.content = 0 AND status IN (0, 1)").select("manifest_list", F.col("data_file.partition.processed_date").alias("live_date")).distinct()
    return held.join(live, "manifest_list").select("asked", "snapshot_id", "live_date")


def inventory_spans(spark, sf_dir):
    """The islands of consecutive dates that have a pending order."""
    return spans.date_spans(_pending_dates(spark, sf_dir))


def inventory_gaps(spark, sf_dir):
    return spans.date_gaps(_pending_dates(spark, sf_dir))


def _pending_dates(spark, sf_dir) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return o.select(F.to_date("o_orderdate").alias("d"))


def completeness_all_dates(spark, sf_dir):
    """P6 for a table of processing dates: the dates without a pending order in each of their windows."""
    sizes = F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(n).alias("n")) for u, n in CONTIGUOUS_N.items()])
    asked = _order_dates(spark, sf_dir).select("processing_date", F.inline(sizes))
    lo, hi = window_bounds(F.col("processing_date"), F.col("n"), F.col("unit"))
    windows = asked.select("processing_date", "unit", lo.alias("lo"), hi.alias("hi"))
    return spans.missing_counts(windows, _pending_dates(spark, sf_dir)).select("processing_date", "unit", "n_expected", "n_missing")


def scan_windows_table(spark, sf_dir):
    """S4 for windows that are data: the events of the two days up to a day with many costly errors."""
    e = fx.events_with_date(spark, sf_dir).where("event_type = 'error' AND value > 60")
    days = e.groupBy(F.col("processed_date").alias("processing_date")).agg(F.count("*").alias("k"), F.max("value").alias("top"))
    specs = days.where("top > 300").select("processing_date", F.lit(2).alias("n"), F.lit("day").alias("unit"))
    return read_windows(spark, fx.partitioned_events(spark, sf_dir), "processed_date", specs)


def _bucketed_inputs(spark, sf_dir):
    facts, mapping, third = (spark.read.table(x) for x in fx.dated_buckets(spark, sf_dir))
    left = apply_window_or_filters(facts, partition_column="processed_date", processing_date=fx.ORDERS_DATE, n=1, unit="month")
    return left, mapping, third


def join_primary_bucketed(spark, sf_dir):
    """T1 on tables bucketed by their dates: no exchange on either side."""
    left, mapping, _ = _bucketed_inputs(spark, sf_dir)
    return joins.join_on_date(left, mapping, "processed_date", "primary_date", strategy="merge")


def join_feature_bucketed(spark, sf_dir):
    left, mapping, third = _bucketed_inputs(spark, sf_dir)
    return joins.join_on_two_dates(left, mapping, third, strategy="merge")


def runlog_snapshot_tail(spark, sf_dir):
    """L1/L2 as snapshot plus tail: most events folded into a snapshot, then late, new and repeated ones."""
    e = fx.table(spark, sf_dir, "events")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in e.schema)
    log = runlog.FoldedLog(spark, scratch_path(spark, "folded"), schema, ["user_id", "event_type"], ["ts", "event_id"], margin_ms=0)
    log.append(e.where("event_id % 10 < 7"))
    log.snapshot()
    log.append(e.where("event_id % 10 BETWEEN 5 AND 8"))
    log.snapshot()
    log.append(e.where("event_id % 10 >= 8"))
    return log.state()


def delete_file_paths(spark, sf_dir):
    """P5d: the delete files that the manifest entries list."""
    return table_format.delete_files(fx.manifest_entries(spark, sf_dir))


QUERIES: dict[str, Query] = {
    **{f"window_contiguous_{u}": _contiguous(u) for u in ("day", "month", "quarter", "year")},
    **{f"window_period_end_{u}": _period_end(u) for u in ("day", "month", "quarter", "year")},
    "valid_iso_date": valid_iso_date,
    "scan_partition_window": scan_partition_window,
    "scan_partition_single_day": scan_partition_single_day,
    "scan_partition_all": scan_partition_all,
    "scan_static_filter_string": scan_static_filter_string,
    "scan_static_filter_list": scan_static_filter_list,
    "scan_folder_window": scan_folder_window,
    "scan_folder_month_ends": scan_folder_month_ends,
    "scan_folder_all": scan_folder_all,
    "scan_explicit_schema": scan_explicit_schema,
    "scan_csv": scan_csv,
    "scan_parquet_glob": scan_parquet_glob,
    "scan_catalog_window": scan_catalog_window,
    "sink_append": sink_append,
    "sink_overwrite_partitions": sink_overwrite_partitions,
    "sink_overwrite_all": sink_overwrite_all,
    "sink_table_overwrite_partitions": sink_table_overwrite_partitions,
    "sink_create_partitioned": sink_create_partitioned,
    "catalog_exists": catalog_exists,
    "inventory_hive": inventory_hive,
    "inventory_folder": inventory_folder,
    "inventory_table": inventory_table,
    "path_kind": path_kind,
    "completeness_events_day": completeness_events_day,
    "completeness_events_month": completeness_events_month,
    "completeness_orders_year": completeness_orders_year,
    "completeness_folder_month_ends": completeness_folder_month_ends,
    "latest_metadata_entry": latest_metadata_entry,
    "current_snapshot": current_snapshot,
    "live_partitions": live_partitions,
    "live_partitions_inserted": live_partitions_inserted,
    "live_partitions_removed": live_partitions_removed,
    "join_primary": join_primary,
    "join_primary_keyed": join_primary_keyed,
    "join_feature": join_feature,
    "passthrough_window": passthrough_window,
    "parse_io_spec": parse_io_spec,
    "parse_tags": parse_tags,
    "resolve_dataset": resolve_dataset,
    "unsatisfied_inputs": unsatisfied_inputs,
    "gate_inputs": gate_inputs,
    "gate_outputs": gate_outputs,
    "gate_decision": gate_decision,
    "gated_run": gated_run,
    "gated_run_unordered": gated_run_unordered,
    "runlog_upsert_nodes": runlog_upsert_nodes,
    "runlog_upsert_runs": runlog_upsert_runs,
    "runlog_max_id": runlog_max_id,
    "runlog_max_id_empty": runlog_max_id_empty,
    "run_report": run_report,
    "runlog_arrays": runlog_arrays,
    "classification_metrics": classification_metrics,
    "train_logistic": train_logistic,
    "run_metrics_table": run_metrics_table,
    "test_split": test_split,
    "window_checks": window_checks,
    "live_partitions_table": live_partitions_table,
    "delete_file_paths": delete_file_paths,
    "live_rows_by_date": live_rows_by_date,
    "live_rows_equality": live_rows_equality,
    "live_dates_as_of": live_dates_as_of,
    "inventory_spans": inventory_spans,
    "inventory_gaps": inventory_gaps,
    "completeness_all_dates": completeness_all_dates,
    "scan_windows_table": scan_windows_table,
    "join_primary_bucketed": join_primary_bucketed,
    "join_feature_bucketed": join_feature_bucketed,
    "runlog_snapshot_tail": runlog_snapshot_tail,
    "train_logistic_lbfgs": train_logistic_lbfgs,
}
