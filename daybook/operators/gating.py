"""Step gating as table operators.

Inputs are small configuration tables plus a data-derived inventory:

* specs ``(step, seq, direction, dataset, n, unit)`` — one row per step
  input/output; ``n``/``unit`` NULL when the spec has no window;
* datasets ``(dataset, kind, location, partition_column, validate)`` — kind is
  ``folder`` (dated folders, period-end windows), ``partitioned`` or ``table``;
* inventory ``(dataset, d)`` — dates with data, from
  :mod:`daybook.operators.inventory`.

The decision per step, in this order: an incomplete validated input → SKIP
(reason ``inputs``); every output has a window and all are complete → SKIP
(reason ``outputs``); otherwise RUN.  Inputs without a window, or whose
dataset is not validated, impose no requirement.  An output without a
window can never be "complete", so its step runs.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.calendar import window_bounds, window_dates

_log = logging.getLogger(__name__)

SHAPE_OF_KIND = {"folder": "period_end", "partitioned": "contiguous", "table": "contiguous"}


def _shape(kind_col):
    expr = None
    for k, v in SHAPE_OF_KIND.items():
        expr = F.when(kind_col == k, F.lit(v)) if expr is None else expr.when(kind_col == k, F.lit(v))
    return expr.otherwise(F.lit("contiguous"))


def expected_by_spec(specs: DataFrame, datasets: DataFrame, processing_date) -> DataFrame:
    """``(step, seq, direction, dataset, validate, pos, d)`` for every windowed spec."""
    d = F.to_date(F.lit(str(processing_date)))
    joined = specs.where(F.col("n").isNotNull() & (F.col("n") > 0)).join(
        F.broadcast(datasets.select("dataset", "kind", "validate")), "dataset", "left"
    )
    return joined.select(
        "step", "seq", "direction", "dataset", F.coalesce("validate", F.lit(False)).alias("validate"),
        F.posexplode(window_dates(d, F.col("n"), F.col("unit"), _shape(F.col("kind")))).alias("pos", "d"),
    ).withColumn("pos", F.col("pos").cast("bigint"))


def windows(specs: DataFrame, datasets: DataFrame, processing_date) -> DataFrame:
    """Windows as data: ``(dataset, pos, d)`` for every windowed spec, with the
    shape (period-end for dated folders, contiguous otherwise) taken from the
    dataset kind."""
    return expected_by_spec(specs, datasets, processing_date).select("dataset", "pos", "d").distinct()


def missing_by_spec(specs: DataFrame, datasets: DataFrame, inventory: DataFrame, processing_date) -> DataFrame:
    """Expected dates of every windowed spec that are absent from the inventory.

    The expected side is bounded by the configured windows; the inventory is
    cut to the overall window range before the anti join, so its build side
    is bounded by the same configuration.
    """
    expected = expected_by_spec(specs, datasets, processing_date)
    d = F.to_date(F.lit(str(processing_date)))
    bounds = specs.where(F.col("n").isNotNull() & (F.col("n") > 0)).select(
        "dataset", *[c.alias(a) for c, a in zip(window_bounds(d, F.col("n"), F.col("unit")), ("lo", "hi"))]
    ).groupBy("dataset").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    present = (
        inventory.join(F.broadcast(bounds), "dataset")
        .where((F.col("d") >= F.col("lo")) & (F.col("d") <= F.col("hi")))
        .select("dataset", "d")
        .distinct()
    )
    return expected.join(present, ["dataset", "d"], "left_anti")


def gate_table(specs: DataFrame, datasets: DataFrame, inventory: DataFrame, processing_date) -> DataFrame:
    """Everything the gates need, per step, from **one** missing-dates plan.

    ``(step, seq, missing_inputs, n_missing_input_dates, n_outputs,
    n_windowed_outputs, n_missing_output_dates)``.  Every step of ``specs``
    appears; all inputs of this aggregate are bounded by configuration.
    """
    miss = missing_by_spec(specs, datasets, inventory, processing_date)
    validated_input = (F.col("direction") == "input") & F.col("validate")
    per_step_missing = miss.groupBy("step").agg(
        F.array_sort(F.collect_set(F.when(validated_input, F.col("dataset")))).alias("missing_inputs"),
        F.count(F.when(validated_input, F.lit(1))).alias("n_missing_input_dates"),
        F.count(F.when(F.col("direction") == "output", F.lit(1))).alias("n_missing_output_dates"),
    )
    is_out = F.col("direction") == "output"
    per_step = specs.groupBy("step", "seq").agg(
        F.count(F.when(is_out, F.lit(1))).alias("n_outputs"),
        F.count(F.when(is_out & (F.col("n") > 0), F.lit(1))).alias("n_windowed_outputs"),
    )
    zero = F.lit(0).cast("bigint")
    return per_step.join(per_step_missing, "step", "left").select(
        "step",
        "seq",
        F.coalesce("missing_inputs", F.array().cast("array<string>")).alias("missing_inputs"),
        F.coalesce("n_missing_input_dates", zero).alias("n_missing_input_dates"),
        "n_outputs",
        "n_windowed_outputs",
        F.coalesce("n_missing_output_dates", zero).alias("n_missing_output_dates"),
    )


def _outputs_complete() -> Column:
    return (
        (F.col("n_windowed_outputs") > 0)
        & (F.col("n_windowed_outputs") == F.col("n_outputs"))
        & (F.col("n_missing_output_dates") == 0)
    )


def gate_inputs(specs: DataFrame, datasets: DataFrame, inventory: DataFrame, processing_date) -> DataFrame:
    """Per step, the validated inputs with missing dates.

    ``(step, seq, missing_inputs array<string>, n_missing_dates bigint)``;
    every step of ``specs`` appears, with an empty array when nothing lacks.
    """
    return gate_table(specs, datasets, inventory, processing_date).select(
        "step", "seq", "missing_inputs", F.col("n_missing_input_dates").alias("n_missing_dates")
    )


def gate_outputs(specs: DataFrame, datasets: DataFrame, inventory: DataFrame, processing_date) -> DataFrame:
    """Per step, are all outputs windowed and complete?

    ``(step, seq, n_outputs, n_windowed_outputs, n_missing_dates, outputs_complete)``.
    ``data_validation`` is not consulted for outputs.
    """
    return gate_table(specs, datasets, inventory, processing_date).select(
        "step", "seq", "n_outputs", "n_windowed_outputs",
        F.col("n_missing_output_dates").alias("n_missing_dates"),
        _outputs_complete().alias("outputs_complete"),
    )


def gate_decision(specs: DataFrame, datasets: DataFrame, inventory: DataFrame, processing_date) -> DataFrame:
    """``(step, seq, decision, reason, missing_inputs)``; inputs are checked first."""
    t = gate_table(specs, datasets, inventory, processing_date)
    lacking = F.size("missing_inputs") > 0
    done = _outputs_complete()
    return t.select(
        "step",
        "seq",
        F.when(lacking | done, F.lit("SKIP")).otherwise(F.lit("RUN")).alias("decision"),
        F.when(lacking, F.lit("inputs")).when(done, F.lit("outputs")).alias("reason"),
        "missing_inputs",
    )


def unsatisfied_inputs(specs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Free inputs (never produced by any step) that are not in the datasets table."""
    # Distinct names first: a name that a third of the specs use is one row in both joins.
    inputs = specs.where(F.col("direction") == "input").select("dataset").distinct()
    produced = specs.where(F.col("direction") == "output").select("dataset").distinct()
    free = inputs.join(produced, "dataset", "left_anti")
    return free.join(datasets.select("dataset").distinct(), "dataset", "left_anti")


def inventory_for(
    spark: SparkSession,
    datasets: DataFrame,
    specs: DataFrame | None = None,
    processing_date=None,
    lenient: set[str] | frozenset[str] = frozenset(),
) -> DataFrame:
    """``(dataset, d)`` for the datasets of the configuration table.

    The configuration tables are small (one row per declared dataset / step
    spec), so they are read on the driver to build one listing per dataset;
    the listings are unioned into one plan.  With ``specs`` and
    ``processing_date`` only what a gate looks at is listed: the folders of
    the windows of outputs and of validated inputs.  A spec without a window
    and an input that is not validated ask for nothing, so a dataset that
    only they name is not touched at all.

    A listing that fails for a dataset in ``lenient`` (the runner passes the
    datasets used only as outputs) yields an empty inventory, so the output
    counts as incomplete and the step runs; any other failure propagates.
    """
    from daybook.operators.inventory import glob_parts, list_partitions

    rows = datasets.select("dataset", "kind", "location", "partition_column").collect()
    only: dict[str, list[str] | None] = {}
    if specs is not None and processing_date is not None:
        d = F.to_date(F.lit(str(processing_date)))
        kinds = datasets.select("dataset", _shape(F.col("kind")).alias("shape"), F.coalesce("validate", F.lit(False)).alias("validate"))
        asked = specs.where("n > 0").join(kinds, "dataset").where("direction = 'output' OR validate")
        parts = asked.select("dataset", glob_parts(d, F.col("n"), F.col("unit"), F.col("shape")).alias("g")).groupBy("dataset").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("g")))).alias("g"),
        ).collect()  # one small job: one row per dataset of the configuration
        only = {p["dataset"]: list(p["g"]) for p in parts}
        rows = [r for r in rows if r["dataset"] in only]

    def listing(r):
        try:
            inv = list_partitions(spark, r["location"], r["partition_column"], only.get(r["dataset"]), r["dataset"] in lenient)
        except Exception as err:  # noqa: BLE001 - output checks degrade to "incomplete"
            if r["dataset"] not in lenient:
                raise
            _log.warning("output %s could not be listed (%s); treated as incomplete", r["dataset"], err)
            inv = spark.createDataFrame([], "d date")
        return inv.select(F.lit(r["dataset"]).alias("dataset"), "d")

    frames = [listing(r) for r in rows]
    if not frames:
        return spark.createDataFrame([], "dataset string, d date")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
