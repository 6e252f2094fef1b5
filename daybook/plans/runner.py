"""The gated runner (G8-G10): decide per step, read the windows, run, write, log.

Steps run in dependency order (:func:`daybook.plans.steps.in_dependency_order`)
on the driver thread; each one is a Spark job (or a few) that writes its outputs.  The decision for a step is taken
right before it runs, because a step may depend on what the previous one
just wrote; :meth:`GatedRunner.plan` gives the all-steps dry run.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from daybook.functions.calendar import validate_window
from daybook.operators.gating import gate_decision, inventory_for
from daybook.operators.runlog import RunLog
from daybook.plans.steps import PARAMS, PARSED_SPECS_SCHEMA, Dataset, Step, datasets_table, in_dependency_order, specs_table
from daybook.sinks.catalog import save_table
from daybook.sinks.files import write_folder, write_partitioned
from daybook.sources.catalog import read_table
from daybook.sources.folder import read_folders
from daybook.sources.partitioned import read_partitioned

RESULT_SCHEMA = "step string, seq int, status string, reason string, detail string"


def _now() -> str:
    return _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


class GatedRunner:
    def __init__(
        self, spark: SparkSession, datasets: Mapping[str, Dataset] | Sequence[Dataset], run_log: RunLog | None = None,
        params: Mapping[str, object] | None = None,
    ):
        self.spark = spark
        items = datasets.values() if isinstance(datasets, Mapping) else datasets
        self.datasets = {d.name: d for d in items}
        self.run_log = run_log
        self.params = dict(params or {})

    # -- decisions -------------------------------------------------------
    def _tables(self, steps: Sequence[Step], parsed: list | None = None):
        """Specs and datasets tables for ``steps``.

        ``parsed`` are spec rows already parsed by Spark (one small job per
        run); without them the specs are parsed here.  The rows are
        configuration, bounded by the number of declared inputs/outputs.
        """
        if parsed is None:
            parsed = specs_table(self.spark, steps).collect()
        names = {s.name for s in steps}
        rows = [r for r in parsed if r["step"] in names]
        specs = self.spark.createDataFrame([self._gated(r) for r in rows], PARSED_SPECS_SCHEMA)
        used = {r["dataset"] for r in rows}
        known = [d for n, d in self.datasets.items() if n in used]
        return specs, datasets_table(self.spark, known), rows

    def _gated(self, row) -> tuple:
        """The spec row as the gates see it: no window where the dataset has no dates to check."""
        ds = self.datasets.get(row["dataset"])
        out = row.asDict()
        if ds is not None and not ds.checked:
            out["n"] = out["unit"] = None
        return tuple(out.values())

    def check_inputs(self, steps: Sequence[Step], parsed: list | None = None) -> None:
        """Every input and output must be a declared dataset (a produced
        one too: the runner writes and reads it by its declaration), every
        ``params:`` input a given parameter, and no step may overwrite a
        dataset it reads (the plan would read what it replaces).

        The parsed spec rows are configuration already on the driver, so the
        check is a set difference there (the same rule as the
        :func:`daybook.operators.gating.unsatisfied_inputs` table operator).
        """
        for step in steps:
            ins = {s.split(":", 1)[0] for _, s in step.input_specs() if not s.startswith(PARAMS)}
            outs = {s.split(":", 1)[0] for s in step.output_specs()}
            both = sorted(ins & outs)
            if both:
                raise ValueError(f"step {step.name} writes {both}, which it also reads")
            lacking = sorted(s for _, s in step.input_specs() if s.startswith(PARAMS) and s[len(PARAMS):] not in self.params)
            if lacking:
                raise ValueError(f"step {step.name} needs {lacking}, which are not given")
        if parsed is None:
            parsed = specs_table(self.spark, steps).collect()
        for direction in ("input", "output"):
            names = sorted({r["dataset"] for r in parsed if r["direction"] == direction} - set(self.datasets))
            if names:
                raise ValueError(f"step {direction}(s) {names} are not declared datasets")

    def plan(self, steps: Sequence[Step], processing_date) -> DataFrame:
        """Dry run: the decision of every step against the current data."""
        validate_window(processing_date, 1, "day")
        specs, dsets, _ = self._tables(steps)
        inv = inventory_for(self.spark, dsets, specs, processing_date, lenient=self._output_only(steps))
        return gate_decision(specs, dsets, inv, processing_date)

    @staticmethod
    def _output_only(steps: Sequence[Step]) -> set[str]:
        """Datasets no step reads: a failure to list them means "incomplete"."""
        ins = {s.split(":", 1)[0] for st in steps for _, s in st.input_specs() if not s.startswith(PARAMS)}
        outs = {s.split(":", 1)[0] for st in steps for s in st.output_specs()}
        return outs - ins

    # -- execution -------------------------------------------------------
    def _read(self, ds: Dataset, processing_date, n, unit) -> DataFrame:
        if ds.kind == "folder":
            return read_folders(
                self.spark, ds.location, file_format=ds.file_format, processing_date=processing_date, n=n, unit=unit or "day",
                schema=ds.schema, options=ds.options,
            )
        if ds.kind == "partitioned":
            return read_partitioned(
                self.spark, ds.location, file_format=ds.file_format, partition_column=ds.partition_column,
                processing_date=processing_date, n=n if ds.partition_column else None, unit=unit or "day",
                schema=ds.schema, options=ds.options,
                filters=list(ds.filters) if isinstance(ds.filters, tuple) else ds.filters,
            )
        return read_table(
            self.spark, ds.location, partition_column=ds.partition_column, processing_date=processing_date,
            n=n, unit=unit or "day", filters=list(ds.filters) if isinstance(ds.filters, tuple) else ds.filters,
        )

    def _write(self, ds: Dataset, df: DataFrame, processing_date) -> None:
        if ds.kind == "folder":
            write_folder(df, ds.location, processing_date, file_format=ds.file_format, mode=ds.save_mode)
        elif ds.kind == "partitioned":
            write_partitioned(df, ds.location, ds.partition_column, file_format=ds.file_format, mode=ds.save_mode, overwrite=ds.overwrite)
        else:
            save_table(df, ds.location, mode=ds.save_mode, partition_by=ds.partition_column)

    def _log_error(self, run_id, steps, started, seq, t0, detail) -> None:
        """The failed step and its run, closed with status ERROR."""
        if not self.run_log:
            return
        step = steps[seq]
        self.run_log.append_step(
            run_id=run_id, seq=seq, name=step.name, func=step.func, status="ERROR", start_time=t0, finish_time=_now(),
            inputs=[s for _, s in step.input_specs()], outputs=step.output_specs(), tags=step.tags, detail=detail,
        )
        self.run_log.append_run(run_id=run_id, status="ERROR", start_time=started, finish_time=_now(), nodes=[s.name for s in steps])

    def run(self, steps: Sequence[Step], processing_date, run_id: str | None = None) -> DataFrame:
        """Run the steps; returns ``(step, seq, status, reason, detail)`` rows.

        ``seq`` counts the steps in the order in which they run, whatever the order of their declaration.
        """
        spec = validate_window(processing_date, 1, "day")
        run_id = run_id or uuid.uuid4().hex
        parsed = specs_table(self.spark, steps).collect()  # every spec parsed in one small job
        self.check_inputs(steps, parsed)
        steps = in_dependency_order(steps)
        started = _now()
        if self.run_log:
            self.run_log.append_run(run_id=run_id, status="RUNNING", start_time=started, nodes=[s.name for s in steps])
        results = []
        for seq, step in enumerate(steps):
            t0 = _now()
            try:
                specs, dsets, rows = self._tables([step], parsed)
                inv = inventory_for(self.spark, dsets, specs, spec.processing_date, lenient=self._output_only([step]))
                decision = gate_decision(specs, dsets, inv, spec.processing_date).first() if rows else None
            except Exception as err:
                self._log_error(run_id, steps, started, seq, t0, f"gate of step {step.name} failed: {err}")
                raise
            if decision is None:  # a step with no declared inputs or outputs always runs
                decision = {"decision": "RUN", "reason": None, "missing_inputs": []}
            windows = {(r["direction"], r["pos"]): r for r in rows}
            if decision["decision"] == "SKIP":
                if decision["reason"] == "inputs":
                    detail = f"skipped: inputs lack data: {list(decision['missing_inputs'])}"
                else:
                    detail = f"skipped: outputs {step.output_specs()} already complete"
                status, reason = "SKIP", decision["reason"]
            else:
                if self.run_log:
                    self.run_log.append_step(
                        run_id=run_id, seq=seq, name=step.name, func=step.func, status="RUNNING", start_time=t0,
                        inputs=[s for _, s in step.input_specs()], outputs=step.output_specs(), tags=step.tags,
                    )
                try:
                    args, kwargs = [], {}
                    for pos, (arg, text) in enumerate(step.input_specs()):
                        if text.startswith(PARAMS):
                            df = self.params[text[len(PARAMS):]]
                        else:
                            r = windows[("input", pos)]
                            df = self._read(self.datasets[r["dataset"]], spec.processing_date, r["n"], r["unit"])
                        if arg is None:
                            args.append(df)
                        else:
                            kwargs[arg] = df
                    out = step.func(*args, **kwargs)
                    if out is None:
                        outs = []
                    else:
                        outs = list(out) if isinstance(out, (list, tuple)) else [out]
                    if len(outs) != len(step.output_specs()):
                        raise ValueError(
                            f"step {step.name} returned {len(outs)} frame(s) for {len(step.output_specs())} output(s)"
                        )
                    for pos, df in enumerate(outs):
                        r = windows[("output", pos)]
                        self._write(self.datasets[r["dataset"]], df, spec.processing_date)
                    status, reason, detail = "SUCCESS", None, None
                except Exception as err:
                    self._log_error(run_id, steps, started, seq, t0, f"step {step.name} failed: {err}")
                    raise
            if self.run_log:
                self.run_log.append_step(
                    run_id=run_id, seq=seq, name=step.name, func=step.func, status=status, start_time=t0,
                    finish_time=_now(), inputs=[s for _, s in step.input_specs()], outputs=step.output_specs(),
                    tags=step.tags, detail=detail,
                )
            results.append((step.name, seq, status, reason, detail))
        if self.run_log:
            self.run_log.append_run(run_id=run_id, status="SUCCESS", start_time=started, finish_time=_now(), nodes=[s.name for s in steps])
        return self.spark.createDataFrame(results, RESULT_SCHEMA)
