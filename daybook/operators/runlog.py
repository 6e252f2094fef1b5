"""The run log as an append-only table with latest-per-key views.

Each status change of a run or a step is appended as an event row; the
current state is the newest event per key.  Appends never conflict, so
concurrent writers are safe, and executors lost mid-write only leave an
uncommitted file that the commit protocol discards.

Folding uses ``max_by(struct(row), struct(order))`` per key — an aggregate
with a map-side partial step — so a key with very many events is reduced in
every map task before anything is shuffled.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# The step statuses.
STATUSES = ("RUNNING", "SUCCESS", "ERROR", "SKIP")

STEP_LOG_SCHEMA = (
    "run_id string, seq int, name string, func string, run_date string, start_time string, "
    "finish_time string, inputs array<string>, outputs array<string>, tags array<string>, "
    "confirms array<string>, namespace string, status string, detail string, event_seq bigint"
)
RUN_LOG_SCHEMA = (
    "run_id string, dag_name string, run_date string, start_time string, finish_time string, "
    "nodes array<string>, inputs array<string>, outputs array<string>, parameters array<string>, "
    "tags array<string>, namespace string, status string, event_seq bigint"
)


def latest_per_key(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """L1/L2: the newest row per key (by ``order``), all columns kept."""
    keys = list(keys)
    rest = [c for c in events.columns if c not in keys]
    folded = events.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_r")
    )
    return folded.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


class FoldedLog:
    """An append-only event table with snapshots of its folded state (L1/L2 at scale).

    ``root/events`` takes appends. :meth:`snapshot` folds everything so far into
    ``root/state/<mark>``, where ``mark`` is the wall clock (milliseconds) taken
    before the files were listed. :meth:`state` folds the newest snapshot with the
    files that arrived since: by their modification time, which Spark prunes
    files with, not by the order of the events in them. So an event that comes
    late, older than others already folded, is not lost; and since folding the
    same event twice changes nothing, ``margin_ms`` may reach back as far as
    the writers' clocks can differ. Snapshots and events are never rewritten: a
    reader that still uses an older snapshot reads the same state.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], order: Sequence[str], margin_ms: int = 60_000):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order, self.margin_ms = list(keys), list(order), margin_ms

    @property
    def events_path(self) -> str:
        return f"{self.root}/events"

    def append(self, events: DataFrame) -> None:
        events.write.mode("append").parquet(self.events_path)

    def events(self, since_ms: int | None = None) -> DataFrame:
        """All events, or those of the files that arrived at or after a time."""
        df = self.spark.read.schema(self.schema).parquet(self.events_path)
        if since_ms is None:
            return df
        return df.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since_ms)))

    def marks(self) -> list[int]:
        """Marks of the complete snapshots, oldest first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/state/*/_SUCCESS")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(x.getPath().getParent().getName()) for x in files.globStatus(path) or [])

    def snapshot(self) -> int:
        """Writes the folded state as a new snapshot; returns its mark."""
        marks = self.marks()
        mark = max(int(_dt.datetime.now().timestamp() * 1000), marks[-1] + 1 if marks else 0)
        self.state().write.mode("errorifexists").parquet(f"{self.root}/state/{mark}")
        return mark

    def state(self) -> DataFrame:
        """The newest event per key."""
        marks = self.marks()
        if not marks:
            return latest_per_key(self.events(), self.keys, self.order)
        folded = self.spark.read.schema(self.schema).parquet(f"{self.root}/state/{marks[-1]}")
        return latest_per_key(folded.unionByName(self.events(marks[-1] - self.margin_ms)), self.keys, self.order)


def max_id(df: DataFrame, column: str) -> DataFrame:
    """``coalesce(max(column), 0)`` as a one-row frame ``(max_id)``."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("max_id"))


def run_report(step_log: DataFrame, run_id: str | None = None) -> DataFrame:
    """``run_id, pos, name, status, start_time, finish_time, detail`` of a run,
    ordered by start time (then name); missing values shown as empty text.

    ``pos`` counts the steps of a run from 0; a run has as many rows as its
    configuration has steps.  With ``run_id=None`` every run is reported.
    """
    df = step_log if run_id is None else step_log.where(F.col("run_id") == run_id)
    nth = F.row_number().over(Window.partitionBy("run_id").orderBy("start_time", "name", "status", "detail")) - 1
    return df.select(
        "run_id",
        nth.cast("bigint").alias("pos"),
        "name",
        "status",
        "start_time",
        F.coalesce("finish_time", F.lit("")).alias("finish_time"),
        F.coalesce("detail", F.lit("")).alias("detail"),
    ).orderBy("run_id", "pos")


def as_text_array(df: DataFrame, column: str) -> Column:
    """A column normalised to ``array<string>``; NULL → empty array."""
    dt = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dt, ArrayType):
        return F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c.cast("string")))


def _text_list(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, dict):
        return [str(v) for v in x.values()]
    if isinstance(x, (list, tuple, set, frozenset)):
        return [str(v) for v in x]
    return [str(x)]


class RunLog:
    """An append-only run log: two :class:`FoldedLog` tables (steps and runs) and the metrics under ``root``.

    ``root`` should live in the shared folder (see
    :func:`daybook.session.shared_dir`).  Passing no RunLog to the runner turns
    logging off (L7).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._seq = 0
        self._steps = FoldedLog(spark, f"{self.root}/steps", STEP_LOG_SCHEMA, ["run_id", "name"], ["event_seq"])
        self._runs = FoldedLog(spark, f"{self.root}/runs", RUN_LOG_SCHEMA, ["run_id"], ["event_seq"])

    def _next_seq(self) -> int:
        """Event order: wall-clock microseconds, forced strictly increasing
        within this writer (a clock step backwards cannot reorder a fold)."""
        now = int(_dt.datetime.now().timestamp() * 1_000_000)
        self._seq = max(self._seq + 1, now)
        return self._seq

    def _step_row(self, *, run_id, seq, name, func, status, start_time, finish_time=None,
                  inputs=None, outputs=None, tags=None, confirms=None, namespace=None, detail=None) -> tuple:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}")
        func_name = func if isinstance(func, str) or func is None else getattr(func, "__name__", str(func))
        return (
            str(run_id), int(seq), name, func_name, start_time[:10], start_time, finish_time,
            _text_list(inputs), _text_list(outputs), _text_list(tags), _text_list(confirms),
            namespace, status, detail, self._next_seq(),
        )

    def append_step(self, **event) -> None:
        """L1, single form: one step event (one small append)."""
        self.append_steps([event])

    def append_steps(self, events: list[dict]) -> None:
        """L1, batch form: many step events in one append job."""
        rows = [self._step_row(**e) for e in events]
        if rows:
            self._steps.append(self.spark.createDataFrame(rows, STEP_LOG_SCHEMA))

    def append_run(self, *, run_id, status, start_time, finish_time=None, nodes=None, dag_name=None,
                   inputs=None, outputs=None, parameters=None, tags=None, namespace=None):
        row = (
            str(run_id), dag_name, start_time[:10], start_time, finish_time, _text_list(nodes),
            _text_list(inputs), _text_list(outputs), _text_list(parameters), _text_list(tags),
            namespace, status, self._next_seq(),
        )
        self._runs.append(self.spark.createDataFrame([row], RUN_LOG_SCHEMA))

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/metrics"

    def record_metrics(self, run_id: str, metrics: DataFrame) -> None:
        """M3: append a run's ``(metric, value[, text])`` rows, tagged with the run id."""
        text = F.col("text").cast("string") if "text" in metrics.columns else F.lit(None).cast("string").alias("text")
        metrics.select(
            F.lit(str(run_id)).alias("run_id"), "metric", F.col("value").cast("double").alias("value"), text
        ).write.mode("append").parquet(self.metrics_path)

    def metrics(self, run_id: str | None = None) -> DataFrame:
        """``(run_id, metric, value, text)``; a parameter that is no number has only its ``text``."""
        df = self.spark.read.schema("run_id string, metric string, value double, text string").parquet(self.metrics_path)
        return df if run_id is None else df.where(F.col("run_id") == run_id)

    def step_events(self) -> DataFrame:
        return self._steps.events()

    def run_events(self) -> DataFrame:
        return self._runs.events()

    def steps(self) -> DataFrame:
        """Current state per ``(run_id, name)``: the newest snapshot and what came after it."""
        return self._steps.state()

    def runs(self) -> DataFrame:
        """Current state per ``run_id``."""
        return self._runs.state()

    def report(self, run_id: str | None = None) -> DataFrame:
        return run_report(self.steps(), run_id)

    def compact(self) -> None:
        """Snapshots both tables, so that later reads fold only what arrives from now on."""
        self._steps.snapshot()
        self._runs.snapshot()
