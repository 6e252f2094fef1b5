"""Declaring steps and datasets (G3, G4) and turning them into tables.

A step is a Python callable from DataFrames to DataFrame(s) plus the specs
of what it reads and writes (``"raw:5d"``, ``["a:1m", "b:1m"]`` or
``{"arg": "a:1m"}``).  Datasets say where a name lives and how it is laid
out.  Both are small configuration; the library turns them into two
DataFrames (``specs`` and ``datasets``) so that windows, inventories and
decisions are computed by Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.specs import parse_spec

KINDS = ("folder", "partitioned", "table")


@dataclass(frozen=True)
class Dataset:
    """Where a dataset lives.

    ``kind``: ``folder`` (``root/<date>/``, period-end windows),
    ``partitioned`` (``root/<col>=<date>/``) or ``table`` (catalog table name).
    ``validate`` turns the input completeness check on.  Without a partition
    column a ``partitioned`` or ``table`` dataset is read and written whole and
    has no completeness to check.  ``schema`` and ``options`` go to the reader;
    ``overwrite`` is ``dynamic`` (touched partitions) or ``static`` (the whole folder).
    """

    name: str
    kind: str
    location: str
    partition_column: str | None = None
    validate: bool = True
    file_format: str = "parquet"
    save_mode: str = "overwrite"
    filters: str | tuple[str, ...] | None = None
    schema: str | None = None
    options: Mapping[str, str] | None = None
    overwrite: str = "dynamic"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"dataset {self.name!r}: kind must be one of {KINDS}, not {self.kind!r}")
        if self.overwrite not in ("dynamic", "static"):
            raise ValueError(f"dataset {self.name!r}: overwrite must be 'dynamic' or 'static', not {self.overwrite!r}")

    @property
    def checked(self) -> bool:
        """Can the gates ask which dates it holds?"""
        return self.kind == "folder" or bool(self.partition_column)


@dataclass
class Step:
    """One step (G3): ``func(*inputs) -> output(s)``.

    With a dict of inputs the keys are the function's argument names and the
    values the specs (the argument-to-dataset mapping is kept).  An input
    ``params:<name>`` is a value of the run's parameters, not a dataset.
    """

    name: str
    func: Callable[..., DataFrame | Sequence[DataFrame]]
    inputs: str | Sequence[str] | Mapping[str, str] | None
    outputs: str | Sequence[str] | None
    tags: Sequence[str] = field(default_factory=tuple)

    def input_specs(self) -> list[tuple[str | None, str]]:
        if self.inputs is None:
            return []
        if isinstance(self.inputs, str):
            return [(None, self.inputs)]
        if isinstance(self.inputs, Mapping):
            return [(k, v) for k, v in self.inputs.items()]
        return [(None, s) for s in self.inputs]

    def output_specs(self) -> list[str]:
        if self.outputs is None:
            return []
        return [self.outputs] if isinstance(self.outputs, str) else list(self.outputs)


SPECS_SCHEMA = "step string, seq int, direction string, arg string, pos int, spec string"


PARAMS = "params:"


def specs_rows(steps: Sequence[Step]) -> list[tuple]:
    rows = []
    for seq, s in enumerate(steps):
        for pos, (arg, spec) in enumerate(s.input_specs()):
            if not spec.startswith(PARAMS):
                rows.append((s.name, seq, "input", arg, pos, spec))
        for pos, spec in enumerate(s.output_specs()):
            rows.append((s.name, seq, "output", None, pos, spec))
    return rows


PARSED_SPECS_SCHEMA = (
    "step string, seq int, direction string, arg string, pos int, spec string, dataset string, n int, unit string"
)


def parse_specs(raw: DataFrame) -> DataFrame:
    """Spec texts → ``(step, seq, direction, arg, pos, spec, dataset, n, unit)``."""
    return raw.select("*", parse_spec("spec").alias("_p")).select(
        "step", "seq", "direction", "arg", "pos", "spec",
        F.col("_p.name").alias("dataset"), F.col("_p.n").alias("n"), F.col("_p.unit").alias("unit"),
    )


def resolve_specs(specs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Every spec row with its dataset's declaration (nulls where there is none).

    The size of the datasets table is not proven here, so no hint is given:
    adaptive execution picks the strategy from the measured size.
    """
    return specs.join(datasets, "dataset", "left")


def specs_table(spark: SparkSession, steps: Sequence[Step]) -> DataFrame:
    return parse_specs(spark.createDataFrame(specs_rows(steps), SPECS_SCHEMA))


def in_dependency_order(steps: Sequence[Step]) -> list[Step]:
    """The steps so that each one comes after all that write what it reads.

    The frontier holds the steps that wait for no other; the one declared first
    leaves it next, so steps keep the order of their declaration wherever their
    datasets allow it, and so do two steps that write one dataset. A cycle is
    refused.
    """
    def names(specs) -> set[str]:
        return {x.split(":", 1)[0].strip() for x in specs if not x.startswith(PARAMS)}

    reads = [names(x for _, x in s.input_specs()) for s in steps]
    writers: dict[str, list[int]] = {}
    for k, s in enumerate(steps):
        for name in names(s.output_specs()):
            writers.setdefault(name, []).append(k)
    before = [{w for name in reads[k] for w in writers.get(name, ()) if w != k} for k in range(len(steps))]
    for order in writers.values():
        for earlier, later in zip(order, order[1:], strict=False):
            before[later].add(earlier)
    after: dict[int, list[int]] = {}
    for k, waits in enumerate(before):
        for w in waits:
            after.setdefault(w, []).append(k)
    frontier = [k for k, waits in enumerate(before) if not waits]
    out: list[Step] = []
    while frontier:
        k = heapq.heappop(frontier)
        out.append(steps[k])
        for later in after.get(k, ()):
            before[later].discard(k)
            if not before[later]:
                heapq.heappush(frontier, later)
    if len(out) < len(steps):
        raise ValueError(f"steps {sorted(s.name for k, s in enumerate(steps) if before[k])} wait for each other")
    return out


DATASETS_SCHEMA = "dataset string, kind string, location string, partition_column string, validate boolean"


def datasets_table(spark: SparkSession, datasets: Mapping[str, Dataset] | Sequence[Dataset]) -> DataFrame:
    items = datasets.values() if isinstance(datasets, Mapping) else datasets
    rows = [(d.name, d.kind, d.location, d.partition_column, d.validate and d.checked) for d in items]
    return spark.createDataFrame(rows, DATASETS_SCHEMA)
