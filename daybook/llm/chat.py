"""Chat formatting (6): minimum-cost role repair, then rendering.

A legal conversation is an optional system turn, then user and assistant turns
in alternation from a user turn to an assistant turn. Dynamic programming over
that automaton finds the cheapest way to make the turns legal: keep a turn,
merge it into the one before, give it another role, or insert an empty turn.

The cheapest costs from any state to any state of a run of turns form a
min-plus matrix, and matrices of consecutive runs multiply. Long conversations
are therefore cut into runs of ``RUN`` turn numbers; each run is reduced to its
matrix in one task, the few matrices of a conversation give the state at every
cut, and each run is then repaired and rendered on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import broadcast_if_small, stored

RUN = 2048
ROLES = ("system", "user", "assistant")
MERGE, INSERT, RELABEL, RELABEL_SYSTEM = 1, 2, 3, 4
#: States: the role of the last turn written (as in ROLES), or 3 before the first.
START = 3
_NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
INF = 1 << 40


def relabel_cost(role: str | None, new: int) -> int:
    """Cost of writing a turn of ``role`` as ``ROLES[new]``; unknown and null roles cost as user or assistant do."""
    if role == ROLES[new]:
        return 0
    return RELABEL_SYSTEM if role == "system" or ROLES[new] == "system" else RELABEL


def _moves() -> dict[tuple[int, int], list[tuple[int, int, tuple[int, ...], bool]]]:
    """For every pair of states, how a turn leads from one to the other: ``(cost, role, inserted, merged)``."""
    out: dict[tuple[int, int], list] = {}
    for state in (0, 1, 2, START):
        if state != START:
            out.setdefault((state, state), []).append((MERGE, state, (), True))
        paths = [(state, ())]
        for _ in range(3):  # no more than two empty turns are ever needed
            for at, inserted in paths:
                for role in _NEXT[at]:
                    out.setdefault((state, role), []).append((INSERT * len(inserted), role, inserted, False))
            paths = [(role, (*inserted, role)) for at, inserted in paths for role in _NEXT[at]]
    return out


_MOVES = _moves()


def turn_options(role: str | None) -> dict[tuple[int, int], tuple[int, int, tuple[int, ...], bool]]:
    """The cheapest move of a turn of ``role`` for every pair of states; ties: fewer insertions, then no merge."""
    return {
        pair: min(((c + relabel_cost(role, new), new, ins, m) for c, new, ins, m in moves), key=lambda x: (x[0], len(x[2]), x[3], x[2]))
        for pair, moves in _MOVES.items()
    }


_OPTIONS = {r: turn_options(r) for r in (*ROLES, None)}


def _options(role):
    return _OPTIONS.get(role if role in ROLES else None)


def run_matrix(roles: list[str | None]) -> list[list[int]]:
    """Cheapest cost of all the turns from every state to every state."""
    rows = []
    for start in range(4):
        best = [0 if s == start else INF for s in range(4)]
        for role in roles:
            best = _advance(best, _options(role))[0]
        rows.append(best)
    return rows


def _advance(best: list[int], options) -> tuple[list[int], list[int]]:
    new, back = [INF] * 4, [0] * 4
    for (a, b), (cost, *_) in options.items():
        if best[a] + cost < new[b]:
            new[b], back[b] = best[a] + cost, a
    return new, back


#: Cost and turns of the ending from each state: a user turn gets an empty answer, a system turn an empty exchange.
ENDING = {START: (0, ()), 0: (2 * INSERT, (1, 2)), 1: (INSERT, (2,)), 2: (0, ())}


def cut_states(matrices: list[list[list[int]]]) -> tuple[int, list[int]]:
    """Total cost, and the state before each run and at the end."""
    best, backs = [INF, INF, INF, 0], []
    for m in matrices:
        pairs = [min((best[a] + m[a][b], a) for a in range(4)) for b in range(4)]
        best, back = [p[0] for p in pairs], [p[1] for p in pairs]
        backs.append(back)
    total, end = min((best[s] + ENDING[s][0], s) for s in range(4))
    states = [end]
    for back in reversed(backs):
        states.append(back[states[-1]])
    return total, states[::-1]


def repair_run(roles: list[str | None], begin: int, end: int) -> list[tuple[int, tuple[int, ...], bool]]:
    """``(role, roles inserted before, merged)`` of every turn on the cheapest way from ``begin`` to ``end``."""
    best, backs = [0 if s == begin else INF for s in range(4)], []
    for role in roles:
        best, back = _advance(best, _options(role))
        backs.append(back)
    out, state = [], end
    for role, back in zip(reversed(roles), reversed(backs), strict=True):
        before = back[state]
        _, new, inserted, merged = _options(role)[before, state]
        out.append((new, inserted, merged))
        state = before
    return out[::-1]


def render_run(turns: list[tuple[str | None, str | None]], begin: int, end: int, last: bool) -> tuple[str, int, int, int, int]:
    """Text of a run, and how many turns it writes, merges, relabels and inserts.

    A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``; a merged turn follows after a blank line.
    """
    out, open_, written, merged, relabelled, inserted = [], begin != START, 0, 0, 0, 0
    close = "<|im_end|>\n"
    for (role, text), (new, before, merge) in zip(turns, repair_run([r for r, _ in turns], begin, end), strict=True):
        relabelled += role != ROLES[new]
        if merge:
            merged += 1
            out.append("\n\n" + (text or ""))
            continue
        if open_:
            out.append(close)
        out += [f"<|im_start|>{ROLES[r]}\n{close}" for r in before]
        out.append(f"<|im_start|>{ROLES[new]}\n{text or ''}")
        open_, written, inserted = True, written + 1 + len(before), inserted + len(before)
    if last:
        if open_:
            out.append(close)
        extra = ENDING[end][1]
        out += [f"<|im_start|>{ROLES[r]}\n{close}" for r in extra]
        written, inserted = written + len(extra), inserted + len(extra)
    return "".join(out), written, merged, relabelled, inserted


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches, grouped by their first ``keys`` columns across batch borders; equal rows count once."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[:keys] == key and row[keys:] == rows[-1]:
                continue
            if rows and row[:keys] != key:
                yield key, rows
                rows = []
            key = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield key, rows


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", run: int = RUN) -> DataFrame:
    """``(conv_id, part, n_turns, cost, n_written, n_merged, n_relabelled, n_inserted, rendered)``.

    One row per run of a conversation (a single one, part 0, up to ``run`` turn numbers); a
    conversation's text is its parts in order. ``cost`` is the whole conversation's. Turns are taken by
    number, null first, ties by role and text; rows equal in all four columns count once. Roles are
    compared in lower case without blanks around them. A null text is empty, a null ``conv_id`` is a conversation.
    """
    conv_type = turns.schema[conv_col].dataType.simpleString()
    part = F.coalesce(F.floor(F.col(turn_col).cast("long") / run), F.lit(-(1 << 40))).cast("long")
    rows = turns.select(
        F.col(conv_col).alias("conv"), part.alias("part"), F.col(turn_col).cast("long").alias("turn"),
        F.lower(F.trim(F.col(role_col))).alias("role"), F.col(text_col).alias("text"),
    )

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _groups(batches, 2):
            yield pa.RecordBatch.from_pylist([{"conv": key[0], "part": key[1], "costs": sum(run_matrix([r[1] for r in held]), [])}], schema=matrix_schema(batch_type))

    batch_type = _arrow_type(turns, conv_col)
    order = ("conv", "part", "turn", "role", "text")
    several = rows.groupBy("conv").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).withColumn("k", F.struct("conv"))
    # Only conversations of several runs need matrices; the others start at START. Texts stay behind.
    long_ = broadcast_if_small(stored(several.where("lo <> hi").select("k"), "long"))
    said = rows.select("conv", "part", "turn", "role", F.xxhash64("text").alias("said"))
    runs = said.withColumn("k", F.struct("conv")).join(long_, "k", "left_semi").drop("k")
    runs = runs.repartition("conv", "part").sortWithinPartitions("conv", "part", "turn", "role", "said")
    costs = runs.mapInArrow(matrices, f"conv {conv_type}, part long, costs array<long>")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _groups(batches, 1):
            total, at = cut_states([[m[4 * i : 4 * i + 4] for i in range(4)] for _, m in held])
            yield pa.RecordBatch.from_pylist(
                [{"conv": key[0], "part": p, "cost": total, "begin": at[i], "end": at[i + 1], "nth": i, "last": i == len(held) - 1} for i, (p, _) in enumerate(held)],
                schema=pa.schema([("conv", batch_type), ("part", pa.int64()), ("cost", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("nth", pa.int64()), ("last", pa.bool_())]),
            )

    cuts = costs.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(states, f"conv {conv_type}, part long, cost long, begin int, end int, nth long, last boolean")
    cuts = broadcast_if_small(stored(cuts.select(F.struct("conv", "part").alias("c"), "cost", "begin", "end", "nth", "last"), "cuts"))
    whole = rows.withColumn("c", F.struct("conv", "part")).join(cuts, "c", "left").select(*order, "cost", "begin", "end", "nth", "last")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (conv, _), held in _groups(batches, 2):
            said = [(r[1], r[2]) for r in held]
            cost, begin, end, nth, last = held[0][3:]
            if cost is None:
                cost, (begin, end) = cut_states([run_matrix([r for r, _ in said])])
                nth, last = 0, True
            text, *n = render_run(said, begin, end, last)
            out.append((conv, nth, len(said), cost, *n, text))
            if len(out) >= 500:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    names = ("n_turns", "cost", "n_written", "n_merged", "n_relabelled", "n_inserted")

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        types = [batch_type, *[pa.int64()] * 7, pa.large_string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["conv", "part", *names, "rendered"])

    schema = f"conv {conv_type}, part long, " + ", ".join(f"{n} long" for n in names) + ", rendered string"
    ready = whole.repartition("conv", "part").sortWithinPartitions(*order)
    return ready.mapInArrow(render, schema).withColumnRenamed("conv", conv_col)


def matrix_schema(conv: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", conv), ("part", pa.int64()), ("costs", pa.list_(pa.int64()))])


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
