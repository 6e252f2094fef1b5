"""Periodic runs (13): string synchronising sets over the words of a text.

A run is a maximal stretch of words with smallest period ``q`` and at least
``max(6, 4 q)`` words. Candidates come from synchronising sets at the scales
``t = 4, 8, 16, …``: a position belongs to the set of scale ``t`` where the
smallest hash among the ``t``-word windows at ``i .. i+t`` is the first or the
last of them, so whether it does depends on ``2 t`` words only and equal
contexts agree. Windows with a period of at most ``t / 3`` have no hash there;
any other stretch of ``3 t - 1`` words holds a position in its first ``t``.

Two successive positions with the same context of ``4 t`` words, at most
``4 t + 1`` apart, propose their distance as a period. A run of period ``q``
has such a pair at distance ``q`` at every scale with ``q > t / 3``,
``5 t - 1 <= 3 q`` and ``q <= 4 t + 1``: one scale at least for each
``q >= 7``. Every proposal is extended word by word to its maximal stretch.
Highly periodic regions, which the sets leave out, are found apart: periods of
up to six words by comparing the text with itself, larger ones as stretches
that an earlier scale has found (a scale needs those of a period up to
``t / 3`` and of ``t`` words, which the scale ``t / 8`` proposes already).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import mix64, text_slices, word_hashes

#: Least words of a run, and least repeats of its period.
LEAST_WORDS = 6
REPEATS = 4
#: First scale of the synchronising sets, and the periods below what it covers.
FIRST_SCALE = 4
SMALL_PERIODS = range(1, 7)

_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)
RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of ``2 * width`` from those of ``width``."""
    return mix64(h[:-width] * _STEP + h[width:]) if len(h) > width else h[:0]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``x[i : i + width]`` for every i, from running minima of blocks of that width."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = np.full(-(-len(x) // width) * width, _FREE, dtype=np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def synchronising_set(h: np.ndarray, width: int, periodic: np.ndarray | None = None) -> np.ndarray:
    """Positions of the set of scale ``width``; ``h`` are hashes of the windows of that width.

    ``periodic`` marks the windows with a period of at most ``width / 3``.
    """
    h = np.where(periodic, _FREE, h) if periodic is not None else h
    least = _sliding_min(h, width + 1)
    n = len(least)
    return np.flatnonzero((least != _FREE) & ((h[:n] == least) | (h[width : width + n] == least)))


def _first_unequal(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common prefix, compared in growing blocks."""
    n, at, block = min(len(x), len(y)), 0, 64
    while at < n:
        differ = np.flatnonzero(x[at : at + block] != y[at : at + block])
        if len(differ):
            return at + int(differ[0])
        at, block = at + block, min(block * 2, 1 << 16)
    return n


def _stretch(w: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The maximal ``[start, end)`` around the equal words ``i`` and ``i + d`` with period ``d``."""
    right = _first_unequal(w[i : len(w) - d], w[i + d :])
    left = _first_unequal(w[:i][::-1], w[d : i + d][::-1])
    return i - left, i + d + right


def _small_stretches(w: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches ``(start, end, period)`` of the small periods, three periods long or more."""
    for p in SMALL_PERIODS:
        if len(w) <= p:
            return
        same = np.flatnonzero(w[:-p] == w[p:])
        if not len(same):
            continue
        cuts = np.flatnonzero(np.diff(same) > 1)
        starts, stops = same[np.concatenate([[0], cuts + 1])], same[np.concatenate([cuts, [len(same) - 1]])] + 1
        for k in np.flatnonzero(stops - starts >= 2 * p):
            yield int(starts[k]), int(stops[k]) + p, p


def find_runs(w: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of a sequence of word hashes, by start, then period.

    ``longest`` bounds the length of a run (texts joined by separators that occur once).
    """
    longest = len(w) if longest is None else longest
    known = list(_small_stretches(w))
    levels, width = [w], 1  # hashes of windows of 1, 2, 4, ... words
    t = FIRST_SCALE
    while 5 * t - 1 <= 3 * (longest // REPEATS):
        while width < 4 * t:
            levels.append(_doubled(levels[-1], width))
            width *= 2
        hashes, context = levels[-3], levels[-1]
        if not len(context):
            break
        periodic = None
        spans = [(s, e) for s, e, p in known if 3 * p <= t <= e - s]
        if spans:
            edges = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.add.at(edges, [s for s, _ in spans], 1)
            np.add.at(edges, [e - t + 1 for _, e in spans], -1)
            periodic = np.cumsum(edges[:-1]) > 0
        at = synchronising_set(hashes, t, periodic)
        at = at[at < len(context)]
        order = np.argsort(context[at], kind="stable")
        at = at[order]
        apart = np.diff(at)
        pair = np.flatnonzero((context[at[1:]] == context[at[:-1]]) & (apart > 0) & (apart <= 4 * t + 1))
        ends: dict[int, int] = {}
        for i, d in sorted(zip(at[pair].tolist(), apart[pair].tolist(), strict=True)):
            if i + d >= ends.get(d, 0):
                start, end = _stretch(w, i, d)
                ends[d] = end
                if end - start >= 3 * d:
                    known.append((start, end, d))
        levels, t = levels[-3:], 2 * t
    best: dict[tuple[int, int], int] = {}
    for s, e, p in known:
        if e - s >= max(LEAST_WORDS, REPEATS * p):
            best[s, e] = min(p, best.get((s, e), p))
    return sorted(((s, e, p) for (s, e), p in best.items()), key=lambda x: (x[0], x[2]))


def _text_runs(column: pa.Array, ids: list, order: Callable | None) -> Iterator[tuple]:
    """``(number of words, runs, kept words joined by one space)`` of every text."""
    for first, data, offsets in text_slices(column):
        h, _, _, firsts = word_hashes(data, offsets, lower=False)
        counts = np.diff(firsts)
        n = len(counts)
        take = np.arange(len(h))
        for k in range(n) if order is not None else ():
            places = order(ids[first + k], int(counts[k]))
            if places is not None:
                take[firsts[k] : firsts[k + 1]] = firsts[k] + places
        # One word that occurs nowhere else after each text keeps stretches inside their text.
        begin = firsts[:-1] + np.arange(n)
        w = np.empty(len(h) + n, dtype=np.uint64)
        w[begin + counts] = mix64(np.arange(n, dtype=np.uint64) + np.uint64(1 << 40))
        w[np.arange(len(h)) + np.repeat(np.arange(n), counts)] = h[take]
        found = find_runs(w, int(counts.max(initial=0)))
        edges = np.zeros(len(w) + 1, dtype=np.int64)
        np.add.at(edges, [s + p for s, _, p in found], 1)
        np.add.at(edges, [e for _, e, _ in found], -1)
        gone = np.cumsum(edges) > 0
        owner = (np.searchsorted(begin, [s for s, _, _ in found], side="right") - 1).tolist()
        runs: list[list] = [[] for _ in range(n)]
        for k, (s, e, p) in zip(owner, found, strict=True):
            runs[k].append({"start": s - int(begin[k]), "length": e - s, "period": p})
        for k in range(n):
            words = data[offsets[k] : offsets[k + 1]].tobytes().split()
            if runs[k] or order is not None:
                kept = np.flatnonzero(~gone[begin[k] : begin[k] + counts[k]])
                words = [words[i] for i in (take[firsts[k] + kept] - firsts[k]).tolist()]
            yield int(counts[k]), runs[k], b" ".join(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: Callable | None = None) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``runs`` (array of start word, length in words and period,
    by start, then period) and ``collapsed``: the words joined by one space, without those that follow the
    first period of a run.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they stand. ``order(id, n_words)`` may name the places
    from which the words of a text are read (an integer array of that length, or None for its own order).
    A null or empty text has no words, no runs and an empty ``collapsed``; equal rows and null ids all
    come back; other columns are not read. Texts are handled in slices, a long text alone; memory is
    linear in the longest text, and no rows are shuffled.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for part in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            n, runs, kept = zip(*_text_runs(part.column(1), part.column(0).to_pylist(), order), strict=True)
            arrays = [part.column(0), pa.array(n, pa.int64()), pa.array(runs, runs_type), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "runs", "collapsed"])

    taken = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return taken.mapInArrow(rows, "id long, " + RUNS).withColumnRenamed("id", id_col)


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period), null where there is none."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(ranked)
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def runs_digest(runs: Column) -> Column:
    """sha256 (lowercase hex) of a line ``start,length,period`` for every run."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(line, ""), 256)
