"""Hard negatives (12): inner-product search by length buckets and coordinate ranges.

Rows are dealt into shards by a hash, so no label, length or group of copies
makes a shard hot, and anchors into blocks; a task searches one shard for one
block. Inside a shard rows are sorted by vector length and cut into buckets.
A bucket keeps, for every coordinate, the list of its rows sorted by that
coordinate of the unit vector. For an anchor of length ``|q|`` and a least score
``s`` a row of a bucket whose longest vector is ``L`` needs a cosine of
``c = s / (|q| L)``:

* ``c > 1``: the bucket and all shorter ones hold nothing;
* otherwise, in each focus coordinate (those where the unit anchor is largest)
  the row's value lies within ``cos(acos(q_f) ± acos(c))``. Two binary searches
  cut that range out of the sorted list; the ranges of all focus coordinates are
  intersected, and what remains is verified by its exact integer score.

``s`` rises while a task goes from long to short buckets: to the k-th best
score so far, and for negatives never below the window's lower end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import stored

#: Rows of a shard, anchors of a block, rows of a bucket, focus coordinates of an anchor.
SHARD_ROWS = 16_384
BLOCK_ANCHORS = 16_384
BUCKET_ROWS = 1_024
FOCUS = 4
#: Ranges are widened by this much against rounding; the verified scores are exact.
SLACK = 1e-9

_FOUND = "key long, id long, positive_id long, positive_score long, other_id long, score long"


class Bucket:
    """Rows ``at`` of a shard, their unit vectors in lists sorted by coordinate, and the longest length."""

    def __init__(self, at: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.at, self.longest = at, float(lengths[at].max(initial=0.0))
        unit = vectors[at] / np.maximum(lengths[at], 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.values = np.take_along_axis(unit, self.order, axis=0).T.copy()
        self.order = self.order.T.astype(np.int32)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Rows that lie in the feasible range of every focus coordinate of a unit anchor."""
        if cosine <= 0 or len(self.at) == 0:
            return self.at
        reach = np.arccos(min(cosine, 1.0))
        angle = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low, high = np.cos(np.minimum(np.pi, angle + reach)) - SLACK, np.cos(np.maximum(0.0, angle - reach)) + SLACK
        spans = []
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist(), strict=True):
            x, y = np.searchsorted(self.values[f], a, "left"), np.searchsorted(self.values[f], b, "right")
            if y - x < len(self.at):
                spans.append((int(y - x), f, int(x), int(y)))
        if not spans:
            return self.at
        spans.sort()
        _, f, x, y = spans[0]
        left = self.order[f, x:y]
        for _, f, x, y in spans[1:]:
            inside = np.zeros(len(self.at), dtype=bool)
            inside[self.order[f, x:y]] = True
            left = left[inside[left]]
        return self.at[left]


def buckets_of(at: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> list[Bucket]:
    """Buckets of the rows ``at``, longest first."""
    at = at[np.argsort(-lengths[at], kind="stable")]
    return [Bucket(at[i : i + BUCKET_ROWS], vectors, lengths) for i in range(0, len(at), BUCKET_ROWS)]


class Best:
    """The first ``k`` partners so far by score, then id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(ids):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]

    def least(self) -> float:
        """A new partner needs this score at least."""
        return float(self.scores[-1]) if len(self.ids) == self.k else -np.inf


class Shard:
    """The rows of one shard as arrays; ``vectors`` are padded with zeros to one width."""

    def __init__(self, table: pa.Table, width: int):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.vectors = matrix(table.column("v"), width)
        self.floats = self.vectors.astype(np.float64)
        self.lengths = np.sqrt((self.floats**2).sum(axis=1))
        self.peak = float(np.abs(self.floats).max(initial=0.0)) * width

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products; in floating point where every partial sum is a whole number below 2**53."""
        if self.peak * float(np.abs(q).max(initial=0)) < 2**53:
            return (self.floats[at] @ q.astype(np.float64)).astype(np.int64)
        return self.vectors[at] @ q


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column of integers as rows of int64, short lists padded with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def search(shard: Shard, buckets: list[Bucket], q: np.ndarray, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified ``(rows, scores)`` of every bucket that may reach ``least()``, which may rise meanwhile."""
    length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
    unit = q / length if length else q.astype(np.float64)
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    for bucket in buckets:
        bound, need = length * bucket.longest, least()
        if need > 0 and need > bound * (1 + SLACK):
            return
        at = bucket.candidates(unit, focus, (need / bound) * (1 - SLACK) if need > 0 else 0.0)
        if len(at):
            yield at, shard.scores(at, q)


def _positives(shard: Shard, anchors: pa.Table, k: int) -> Iterator[tuple]:
    q, labels = matrix(anchors.column("q_v"), shard.vectors.shape[1]), anchors.column("q_label").to_pylist()
    by_label: dict[int, list[Bucket]] = {}
    for i, (key, own, label) in enumerate(zip(anchors.column("q_key").to_pylist(), anchors.column("q_id").to_pylist(), labels, strict=True)):
        if label not in by_label:
            by_label[label] = buckets_of(np.flatnonzero(shard.labels == label), shard.vectors, shard.lengths)
        best = Best(k)
        for at, scores in search(shard, by_label[label], q[i], best.least):
            fit = (scores >= best.least()) & (shard.ids[at] != own)
            best.add(scores[fit], shard.ids[at][fit])
        for other, score in zip(best.ids.tolist(), best.scores.tolist(), strict=True):
            yield key, own, None, None, other, score


def _negatives(shard: Shard, anchors: pa.Table, k: int, low: int, high: int) -> Iterator[tuple]:
    q = matrix(anchors.column("q_v"), shard.vectors.shape[1])
    buckets = buckets_of(np.arange(len(shard.ids)), shard.vectors, shard.lengths)
    rows = zip(*(anchors.column(c).to_pylist() for c in ("q_key", "q_id", "q_label", "q_positives")), strict=True)
    for i, (key, own, label, positives) in enumerate(rows):
        open_ = [(p["id"], p["score"], -((-low * p["score"]) // 100), high * p["score"] // 100, Best(k)) for p in positives]
        open_ = [x for x in open_ if x[2] <= x[3]]
        if not open_:
            continue

        def least(open_=open_) -> float:
            return min(max(float(x[2]), x[4].least()) for x in open_)

        for at, scores in search(shard, buckets, q[i], least):
            fit = (scores >= least()) & (shard.labels[at] != label) & (shard.ids[at] != own)
            scores, ids = scores[fit], shard.ids[at][fit]
            for _, _, lowest, highest, best in open_:
                inside = (scores >= max(lowest, best.least())) & (scores <= highest)
                best.add(scores[inside], ids[inside])
        for positive, score, _, _, best in open_:
            for other, s in zip(best.ids.tolist(), best.scores.tolist(), strict=True):
                yield key, own, positive, score, other, s


def quantised(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = 256) -> DataFrame:
    """``(id, label, v)`` of the rows that take part: ``floor(scale * x)`` of every component.

    Rows with a null id, label or vector, or with a null or non-finite component, are left out.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    taken = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    units = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return taken.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(finite).select("id", "label", units.alias("v"))


def _dealt(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int, width: int, find, *args) -> DataFrame:
    """``find`` over every pair of a shard of ``rows`` and a block of ``anchors``."""

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _FOUND.split(", ")]
        found = list(find(Shard(left, width), right, *args)) if left.num_rows and right.num_rows else []
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("shard", every(blocks).alias("block"), "id", "label", "v")
    # Names of their own: both sides come from one table, and a cogroup keeps apart what an alias keeps apart.
    right = anchors.select([F.col(c).alias(f"q_{c}") for c in anchors.columns])
    right = right.withColumn("block", F.pmod(F.hash("q_key"), F.lit(blocks))).withColumn("shard", every(shards))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(tile, _FOUND)


def hard_negatives(
    rows: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
    shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` holds ``(id long, label long, v array<long>)`` as :func:`quantised` gives them; ``anchor`` says which
    of them are anchors. A score is the integer inner product (exact while it fits a long; vectors of unequal
    size are compared as if padded with zeros). Positives are the first ``n_positives`` other ids of the
    anchor's label by score, then id; for each of them come the first ``n_negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``, ranked from 1.

    Rows that are equal in all three columns count once; an anchor is never its own partner, nor is another
    row of its id. An anchor without positives, or a positive without negatives, gives no rows; so does an
    empty table. Only counts reach the driver; the best of each tile are cut to the first few per anchor
    before they are shuffled.
    """
    rows = rows.select("id", "label", "v").dropDuplicates()
    rows = stored(rows.withColumn("key", F.xxhash64("id", "label", "v")), "vectors")
    counts = rows.agg(F.count("*"), F.count(F.when(anchor, 1)), F.max(F.size("v"))).first()
    shards, blocks, width = max(1, -(-counts[0] // shard_rows)), max(1, -(-counts[1] // block_anchors)), counts[2] or 0
    rows = rows.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)).cast("int"))
    anchors = rows.where(anchor).select("key", "id", "label", "v")

    def first(found: DataFrame, n: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    found = _dealt(rows, anchors, shards, blocks, width, _positives, n_positives)
    positives = first(found, n_positives, "key").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(F.col("other_id").alias("id"), "score"))).alias("positives"))
    paired = stored(anchors.join(positives, "key"), "positives")
    found = _dealt(rows, paired, shards, blocks, width, _negatives, n_negatives, low, high)
    return first(found, n_negatives, "key", "positive_id").select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
