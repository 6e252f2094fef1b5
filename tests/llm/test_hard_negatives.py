"""Hard negatives against brute force: ties, copies, odd rows, small shards, and pruning by length and coordinates."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import hard_negatives as hn
from daybook.llm.hard_negatives import Bucket, hard_negatives, quantised

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, key string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1, "k", 0.5) for i, v, y in rows], SCHEMA)


def brute(rows):
    seen = {}
    for i, v, y in rows:
        if i is not None and v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v):
            q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
            seen[i, y, q] = None
    rows = list(seen)

    def score(p, q):
        return sum(a * b for a, b in zip(p, q, strict=False))

    out = set()
    for i, y, q in rows:
        if i % 100:
            continue
        others = sorted((-score(q, p), j) for j, z, p in rows if j != i and z == y)[:5]
        negatives = [(-score(q, p), j) for j, z, p in rows if j != i and z != y]
        for s, positive in others:
            inside = sorted(x for x in negatives if 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out |= {(i, positive, k, j, -s, -x) for k, (x, j) in enumerate(inside, 1)}
    return out


def found(spark, rows, **sizes):
    label = F.col("label")
    out = hard_negatives(quantised(frame(spark, rows), "vec_id", "embedding", label), F.col("id") % 100 == 0, **sizes)
    return sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(n, seed, width=6, labels=3):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        kind = draw.random()
        base = [draw.gauss(0, 1) for _ in range(width)]
        if kind < 0.3:  # copies and near copies: many ties
            base = [1.0, 0.5] + [0.0] * (width - 2)
        scale = draw.choice((0.1, 1.0, 1.0, 30.0))
        out.append((i * draw.choice((1, 1, 20)), [x * scale for x in base], draw.randrange(labels)))
    return list({r[0]: r for r in out}.values())


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_anchors": 2}])
def test_matches_brute_force(spark, sizes, monkeypatch):
    rows = vectors(300, 7)
    assert len([r for r in rows if r[0] % 100 == 0]) > 5
    got = found(spark, rows, **sizes)
    assert got == sorted(brute(rows)) and len(got) > 30


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(80, 3) + [
        (100, [1.0, 0.0], 0), (200, [], 1), (300, None, 1), (400, [1.0, None], 1), (500, [nan, 1.0], 1), (600, [inf], 2),
        (700, [0.0] * 6, 1), (800, [1.0] * 6, None), (None, [1.0] * 6, 1), (900, [0.3] * 9, 0), (900, [0.3] * 9, 0),
    ]
    rows = [r for k, r in enumerate(rows) if r[0] not in {x[0] for x in rows[:k]} or r[0] in (900, None)]
    assert found(spark, rows) == sorted(brute(rows))
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0], 1)]) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_ranges_prune_and_lose_nothing():
    draw = np.random.default_rng(5)
    centres = np.eye(40)[:20] + 0.05 * draw.normal(size=(20, 40))
    vectors_ = np.floor(256 * (centres[draw.integers(0, 20, 4000)] + 0.03 * draw.normal(size=(4000, 40)))).astype(np.int64)
    lengths = np.sqrt((vectors_.astype(float) ** 2).sum(axis=1))
    bucket = Bucket(np.arange(4000), vectors_, lengths)
    kept = 0
    for i in range(40):
        q = vectors_[i].astype(float)
        unit = q / np.linalg.norm(q)
        least = 0.8 * float(np.sort(vectors_ @ vectors_[i])[-20])
        focus = np.argsort(-np.abs(unit))[: hn.FOCUS]
        at = bucket.candidates(unit, focus, least / (np.linalg.norm(q) * bucket.longest))
        assert set(np.flatnonzero(vectors_ @ vectors_[i] >= least)) <= set(at.tolist())
        kept += len(at)
    assert kept < 0.2 * 40 * 4000


def test_short_buckets_are_left_out(monkeypatch):
    monkeypatch.setattr(hn, "BUCKET_ROWS", 10)
    ids, labels = list(range(100)), [1] * 100
    rows = pa.table({"id": ids, "label": pa.array(labels, pa.int64()), "v": [[1000 - 10 * i, 1] for i in ids]})
    shard = hn.Shard(rows, 2)
    buckets = hn.buckets_of(np.arange(100), shard.vectors, shard.lengths)
    best = hn.Best(5)
    seen = 0
    for at, scores in hn.search(shard, buckets, shard.vectors[0], best.least):
        best.add(scores, shard.ids[at])
        seen += len(at)
    assert best.ids.tolist() == [0, 1, 2, 3, 4] and seen == 10


def test_large_values_are_exact():
    rows = pa.table({"id": [1, 2], "label": pa.array([1, 1], pa.int64()), "v": [[2**31 + 1, 3], [5, 7]]})
    shard = hn.Shard(rows, 2)
    assert shard.scores(np.array([0]), np.array([2**30 + 1, 1])).tolist() == [(2**31 + 1) * (2**30 + 1) + 3]
