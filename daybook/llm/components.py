"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; component = smallest id reachable.

    Each round joins the edges with the smallest neighbour of each node (a plain
    equi-join: adaptive execution splits a hub's rows) and stores the new edges,
    so lineage stays one round deep. It ends when a round changes nothing; no
    edge or label reaches the driver, only a count and a checksum.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        now = stored(small.where("a <> b").distinct(), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    pairs = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return pairs.unionByName(pairs.select(F.col("component").alias("id"), "component").distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
