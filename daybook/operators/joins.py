"""Date-keyed inner joins that keep only the left columns.

``left ⋈ right ON left.k = right.k`` projected to the left columns returns
each left row once per matching right row.  Only the *number* of matches per
key matters, so the right side is reduced to ``(key, count)`` first: a
partial aggregate that combines map-side.  The join then runs against that
table and each left row is repeated ``count`` times.

A count above ``CHUNK`` is cut into several chunk rows of at most ``CHUNK``
before the join, so no row builds an array longer than ``CHUNK``; with
``spread`` the joined rows are dealt out again before they are repeated, and
no task repeats a hot date alone.  A right side is broadcast only where the caller states a
bound for *that* side (a window of n days); otherwise adaptive execution
decides from the measured size, and splits a hot key on the left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sides with a stated bound of at most this many keys are broadcast.
BROADCAST_KEY_LIMIT = 1_000_000
#: Longest array that repeats one row.
CHUNK = 4096


def key_counts(right: DataFrame, key: str, alias: str) -> DataFrame:
    """``(alias_k, alias_n)``: matches per non-null key."""
    return (
        right.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(f"{alias}_k"))
        .agg(F.count(F.lit(1)).alias(f"{alias}_n"))
    )


def join_keep_left(left: DataFrame, rights: Sequence[tuple], *, chunk: int = CHUNK, spread: bool = False, strategy: str | None = None) -> DataFrame:
    """Chain of inner equi-joins, each ``(right, left_key, right_key[, keys_bound])``,
    that returns only ``left``'s columns, with join multiplicity preserved.

    T1/T2: one right side; T3: two right sides keyed on left columns.
    NULL keys never match, as in an inner join.  ``keys_bound``: a proven
    bound on the distinct keys of that right side, or None.  ``spread`` deals
    the joined rows out again before they are repeated, for keys whose count
    is far above ``chunk``; it costs a shuffle of the left rows. ``strategy``
    hints the join (``merge``, ``shuffle_hash``): sides that are bucketed alike
    by their keys (:func:`daybook.sinks.catalog.save_bucketed`) are then joined
    where they lie, without an exchange.
    """
    out = left
    for i, (right, left_key, right_key, *bound) in enumerate(rights):
        k, n = f"_j{i}_k", f"_j{i}_n"
        counts = key_counts(right, right_key, f"_j{i}")
        small = bool(bound) and bound[0] is not None and bound[0] <= BROADCAST_KEY_LIMIT
        counts = counts.select(
            k, F.col(n).alias("_all"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({n} - 1) div {chunk}"))).alias("_chunk")
        ).select(k, F.least(F.lit(chunk).cast("bigint"), F.col("_all") - F.col("_chunk") * chunk).alias(n))
        if small:
            counts = F.broadcast(counts)
        elif strategy:
            counts = counts.hint(strategy)
        met = out.join(counts, out[left_key] == counts[k], "inner").select(*left.columns, n)
        if spread:
            met = met.hint("rebalance")
        reps = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))).alias("_rep")
        out = met.select(*[F.col(c) for c in left.columns], reps).drop("_rep")
    return out


def join_on_date(
    left: DataFrame, right: DataFrame, left_key: str = "processed_date", right_key: str = "created_at",
    *, keys_bound: int | None = None, chunk: int = CHUNK, spread: bool = False, strategy: str | None = None,
) -> DataFrame:
    """T1 (``processed_date = created_at``) and T2 (other key names)."""
    return join_keep_left(left, [(right, left_key, right_key, keys_bound)], chunk=chunk, spread=spread, strategy=strategy)


def join_on_two_dates(
    left: DataFrame,
    mapping: DataFrame,
    third: DataFrame,
    left_key: str = "processed_date",
    mapping_key: str = "primary_date",
    third_key: str = "processed_date",
    *,
    mapping_bound: int | None = None,
    third_bound: int | None = None,
    chunk: int = CHUNK,
    spread: bool = False,
    strategy: str | None = None,
) -> DataFrame:
    """Left ⋈ mapping on the mapping key, then ⋈ third on the left key."""
    sides = [(mapping, left_key, mapping_key, mapping_bound), (third, left_key, third_key, third_bound)]
    return join_keep_left(left, sides, chunk=chunk, spread=spread, strategy=strategy)


def passthrough(df: DataFrame) -> DataFrame:
    """T4: the pass-through step (no driver sleep)."""
    return df
