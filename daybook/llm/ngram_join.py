"""N-gram Jaccard join (1): a blocked sparse product of documents by word shingles.

The incidence matrix has a row per distinct shingle set and a column per
shingle. Columns are ordered from rare to frequent (by a fixed-size count
sketch over all documents), and the product is taken block by block:

1. Two rows that link share their first ``l`` common columns, and those lie
   among the first ``n - ceil(0.75 n) + l`` columns of both, with ``l`` the
   smaller of ``1 + n div 16``. Only these enter the product. Rows are exchanged
   as packed blocks of columns.
2. In a column every row meets the most central one (whose shingles are the most
   frequent); overlaps are accumulated over the blocks, and pairs below the
   size-derived bound ``l`` or length ratio are discarded. The rest is compared over the whole rows.
   Where a map task holds many rows of a column it does this itself and sends
   on one row, so a column that a third of the rows share is never gathered.
   A row that meets others in fewer than ``l`` columns links with nothing.
3. Rows linked so far form components. Columns that still hold rows of several
   components are multiplied in full, across components only, under the same
   bounds. The product is cut into tiles of two slices of rows, so that a pair's
   columns all meet in one tile and no task holds a frequent column. A pair
   inside a component cannot change it and is not looked up, so no link between
   components is lost and a group of copies is not expanded into all pairs.

Shingles are 64-bit hashes; a wrong overlap needs two of them to collide within one pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import connected_components
from daybook.llm.tables import broadcast_if_small, numbered, stored
from daybook.llm.words import column_shingles, mix64, text_slices, window_hashes, word_hashes

#: Counters of the frequency sketch: 4 MB, whatever the input.
SKETCH_BITS = 20
_SKETCH_BLOCKS = 64
#: Postings (some 10 bytes each, compressed) that one block of columns should hold.
BLOCK_POSTINGS = 50_000
#: Rows of a column above which a map task sends on the most central one alone.
LOCAL_ROWS = 64
#: Postings that a map task packs at once.
PACK_POSTINGS = 250_000


def column_sketch(docs: DataFrame, text: str) -> np.ndarray:
    """Occurrences of all shingles of all documents, counted by the top bits of their hashes."""
    width = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                h = word_hashes(data, offsets)[0]
                counts += np.bincount(window_hashes(h, 5) >> np.uint64(64 - SKETCH_BITS), minlength=width)
        parts = np.split(np.minimum(counts, 0xFFFFFFFF).astype(np.uint32), _SKETCH_BLOCKS)
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(_SKETCH_BLOCKS), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(counts, dtype=np.uint32).astype(np.int64)
                total[block] = total[block] + counts if block in total else counts
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(total), pa.int32()), "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    schema = "block int, counts binary"
    rows = docs.select(text).mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    found = np.zeros(width, dtype=np.int64)
    step = width // _SKETCH_BLOCKS
    for block, counts in rows:
        found[block * step : (block + 1) * step] += np.frombuffer(counts, dtype=np.int64)
    return found


def shared_columns(n):
    """``l``: columns that a row of ``n`` shares with any row it links to, within both rows' prefixes."""
    return 1 + n // 16


def prefix_length(n: int) -> int:
    """How many of a row's first columns are looked at: ``n - ceil(0.75 n) + l``."""
    return min(n, n - -(-3 * n // 4) + shared_columns(n)) if n else 0


def _rows(docs: DataFrame, id_col: str, text: str, sketch: np.ndarray) -> DataFrame:
    """``(doc_id, n, sig, score, prefix)``: set size, digest of the set, how frequent its shingles are, its first columns."""
    import hashlib

    counts = docs.sparkSession.sparkContext.broadcast(sketch)

    def row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sigs, scores, prefixes = [], [], [], []
            for s in column_shingles(batch.column(1)):
                seen = counts.value[s >> np.uint64(64 - SKETCH_BITS)]
                order = np.argsort(seen, kind="stable")
                scores.append(float(np.log2(1 + seen.mean())) if len(s) else 0.0)
                sizes.append(len(s))
                sigs.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                first = s[order[: prefix_length(len(s))]]
                prefixes.append(first.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(scores, pa.float32()), pa.array(prefixes, pa.binary())],
                names=["doc_id", "digest", "n", "sig", "score", "prefix"],
            )

    digest = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest")
    return docs.select(id_col, text, digest).mapInArrow(row, "doc_id long, digest long, n long, sig binary, score float, prefix binary")


#: Columns travel as 48-bit numbers. Two columns that fall together can only add
#: meetings, never hide one, and every pair is compared over whole 64-bit sets in the end.
COLUMN_BITS = 48
_POSTING = np.dtype([("col", "<u8"), ("id", "<i8"), ("n", "<i4"), ("score", "<f2"), ("comp", "<i8")])


def _planes(rows: np.ndarray) -> bytes:
    """Records as byte planes: the planes that are all zero vanish when they are compressed."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def _records(planes: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(planes, dtype=np.uint8).reshape(size, -1).T.copy().view(dtype).reshape(-1)


def _columns(prefixes: list[bytes]) -> np.ndarray:
    """The column numbers of packed prefixes, one after the other."""
    out = np.zeros((sum(map(len, prefixes)) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(b"".join(prefixes), dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _postings(ids, sizes, prefixes, scores=0, comps=0) -> np.ndarray:
    lengths = np.array([len(p) // 6 for p in prefixes], dtype=np.int64)
    out = np.zeros(int(lengths.sum()), dtype=_POSTING)
    out["col"] = _columns(prefixes)
    for name, values in (("id", ids), ("n", sizes), ("score", scores), ("comp", comps)):
        if not isinstance(values, int):
            out[name] = np.repeat(np.asarray(values), lengths)
    return out


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(4 / 3)).astype(np.uint64)


class _Meets:
    """Overlaps of pairs ``(a, b)``, and the columns in which a row ``a`` meets others as ``(a, a)``."""

    def __init__(self):
        self.parts = []

    def add(self, a, b, need):
        self.parts.append(np.stack([a, b, need], axis=1).astype(np.int64))

    def sums(self) -> np.ndarray:
        rows = np.concatenate(self.parts) if self.parts else np.zeros((0, 3), dtype=np.int64)
        rows, count = np.unique(rows, axis=0, return_counts=True)
        out = np.zeros(len(rows), dtype=_MEETING)
        out["a"], out["b"], out["need"], out["n"] = rows[:, 0], rows[:, 1], rows[:, 2], count
        return out


def _stars(p: np.ndarray, least: int, meets: _Meets) -> np.ndarray:
    """Adds the meetings of every column with at least ``least`` rows of a size class; returns the rows to send on."""
    key = mix64(p["col"] + _size_class(p["n"]))
    order = np.lexsort((p["id"], -p["score"], key))
    p, key = p[order], key[order]
    first = np.ones(len(p), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    heads, group = np.flatnonzero(first), np.cumsum(first) - 1
    size = np.diff(np.append(heads, len(p)))[group]
    many = size >= least
    leader = p[heads[group]]
    pair = many & ~first & (leader["id"] != p["id"])
    need = 1 + np.minimum(leader["n"], p["n"]) // 16
    close = pair & (4 * np.minimum(leader["n"], p["n"]) >= 3 * np.maximum(leader["n"], p["n"]))
    meets.add(leader["id"][close], p["id"][close], need[close])
    alone = many & (size > 1)
    if least <= 2:  # a row of the next size class may link too
        by_size = np.lexsort((p["n"], p["col"]))
        col, cls = p["col"][by_size], _size_class(p["n"][by_size]).astype(np.int64)
        near = (col[1:] == col[:-1]) & (cls[1:] - cls[:-1] <= 1)
        alone[by_size[1:][near]] = alone[by_size[:-1][near]] = True
    meets.add(p["id"][alone], p["id"][alone], 1 + p["n"][alone] // 16)
    return p[first | ~many]


_MEETING = np.dtype([("a", "<i8"), ("b", "<i8"), ("need", "<i4"), ("n", "<i4")])


def _pack(p: np.ndarray, blocks: int) -> dict[int, bytes]:
    at = (mix64(p["col"]) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((p["id" if "id" in p.dtype.names else "col"], at))
    at, p = at[order], p[order]
    found, first = np.unique(at, return_index=True)
    return dict(zip(found.tolist(), map(_planes, np.split(p, first[1:])), strict=True)) if len(found) else {}


_PACKED = "block long, packed binary, meets binary"
_SUMS = "a long, b long, need int, n long"


def _sum_table(rows: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(rows["a"]), "b": pa.array(rows["b"]), "need": pa.array(rows["need"]), "n": pa.array(rows["n"].astype(np.int64))})


def _batched(batches: Iterator[pa.RecordBatch], postings) -> Iterator[np.ndarray]:
    """Postings of the rows of ``batches``, about ``PACK_POSTINGS`` at a time."""
    held, size = [], 0
    for batch in batches:
        for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
            held.append(postings(part))
            size += len(held[-1])
            if size >= PACK_POSTINGS:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


def _packed_batch(packed: dict[int, bytes], meets: np.ndarray | None = None) -> pa.RecordBatch:
    """Blocks to exchange; the meetings found so far travel with the first of them."""
    blocks = list(packed) or [0]
    along = [_planes(meets)] if meets is not None and len(meets) else [None]
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array(list(packed.values()) or [None], pa.binary()), pa.array(along + [None] * (len(blocks) - 1), pa.binary())],
        names=["block", "packed", "meets"],
    )


def _unpacked(t: pa.Table, column: str, dtype) -> np.ndarray:
    parts = [_records(x, dtype) for x in t.column(column).to_pylist() if x is not None]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)


def _star_meets(reps: DataFrame, blocks: int) -> DataFrame:
    """``(a, b)`` that share at least ``l`` columns: central rows with others, and rows that meet enough others with themselves."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _batched(batches, lambda part: _postings(part.column(0), part.column(1), part.column(3).to_pylist(), scores=part.column(2))):
            meets = _Meets()
            rest = _stars(p, LOCAL_ROWS, meets)
            yield _packed_batch(_pack(rest, blocks), meets.sums())

    def block(t: pa.Table) -> pa.Table:
        meets = _Meets()
        _stars(_unpacked(t, "packed", _POSTING), 2, meets)
        return _sum_table(np.concatenate([meets.sums(), _unpacked(t, "meets", _MEETING)]))

    met = reps.select("rep", "n", "score", "prefix").mapInArrow(local, _PACKED).groupBy("block").applyInArrow(block, _SUMS)
    return met.groupBy("a", "b", "need").agg(F.sum("n").alias("n")).where("n >= need").select("a", "b")


#: Postings that one tile of the product should hold, products that it should make, and how many it makes at once.
PRODUCT_POSTINGS = 1_000_000
TILE_CELLS = 20_000_000
PRODUCT_CELLS = 1_000_000
#: Rows of a column above which its postings go to the tiles without meeting in one task before.
HOT_ROWS = 10_000
#: Slices of the rows are a power of two, up to this one.
_MOST_SLICES = 12

_PRODUCT = np.dtype([("a", "<i8"), ("b", "<i8")])
_COLUMN = np.dtype([("col", "<u8"), ("comp", "<i8"), ("top", "<i8"), ("n", "<i8")])


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, in sorted keys."""
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(first)


def _expand(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + n[i] - 1``, one range after the other."""
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())


def _column_counts(p: np.ndarray) -> np.ndarray:
    """Per column: rows ``n``, and a component with how many of them it has at least, ``top``: all, if there is no other.

    ``p``: postings, or such counts of parts of the postings.
    """
    if not len(p):
        return np.zeros(0, dtype=_COLUMN)
    own = p["top"] if "top" in p.dtype.names else np.ones(len(p), dtype=np.int64)
    n = p["n"] if "top" in p.dtype.names else own
    order = np.lexsort((p["comp"], p["col"]))
    col, comp, own, n = p["col"][order], p["comp"][order], own[order], n[order]
    heads = _heads(col, comp)
    col, comp, own, n = col[heads], comp[heads], np.add.reduceat(own, heads), np.add.reduceat(n, heads)
    order = np.lexsort((-own, col))
    col, comp, own, n = col[order], comp[order], own[order], n[order]
    heads = _heads(col)
    out = np.zeros(len(heads), dtype=_COLUMN)
    out["col"], out["comp"], out["top"], out["n"] = col[heads], comp[heads], own[heads], np.add.reduceat(n, heads)
    return out


def _slices(ids: np.ndarray, t: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) % np.uint64(t)).astype(np.int64)


def _tile_batches(p: np.ndarray, tile: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(tile, kind="stable")
    tile, p = tile[order], p[order]
    heads = _heads(tile) if len(p) else []
    parts = [_planes(x) for x in np.split(p, heads[1:])] if len(p) else []
    yield pa.RecordBatch.from_arrays([pa.array(tile[heads] if len(p) else [], pa.int64()), pa.array(parts, pa.binary())], names=["tile", "packed"])


def _tiles(p: np.ndarray, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(postings, their tile)``: tile ``i * t + j`` gets a column's rows of the slices ``i <= j`` where they hold two components."""
    if not len(p):
        return
    at = _slices(p["id"], t)
    order = np.lexsort((at, p["col"]))
    p, at = p[order], at[order]
    heads = _heads(p["col"], at)  # one group per column and slice
    size = np.diff(np.append(heads, len(p)))
    lo, hi = np.minimum.reduceat(p["comp"], heads), np.maximum.reduceat(p["comp"], heads)
    col, at = p["col"][heads], at[heads]
    ends = np.append(_heads(col)[1:], len(col))
    last = np.repeat(ends, np.diff(np.append(0, ends)))  # of the column's groups
    after = last - np.arange(len(col))
    made = np.cumsum(after)
    for part in np.split(np.arange(len(col)), np.flatnonzero(np.diff(made // PRODUCT_CELLS)) + 1):
        g = np.repeat(part, after[part])
        h = _expand(part, after[part])
        keep = (np.minimum(lo[g], lo[h]) < np.maximum(hi[g], hi[h]))
        g, h = g[keep], h[keep]
        tile = at[g] * t + at[h]
        two = g != h
        both, tile = np.concatenate([g, h[two]]), np.concatenate([tile, tile[two]])
        shipped = np.cumsum(size[both])
        for some in np.split(np.arange(len(both)), np.flatnonzero(np.diff(shipped // PRODUCT_CELLS)) + 1):
            yield p[_expand(heads[both[some]], size[both[some]])], np.repeat(tile[some], size[both[some]])


def _foreign(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, start, n)``: ranges of ``right``, sorted by column and component, that share the column of ``left[i]``
    and are of other components; of later ones only where ``left`` and ``right`` are the ``same``. Sorted by left row."""
    columns, first = np.unique(right["col"], return_index=True)
    comps = np.unique(np.concatenate([left["comp"], right["comp"]]))
    key = np.searchsorted(columns, right["col"]) * len(comps) + np.searchsorted(comps, right["comp"])
    at = np.searchsorted(columns, left["col"])
    i = np.flatnonzero(np.append(columns, np.uint64(0))[at] == left["col"]) if len(columns) else np.zeros(0, dtype=np.int64)
    i = i[at[i] < len(columns)]
    own = at[i] * len(comps) + np.searchsorted(comps, left["comp"][i])
    stop = np.append(first[1:], len(right))[at[i]]
    begin, end = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
    starts, stops = (end, stop) if same else (np.concatenate([end, first[at[i]]]), np.concatenate([stop, begin]))
    i = i if same else np.concatenate([i, i])
    some = np.flatnonzero(stops > starts)
    some = some[np.argsort(left["id"][i[some]], kind="stable")]
    return i[some], starts[some], (stops - starts)[some]


def _products(left: np.ndarray, right: np.ndarray, same: bool) -> np.ndarray:
    """Pairs of rows in different components whose overlap within all columns of both is enough.

    Row by row, as in a sparse matrix product: the columns of a row are looked up, and the rows found there
    counted. ``PRODUCT_CELLS`` lookups are made at once; counts of a row that goes on are carried along.
    """
    right = right[np.lexsort((right["comp"], right["col"]))]
    i, starts, n = _foreign(left, right, same)
    if not len(i):
        return np.zeros(0, dtype=_PRODUCT)
    (xs, x_at, x_of), (ys, y_at, y_of) = (np.unique(r["id"], return_index=True, return_inverse=True) for r in (left, right))
    out, keys, counts = [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    parts = np.split(np.arange(len(i)), np.flatnonzero(np.diff(np.cumsum(n) // PRODUCT_CELLS)) + 1)
    for k, part in enumerate(parts):
        x, y = np.repeat(i[part], n[part]), _expand(starts[part], n[part])
        p, q = left["n"][x].astype(np.int64), right["n"][y].astype(np.int64)
        near = 4 * np.minimum(p, q) >= 3 * np.maximum(p, q)
        new, count = np.unique(x_of[x[near]] * len(ys) + y_of[y[near]], return_counts=True)
        keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([counts, count]), minlength=len(keys)).astype(np.int64)
        # Whole are the overlaps of all rows but one that the next part goes on with.
        open_ = x_of[i[part[-1]]] if k + 1 < len(parts) and x_of[i[parts[k + 1][0]]] == x_of[i[part[-1]]] else -1
        done = keys // len(ys) != open_
        a, b = x_at[keys[done] // len(ys)], y_at[keys[done] % len(ys)]
        enough = _enough(left["n"][a].astype(np.int64), right["n"][b].astype(np.int64), counts[done])
        a, b = left[a[enough]], right[b[enough]]
        made = np.zeros(len(a), dtype=_PRODUCT)
        first = a["comp"] < b["comp"]
        made["a"], made["b"] = np.where(first, a["id"], b["id"]), np.where(first, b["id"], a["id"])
        out.append(made)
        keys, counts = keys[~done], counts[~done]
    return np.concatenate(out)


def _enough(p: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The size-derived bounds on ``c`` common columns of rows of ``p`` and ``q``.

    Beyond the prefixes a pair shares no more than the rest of the row whose prefix ends first.
    """
    rest = np.maximum(-(-3 * p // 4) - 1 - p // 16, -(-3 * q // 4) - 1 - q // 16)
    return (c >= 1 + np.minimum(p, q) // 16) & (7 * (c + rest) >= 3 * (p + q))


def _slice_count(costs: np.ndarray, cells: int) -> int:
    """The least power of two of slices with which a tile holds and makes no more than it should (``costs``: postings sent, by power)."""
    for k, sent in enumerate(costs.tolist()):
        tiles = (1 << k) * ((1 << k) + 1) // 2
        if sent <= PRODUCT_POSTINGS * tiles and cells <= TILE_CELLS * tiles:
            return 1 << k
    return 1 << (len(costs) - 1)


def _mixed_pairs(reps: DataFrame, component: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` in different components that share ``l`` columns or more and may overlap enough.

    The rows are cut into slices, and the product into tiles of two slices: all columns of a pair meet in
    one tile, so its overlap is whole there, and a column that many rows share is multiplied in many tiles.
    """
    held = stored(reps.join(broadcast_if_small(component), reps["rep"] == component["id"]).select("rep", "n", "component", "prefix"), "held")
    blocks = max(1, int(held.agg(F.sum(F.length("prefix") / 6)).first()[0] or 0) // PACK_POSTINGS)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return _batched(batches, lambda part: _postings(part.column(0), part.column(1), part.column(3).to_pylist(), comps=part.column(2)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in postings(batches):
            yield _packed_batch(_pack(_column_counts(p), blocks))

    def costs(t: pa.Table) -> pa.Table:
        c = _column_counts(_unpacked(t, "packed", _COLUMN))
        mixed = c[c["top"] < c["n"]]
        sent = [int((mixed["n"] * np.minimum(mixed["n"], 1 << k)).sum()) for k in range(_MOST_SLICES + 1)]
        cells = float(((mixed["n"] - mixed["top"]).astype(float) * (mixed["n"] + mixed["top"])).sum() / 2)
        hot = c[c["n"] > HOT_ROWS]
        return pa.table({"sent": pa.array([sent], pa.list_(pa.int64())), "cells": pa.array([cells], pa.float64()), "hot": pa.array([hot.tobytes()], pa.binary())})

    found = held.mapInArrow(count, _PACKED).groupBy("block").applyInArrow(costs, "sent array<long>, cells double, hot binary").collect()
    t = _slice_count(np.sum([r["sent"] for r in found], axis=0) if found else np.zeros(1, dtype=np.int64), sum(r["cells"] for r in found))
    hot = np.concatenate([np.frombuffer(bytes(r["hot"]), dtype=_COLUMN) for r in found] or [np.zeros(0, dtype=_COLUMN)])  # at most one per HOT_ROWS postings
    mixed_hot = np.sort(hot["col"][hot["top"] < hot["n"]])
    shared = reps.sparkSession.sparkContext.broadcast((np.sort(hot["col"]), mixed_hot))

    def among(values: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return np.append(columns, columns[-1:])[np.searchsorted(columns, values)] == values if len(columns) else np.zeros(len(values), dtype=bool)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in postings(batches):
            yield _packed_batch(_pack(p[~among(p["col"], shared.value[0])], blocks))

    def deal(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for p, tile in _tiles(_unpacked(table, "packed", _POSTING), t):
            yield from _tile_batches(p, tile)

    def deal_block(table: pa.Table) -> pa.Table:
        schema = pa.schema([("tile", pa.int64()), ("packed", pa.binary())])
        return pa.Table.from_batches(list(deal(table)), schema)

    def deal_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in postings(batches):
            p = p[among(p["col"], shared.value[1])]
            at = _slices(p["id"], t)
            for other in range(t):
                yield from _tile_batches(p, np.minimum(at, other) * t + np.maximum(at, other))

    def product(table: pa.Table) -> pa.Table:
        tile = table.column("tile")[0].as_py()
        p = _unpacked(table, "packed", _POSTING)
        at = _slices(p["id"], t)
        rows = _products(p[at == tile // t], p[at == tile % t], tile // t == tile % t)
        return pa.table({k: pa.array(rows[k]) for k in rows.dtype.names})

    dealt = held.mapInArrow(pack, _PACKED).groupBy("block").applyInArrow(deal_block, "tile long, packed binary")
    if len(mixed_hot):
        dealt = dealt.unionByName(held.mapInArrow(deal_hot, "tile long, packed binary"))
    return dealt.groupBy("tile").applyInArrow(product, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose accumulated overlap reaches ``100 * overlap >= 75 * union``."""

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            a = batch.column(0).to_pylist()
            for i, right in enumerate(column_shingles(batch.column(3))):
                if a[i] != last:
                    last, left = a[i], next(column_shingles(batch.column(2).slice(i, 1)))
                same = len(np.intersect1d(left, right, assume_unique=True))
                keep[i] = 100 * same >= 75 * (len(left) + len(right) - same)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(overlap, "a long, b long").distinct()


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, digest)`` per row of ``docs`` (``digest``: xxhash64 of the text).

    Nulls and texts without words have an empty set and are linked with
    nothing. Rows with a null id keep a null component and are linked with
    nothing. Equal rows are one node of the graph but all come back; an id that occurs
    with several texts is grouped row by row. Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(_rows(docs, "doc_id", "text", column_sketch(docs, "text")), "rows")
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(known.groupBy("sig").agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.join(broadcast_if_small(classes), ["sig"]).where("doc_id = rep").select("rep", "sig", "n", "score", "prefix")
    postings = known.agg(F.sum(F.length("prefix") / 6)).first()[0] or 0
    star = stored(_star_meets(reps, max(1, int(postings) // BLOCK_POSTINGS)), "pairs")
    needed = stored(star.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    texts = stored(docs.join(broadcast_if_small(needed), docs["doc_id"] == needed["id"]).select("id", "text").distinct(), "texts")
    links = stored(_links(star.where("a <> b"), texts), "links")
    part = connected_components(links)
    component = stored(needed.join(part, "id", "left").select("id", F.coalesce("component", "id").alias("component")), "component")
    more = stored(_links(_mixed_pairs(reps, component).join(star, ["a", "b"], "left_anti"), texts), "links")
    whole = stored(connected_components(links.unionByName(more)), "component")
    class_of = classes.join(whole, classes["rep"] == whole["id"], "left").select("sig", F.coalesce("component", "rep").alias("component_id"))
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("sig")).alias("sig")
    return rows.select("doc_id", "n", "digest", linked).join(class_of, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "digest"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every component: that of its smallest id (of its smallest digest where the id repeats).

    Rows without words and rows with a null id are no part of a component and all stay.
    """
    columns = docs.columns
    docs, names = numbered(docs)
    id_col, text_col = names[id_col], names[text_col]
    classes = stored(jaccard_classes(docs, id_col, text_col), "classes")
    known = classes.where("n_shingles > 0 AND doc_id IS NOT NULL")
    stay = known.where("doc_id = component_id").groupBy("doc_id").agg(F.min("digest").alias("first"))
    keys = known.groupBy("doc_id", "digest").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    judged = keys.join(stay, "doc_id", "left").withColumn("stays", F.coalesce(F.col("digest") == F.col("first"), F.lit(False)) & (F.col("doc_id") == F.col("component_id")))
    judged = stored(judged.where("NOT stays OR rows > 1").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "stays"), "judged")
    same = (docs[id_col] == F.col("_id")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("_digest"))
    rest = docs.join(broadcast_if_small(judged.drop("stays")), same, "left_anti")
    again = docs.join(broadcast_if_small(judged.where("stays").drop("stays")), same, "left_semi").dropDuplicates([id_col, text_col])
    return rest.unionByName(again).toDF(*columns)
