"""Benchmark decontamination (10): spaced-seed hashing.

Words are lower-cased (ASCII) runs of letters and digits; ASCII punctuation
separates. Every mask is a fixed pattern of kept and ignored word positions.
The kept words of every window of a benchmark item and of a document are
hashed per mask; equal hashes are hits, so a window matches although words at
ignored positions were substituted. Around a hit the two texts are compared
word by word on the hit's diagonal: the best stretch counts a match as +1 and
a substitution as -``PENALTY``, and the document is contaminated where the
stretch matches enough words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import broadcast_if_small, numbered, stored
from daybook.llm.words import mix64, text_slices, word_hashes

#: Masks: 1 keeps a word position, 0 ignores it. Any two substitutions within a
#: window leave some mask whole at this or a shifted window. Shorter items use masks of their own length.
MASKS = ("111111110000", "000011111111", "111100001111", "110110110110", "101011011011")
PENALTY = 2
#: A stretch counts with this many matched words, or this share of the item's words if that is less.
MIN_MATCH = 13
MIN_SHARE = 0.7
#: An item of fewer words has to match in all of them, and is marked where the text has other words.
LEAST_WORDS = 8
#: A benchmark of up to this many words goes to the tasks whole (8 bytes a word, plus its
#: window hashes); a larger one is joined by its hashes.
BENCHMARK_WORDS = 2_000_000
#: Bits of a seed hash that the filter of a larger benchmark looks at (2 ** 27 bits are 16 MB).
FILTER_BITS = 27

_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 32


def plain_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, word hashes, first word of each text)`` slices of a string column."""
    for first, data, offsets in text_slices(column):
        h, _, _, firsts = word_hashes(_PLAIN[data], offsets)
        yield first, h, firsts


def seed_hashes(h: np.ndarray, mask: str, k: int) -> np.ndarray:
    """Hash of the kept words of the ``k``-th mask at every start (runs over the end are garbage)."""
    total = np.full(len(h), (k + 1) * 0x1000193, dtype=np.uint64)
    for j, kept in enumerate(mask[: len(h)]):
        if kept == "1":
            total[: len(h) - j] += h[j:] * np.uint64(2 * (j * 0x9E3779B97F4A7C15 % (1 << 62)) + 1)
    return mix64(total)


def every_mask(masks: tuple[str, ...], short: list[int]) -> list[str]:
    """The masks, and those of items too short for them: each half of the item, or all of a very short one."""
    halves = [m for n in short if n >= LEAST_WORDS for m in ("1" * -(-n // 2) + "0" * (n // 2), "0" * (n // 2) + "1" * -(-n // 2))]
    return [*masks, *("1" * n for n in short if n < LEAST_WORDS), *halves]


class Benchmark:
    """The items' word hashes and the seed hashes of all their windows, as sorted arrays."""

    def __init__(self, ids: list, columns: pa.Array, masks: tuple[str, ...] = MASKS):
        self.ids, self.masks = ids, masks
        parts = [(h, np.diff(f)) for _, h, f in plain_words(columns)]
        self.words = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, dtype=np.uint64)
        sizes = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, dtype=np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        item_of = np.repeat(np.arange(len(sizes)), sizes)
        left = self.firsts[item_of + 1] - np.arange(len(self.words))
        self.short = sorted({int(n) for n in sizes if 0 < n < max(map(len, masks))})
        self.tables = []
        for k, mask in enumerate(self.all_masks()):
            whole = k >= len(masks)
            ok = np.flatnonzero((left == len(mask)) & (sizes[item_of] == len(mask)) if whole else left >= len(mask))
            seeds = seed_hashes(self.words, mask, k)[ok] if len(ok) else np.zeros(0, dtype=np.uint64)
            order = np.argsort(seeds, kind="stable")
            seeds, at = seeds[order], ok[order]
            seen = np.zeros(1 << 20, dtype=bool)
            seen[seeds >> np.uint64(44)] = True
            self.tables.append((seeds, at, item_of[at], seen))

    def all_masks(self) -> list[str]:
        return every_mask(self.masks, self.short)

    def hits(self, h: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of document words ``h`` (``room``: words left in the text): positions, item positions, items."""
        found = []
        for k, mask in enumerate(self.all_masks()):
            seeds, at, items, seen = self.tables[k]
            if len(seeds) == 0:
                continue
            own = seed_hashes(h, mask, k)
            near = np.flatnonzero(seen[own >> np.uint64(44)] & (room >= len(mask)))
            lo, hi = np.searchsorted(seeds, own[near], "left"), np.searchsorted(seeds, own[near], "right")
            near, lo, n = near[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append((np.repeat(near, n), at[which], items[which]))
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best_stretch(x: np.ndarray, y: np.ndarray, penalty: int = PENALTY) -> tuple[int, int, int]:
    """``(matches, begin, end)`` of the best stretch of two equally long word sequences."""
    same = x == y
    score = np.cumsum(np.where(same, 1, -penalty))
    base = np.concatenate([[0], np.minimum.accumulate(np.minimum(score, 0))[:-1]])
    end = int(np.argmax(score - base))
    before = np.concatenate([[0], score[: end + 1]])
    begin = int(np.argmin(before[: end + 1]))
    return int(same[begin : end + 1].sum()), begin, end + 1


def needed_words(n: int, min_match: int = MIN_MATCH, min_share: float = MIN_SHARE) -> int:
    return max(1, min(min_match, int(np.ceil(min_share * n))))


def verified(bench: Benchmark, h: np.ndarray, a: int, b: int, pos, item_pos, items) -> list[tuple[int, int, int, int, bool]]:
    """``(item, matched words, begin, end, short item inside a longer text)`` of one text's hits that hold up, one per item (the longest)."""
    best: dict[int, tuple[tuple[int, int], int, int]] = {}
    for item, shift in sorted(set(zip(items.tolist(), (pos - item_pos).tolist(), strict=True))):
        lo, hi = int(bench.firsts[item]), int(bench.firsts[item + 1])
        begin, end = max(a, lo + shift), min(b, hi + shift)
        n, i, j = best_stretch(h[begin:end], bench.words[begin - shift : end - shift])
        rank = (n, -begin - i)
        if n >= (needed_words(hi - lo) if hi - lo >= LEAST_WORDS else hi - lo) and (item not in best or rank > best[item][0]):
            best[item] = (rank, begin + i - a, begin + j - a)
    size = np.diff(bench.firsts)
    return [(item, rank[0], i, j, bool(size[item] < min(LEAST_WORDS, b - a))) for item, (rank, i, j) in sorted(best.items())]


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", benchmark_words: int = BENCHMARK_WORDS,
) -> DataFrame:
    """``(doc_id, item_id, matched, begin, end, short_inside)``: the longest verified stretch of each item in each text.

    ``begin`` and ``end`` count words of the text. ``short_inside``: an item of fewer than
    ``LEAST_WORDS`` words that stands, word for word, in a text with other words. Null and empty texts and items match nothing; equal
    rows each give their matches; an item that occurs twice is reported per row of the benchmark.
    """
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    size = bench.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z0-9\\x80-\\uFFFF]+")))).first()[0] or 0
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if size > benchmark_words:
        return _joined(docs, bench)
    held = bench.orderBy("item", "text").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(Benchmark(held.column("item").to_pylist(), held.column("text").combine_chunks()))
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), bench.schema["item"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            rows = list(_scan(b, batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([b.ids[r[1]] for r in rows], held.schema.field("item").type),
                    *(pa.array([r[k] for r in rows], pa.int64()) for k in (2, 3, 4)),
                    pa.array([r[5] for r in rows], pa.bool_()),
                ],
                names=["doc_id", "item_id", "matched", "begin", "end", "short_inside"],
            )

    return docs.mapInArrow(scan, f"doc_id {id_type}, item_id {item_type}, matched long, begin long, end long, short_inside boolean")


def _scan(bench: Benchmark, column: pa.Array) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """``(row, item, matched, begin, end, short_inside)`` of a column of texts."""
    for first, h, firsts in plain_words(column):
        if len(h) == 0:
            continue
        text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        pos, item_pos, items = bench.hits(h, firsts[text_of + 1] - np.arange(len(h)))
        if len(pos) == 0:
            continue
        order = np.argsort(text_of[pos], kind="stable")
        pos, item_pos, items = pos[order], item_pos[order], items[order]
        texts, cuts = np.unique(text_of[pos], return_index=True)
        for t, *hit in zip(texts.tolist(), *(np.split(v, cuts[1:]) for v in (pos, item_pos, items)), strict=True):
            for found in verified(bench, h, int(firsts[t]), int(firsts[t + 1]), *hit):
                yield first + t, *found


def _seed_rows(rows: DataFrame, key: str, masks: tuple[str, ...], short: list[int], items: bool, filter_=None) -> DataFrame:
    """``(key, mask, seed)``: the distinct seed hashes of the texts in ``rows(key, text)``.

    Masks of short items fit them whole. ``filter_`` (a broadcast bit per value of a seed's first bits)
    keeps the seeds whose bit is set.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = every_mask(masks, short)
        bits = filter_.value if filter_ is not None else None
        for batch in batches:
            for first, h, firsts in plain_words(batch.column(1)):
                text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
                room = firsts[text_of + 1] - np.arange(len(h))
                size = np.diff(firsts)[text_of] if len(h) else room
                for k, mask in enumerate(every):
                    whole = items and k >= len(masks)
                    ok = np.flatnonzero((room == len(mask)) & (size == len(mask)) if whole else room >= len(mask))
                    seeds = seed_hashes(h, mask, k)[ok] if len(ok) else np.zeros(0, dtype=np.uint64)
                    if bits is not None:
                        at = seeds >> np.uint64(64 - FILTER_BITS)
                        held = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        ok, seeds = ok[held], seeds[held]
                    if len(ok):
                        values = np.unique(np.stack([text_of[ok], seeds.view(np.int64)], axis=1), axis=0)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(first + values[:, 0])), pa.array(np.full(len(values), k, np.int32)), pa.array(values[:, 1])], names=["key", "mask", "seed"]
                        )

    taken = rows.select(F.col(key).alias("key"), "text")
    return taken.mapInArrow(emit, f"key {taken.schema['key'].dataType.simpleString()}, mask int, seed long")


def _seed_filter(seeds: DataFrame):
    """A broadcast bit for every value of the first ``FILTER_BITS`` bits of a seed: set where a benchmark seed has it.

    Built as bitmaps by the executors; what the driver holds is ``2 ** FILTER_BITS`` bits, whatever the benchmark.
    """
    # Counted from 1, so that a bucket of Spark's bitmaps is a run of 32,768 values that starts a new byte.
    at = F.shiftrightunsigned("seed", 64 - FILTER_BITS) + 1
    rows = seeds.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    packed = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for r in rows.toLocalIterator():
        packed[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return seeds.sparkSession.sparkContext.broadcast(packed)


def _joined(docs: DataFrame, bench: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """The same result for a benchmark of any size: seed hashes are joined, then the texts of the hits verified.

    Items go by a digest until their texts are needed, once per hit; of the documents' seeds only those that
    pass a filter of the benchmark's seeds are shuffled.
    """
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), bench.schema["item"].dataType.simpleString()
    short = _short_sizes(bench, masks)
    bench = bench.withColumn("b", F.xxhash64(F.struct("item"), F.coalesce("text", F.lit(""))))
    theirs = stored(_seed_rows(bench.dropDuplicates(["b"]), "b", masks, short, True).withColumnRenamed("key", "b"), "seeds")
    own = _seed_rows(docs, "doc_id", masks, short, False, _seed_filter(theirs)).withColumnRenamed("key", "doc_id")
    # A seed that many windows share is met once per document here; the items come after.
    hit = own.join(theirs.select("mask", "seed").distinct(), ["mask", "seed"], "left_semi").distinct()
    pairs = stored(hit.join(theirs, ["mask", "seed"]).select(F.struct("doc_id").alias("k"), "b").distinct(), "hits")
    pairs = pairs.join(bench.select("b", "item", F.col("text").alias("item_text")), "b").select("k", "item", "item_text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items = [], batch.column(2).to_pylist()
            for i in range(batch.num_rows):
                one = Benchmark([items[i]], batch.column(3).slice(i, 1), masks)
                rows += [(i, *r[2:]) for r in _scan(one, batch.column(1).slice(i, 1))]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)), pa.array([r[4] for r in rows], pa.bool_())], names=["doc_id", "item_id", "matched", "begin", "end", "short_inside"])

    met = docs.withColumn("k", F.struct("doc_id")).join(pairs, "k").select("doc_id", "text", "item", "item_text")
    return met.mapInArrow(check, f"doc_id {id_type}, item_id {item_type}, matched long, begin long, end long, short_inside boolean")


def _short_sizes(bench: DataFrame, masks: tuple[str, ...]) -> list[int]:
    """Sizes of the items too short for the masks (fewer than the longest mask has positions)."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, firsts in plain_words(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.diff(firsts)))], names=["n"])

    longest = max(map(len, masks))
    return sorted(r[0] for r in bench.select("text").mapInArrow(sizes, "n long").where(f"n > 0 AND n < {longest}").distinct().collect())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, all columns as they came.

    A short item inside a longer text drops nothing: one of a single word would drop most texts.
    Rows with an equal id and text are judged alike; a null id is an id of its own.
    """
    columns = docs.columns
    docs, names = numbered(docs)
    id_col, text_col = names[id_col], names[text_col]
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"))
    found = contamination(docs.select(row.alias("_row"), F.col(text_col).alias("text")), benchmark, "_row", "text")
    bad = stored(found.where("NOT short_inside").select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    return docs.join(broadcast_if_small(bad), row == F.col("_row"), "left_anti").toDF(*columns)
