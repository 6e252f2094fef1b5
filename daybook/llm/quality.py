"""Quality rules (2): base counts of a text, and lines that recur across the documents of a host.

Lines are normalised (ASCII lower case, digits as 0, runs of white space as
one space) and hashed. For every host (the document's source) the distinct
documents of every line are counted; documents of the same normalised words
count as one, so that copies of one document do not turn its lines into
boilerplate. A line is above the limit where more than
``max(min_docs, share * distinct documents of the host)`` hold it. Those
lines are removed; a document that loses more than ``max_removed`` of its
words, or fails a base rule, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import broadcast_if_small, numbered, stored
from daybook.llm.words import hash_spans, mix64, row_slices, text_slices, window_hashes, word_hashes

MIN_DOCS = 10
SHARE = 0.05
MAX_REMOVED = 0.5
#: Base rules of the contract.
MIN_WORDS = 50
MAX_REPEATED = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_DIGITS = np.arange(256, dtype=np.uint8)
_DIGITS[48:58] = 48
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, kind long, lines array<long>, line_words array<int>"


def _line_spans(data: np.ndarray, offsets: np.ndarray):
    """Start and stop byte of every line of every text, and the first line of each text."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    newlines = np.flatnonzero(data == 10)
    starts = np.union1d(newlines + 1, offsets[:-1])
    starts = starts[starts < len(data)]
    stops = np.append(starts[1:], len(data))
    stops = stops - (data[np.maximum(stops - 1, 0)] == 10)
    return starts, stops


def _repeated(rows: np.ndarray, n_words: int, width: int = 3) -> int:
    """Words inside ``width``-word windows that occur twice or more."""
    if len(rows) == 0:
        return 0
    _, back, counts = np.unique(rows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[back] > 1)
    covered = np.zeros(n_words, dtype=bool)
    for j in range(width):
        covered[twice + j] = True
    return int(covered.sum())


def _text_stats(column: pa.Array) -> Iterator[tuple]:
    """The columns of ``_STATS`` for every text."""
    for _, data, offsets in text_slices(column):
        h, starts, stops, firsts = word_hashes(data, offsets, lower=False)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        word_chars = np.concatenate([[0], np.cumsum(chars[stops] - chars[starts])])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
        windows = window_hashes(h, 3)
        folded = hash_spans(_DIGITS[data], starts, stops, lower=True)
        place = (np.arange(len(starts)) - np.repeat(firsts[:-1], np.diff(firsts))).astype(np.uint64)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix64(folded + mix64(place)), dtype=np.uint64)])
        kinds = mix64(sums[firsts[1:]] - sums[firsts[:-1]]).view(np.int64)
        begin, end = _line_spans(data, offsets)
        line_of = np.searchsorted(begin, starts, side="right") - 1
        lines, first = np.unique(line_of, return_index=True)
        count = np.diff(np.append(first, len(starts)))
        at = np.arange(len(starts)) - np.repeat(first, count)
        normal = mix64(np.add.reduceat(mix64(folded + at.astype(np.uint64)), first)) if len(first) else folded
        raw = hash_spans(data, begin[lines], end[lines], lower=False)
        text_line = np.searchsorted(first, firsts)
        for i in range(len(offsets) - 1):
            a, b = int(firsts[i]), int(firsts[i + 1])
            n = b - a
            la, lb = int(text_line[i]), int(text_line[i + 1])
            own, back = np.unique(normal[la:lb], return_inverse=True)
            yield (
                n,
                int(word_chars[b] - word_chars[a]),
                int(symbols[offsets[i + 1]] - symbols[offsets[i]]),
                lb - la - len(np.unique(raw[la:lb])),
                _repeated(windows[a : b - 2] if n >= 3 else windows[:0], n),
                int(kinds[i]),
                own.view(np.int64),
                np.bincount(back, weights=count[la:lb], minlength=len(own)).astype(np.int32),
            )


def document_stats(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: id, host, a digest of the text, and the columns of ``_STATS``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _STATS.split(", ")]
        for batch in batches:
            for part in row_slices(batch, 3):
                found = list(zip(*_text_stats(part.column(3)), strict=True))
                types = [pa.int64()] * 6 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), *(pa.array(x, t) for x, t in zip(found, types, strict=True))],
                    names=["id", "host", "digest", *names],
                )

    host = F.when(F.col(host_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(host_col).cast("string")))
    taken = docs.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.col(text_col).alias("text"))
    return taken.mapInArrow(rows, "id long, host string, digest long, " + _STATS)


def common_lines(stats: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``(host, line, n_docs)`` of the lines above their host's limit."""
    lines = stats.select("host", "kind", F.explode("lines").alias("line"))
    # Distinct first, then counted: a line that a third of the rows hold is spread by document.
    seen = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = stats.groupBy("host").agg(F.countDistinct("kind").alias("host_docs"))
    return seen.join(hosts, "host").where(F.col("n_docs") > F.lit(share) * F.col("host_docs")).select("host", "line", "n_docs")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """Per row of ``docs``: the base counts, ``base_failed``, ``n_removed`` (words in removed lines),
    ``removed_lines`` (their hashes, null for none), ``kept``.

    A null text has no words and fails; a null host is a host of its own; equal
    rows all come back. Also returned: ``host`` and ``digest``, which identify
    the text whose lines were removed.
    """
    stats = stored(document_stats(docs, id_col, text_col, host_col), "quality")
    common = stored(common_lines(stats, min_docs, share), "lines").select("host", "line")
    each = stats.select("host", "digest", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    each = each.select("host", "digest", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    removed = each.join(broadcast_if_small(common), ["host", "line"]).distinct()
    removed = removed.groupBy("host", "digest").agg(F.sum("words").alias("n_removed"), F.collect_set("line").alias("removed_lines"))
    out = stats.drop("lines", "line_words", "kind").join(removed, ["host", "digest"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 100 * MAX_REPEATED * F.col("n_words"))
    out = out.withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long")).withColumn("base_failed", failed)
    depleted = F.col("n_removed") > F.lit(max_removed) * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that the rules keep, without their removed lines; same columns.

    Where a text changes, ``chars_col`` (if there) becomes its new length. Verdicts are joined
    on id, host and text digest, null ids included; rows without removed lines come back as they were.
    """
    columns = docs.columns
    docs, renamed = numbered(docs)
    id_col, text_col, host_col, chars_col = renamed[id_col], renamed[text_col], renamed[host_col], renamed.get(chars_col)
    rules = quality_rules(docs, id_col, text_col, host_col).where("NOT kept OR n_removed > 0")
    acts = rules.select(F.col(id_col).alias("_id"), F.col("host").alias("_host"), F.col("digest").alias("_digest"), F.col("kept").alias("_kept"), F.col("removed_lines").alias("_lines"))
    acts = stored(acts.dropDuplicates(["_id", "_host", "_digest"]), "acts")
    host = F.when(F.col(host_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(host_col).cast("string")))
    same = docs[id_col].cast("long").eqNullSafe(F.col("_id")) & (host == F.col("_host")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("_digest"))
    wide = F.length("_host") + 8 * F.greatest(F.size("_lines"), F.lit(0)) + 48
    left = docs.join(broadcast_if_small(acts, size=wide), same, "left").where(F.coalesce("_kept", F.lit(True))).select(*docs.columns, "_lines")
    names = docs.columns
    text_at, lines_at, chars_at = names.index(text_col), len(names), names.index(chars_col) if chars_col else None

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            columns = part.columns[:lines_at]
            texts, gone = columns[text_at].to_pylist(), part.column(lines_at).to_pylist()
            new = [without_lines(t, set(g)) if g else t for t, g in zip(texts, gone, strict=True)]
            columns[text_at] = pa.array(new, pa.string())
            if chars_at is not None:
                was = columns[chars_at].to_pylist()
                columns[chars_at] = pa.array([len(t) if g else w for t, g, w in zip(new, gone, was, strict=True)], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return left.mapInArrow(strip, docs.schema).toDF(*columns)


def without_lines(text: str, removed: set[int]) -> str:
    """``text`` without the lines whose normalised hash is in ``removed``."""
    lines = text.split("\n")
    found = [s[6] for s in _text_stats(pa.array(lines))]  # a line is a text of one line
    return "\n".join(x for x, h in zip(lines, found, strict=True) if not (len(h) and int(h[0]) in removed))
