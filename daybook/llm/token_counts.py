"""Token counts (3): the exact histogram of encoded lengths, and suffix sums over it.

Documents are encoded whole and counted by encoded length. The histogram has
one row per distinct length, not per document; running sums over it answer
totals, quantiles and truncated totals for every context limit exactly.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import stored

#: Vocabulary file of a byte-level BPE on the driver; it is sent to the executors once per application.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Context limits that one call answers.
MOST_LIMITS = 10_000
#: Lengths of one group of the two-step running sums.
GROUP = 1024

_ENCODINGS: dict[tuple[str, str], object] = {}


def encoding(vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    """The tokenizer of a rank file, loaded once per process."""
    import tiktoken

    if (vocabulary, pattern) not in _ENCODINGS:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[vocabulary, pattern] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[vocabulary, pattern]


def _sent(path: str) -> str:
    """Where a file that the driver has added lies on this executor."""
    from pyspark import SparkFiles

    return SparkFiles.get(os.path.basename(path))


def token_lengths(docs: DataFrame, text_col: str = "text", by: str | None = None, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``docs`` reduced to ``(key, length)``: tokens of each whole text; null and empty texts have 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(_sent(vocabulary), pattern).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], names=["key", "length"])

    context = docs.sparkSession.sparkContext
    if not any(x.endswith("/" + os.path.basename(vocabulary)) for x in context.listFiles):
        context.addFile(vocabulary)
    key = F.col(by).cast("string") if by else F.lit("")
    return docs.select(key.alias("key"), F.col(text_col).alias("text")).mapInArrow(count, "key string, length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``(key, length, n_docs)``: how many texts have exactly that many tokens.

    Stored, since what is asked of it reads it more than once and the texts are to be encoded once.
    """
    return stored(lengths.groupBy("key", "length").agg(F.count("*").alias("n_docs")), "histogram")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every key and length L that occurs, exactly:

    ``n_docs`` texts of L tokens; ``n_longer`` texts above L; ``tokens_upto`` tokens in texts of at most L;
    ``truncated_total`` tokens left when every text is cut to L; ``lost`` tokens cut away;
    ``rank`` texts of at most L (so L is the quantile ``rank / docs``); ``docs`` and ``total`` of the key.
    A null key is a key of its own.
    """
    h = histogram.withColumn("group", F.floor(F.col("length") / GROUP))
    sums = h.groupBy("key", "group").agg(F.sum("n_docs").alias("gd"), F.sum(F.col("n_docs") * F.col("length")).alias("gt"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.struct("key").alias("k"), "group",
        F.coalesce(F.sum("gd").over(before), F.lit(0)).alias("bd"), F.coalesce(F.sum("gt").over(before), F.lit(0)).alias("bt"),
        F.sum("gd").over(whole).alias("docs"), F.sum("gt").over(whole).alias("total"),
    )
    inside = Window.partitionBy("key", "group").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("d", F.sum("n_docs").over(inside)).withColumn("t", F.sum(F.col("n_docs") * F.col("length")).over(inside))
    h = h.withColumn("k", F.struct("key")).join(sums, ["k", "group"])
    rank, upto = F.col("d") + F.col("bd"), F.col("t") + F.col("bt")
    longer = F.col("docs") - rank
    cut = upto + longer * F.col("length")
    return h.select(
        "key", "length", "n_docs", rank.alias("rank"), longer.alias("n_longer"), upto.alias("tokens_upto"),
        cut.alias("truncated_total"), (F.col("total") - cut).alias("lost"), "docs", "total",
    )


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """``(key, limit, truncated_total, n_longer)`` for any context limits, also ones that no text has.

    Between two lengths that occur, the truncated total grows by one per longer text and token;
    below the shortest it is ``limit * docs``. A null or negative limit gives no row. At most
    ``MOST_LIMITS`` distinct limits: each key is asked for all of them. Lengths and limits of a
    key are put in one order, and the last length is carried forward to the limits after it.
    """
    asked = [r[0] for r in limits.select(F.col("limit").cast("long").alias("limit")).where("limit >= 0").distinct().limit(MOST_LIMITS + 1).collect()]
    if len(asked) > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} limits")
    keys = sums.groupBy(F.struct("key").alias("k")).agg(F.max("docs").alias("docs"))
    asks = keys.select("k", "docs", F.explode(F.array(*map(F.lit, sorted(asked))).cast("array<bigint>")).alias("at"), F.lit(True).alias("asked"))
    step = F.struct("length", "n_longer", "truncated_total")
    rows = sums.select(F.struct("key").alias("k"), "docs", F.col("length").cast("long").alias("at"), F.lit(False).alias("asked"), step.alias("s"))
    both = rows.unionByName(asks.withColumn("s", F.lit(None).cast(rows.schema["s"].dataType)))
    upto = Window.partitionBy("k").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("s", F.last("s", ignorenulls=True).over(upto)).where("asked").withColumnRenamed("at", "limit")
    longer = F.coalesce("s.n_longer", "docs")
    total = F.when(F.col("s").isNull(), F.col("limit") * F.col("docs")).otherwise(F.col("s.truncated_total") + (F.col("limit") - F.col("s.length")) * F.col("s.n_longer"))
    return out.select("k.key", "limit", total.alias("truncated_total"), longer.alias("n_longer"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``(key, share, length)``: the smallest length that at least that share of the texts do not exceed."""
    asked = F.explode(F.array(*map(F.lit, shares))).alias("share")
    return sums.select("key", "length", "rank", "docs", asked).where("rank >= share * docs").groupBy("key", "share").agg(F.min("length").alias("length"))
