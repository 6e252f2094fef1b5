"""Mixing sources to target weights (5): a low-discrepancy schedule of equal-token blocks.

Slot ``i`` of the mix looks at the golden-ratio point ``frac((i + 0.5) * phi)``
among the cumulative slot weights of the sources and so names a source; the
rank of the slot among its source's slots names a block of that source. The
documents of a source, shuffled by a keyed digest, form one stream that is cut
into blocks of equal size (to a word); when the ranks run past the last block
they start over. Any stretch of the schedule holds each source close to its share.

Words are runs outside ``[\\x20\\x09-\\x0D]``. All work is DataFrame joins and
windows; running sums and ranks are taken in two steps (sums of small groups,
then inside a group), so that a source with a third of all rows is never one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import stored

SHARE = 1.5
MOST = 2.0
WEIGHTS = (3, 1, 2)
#: Blocks of a source: ``size / block_words``, at least this many (never under a word each).
LEAST_BLOCKS = 256
#: Words of a block: 1/200,000 of all words, within these bounds.
BLOCK_WORDS = (16, 4096)
#: Rows of a group within which sums run.
GROUP_ROWS = 4096
SLOT_GROUP = 1 << 16

PHI = 0.6180339887498949
#: frac(65536 * PHI) to full precision: points stay exact to 2**-30 at any slot number.
PHI_GROUP = 0.47548671310877194


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``(doc_id, source, size, at)``: words, and the shuffle key of each row."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("at"),
    )


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, rank, docs, source_size, target)``: one row per source (null included).

    Sources by code point, null last, take ``weights`` in turn and share ``share`` times all words;
    a target stops at ``most`` times its source, what is above is shared again by weight among the others.
    The source table (one row per source, not per document) is ordered in one task.
    """
    each = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = each.withColumn("rank", rank.cast("long"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    each = stored(each.withColumn("weight", weight.cast("double")), "sources")
    words = each.agg(F.sum("source_size")).first()[0] or 0
    stops = F.col("source_size") * F.lit(float(most))
    level = -1.0
    while True:  # the level only rises, and each round stops one more source at least
        full = F.col("weight") * F.lit(level) >= stops
        row = each.agg(F.sum(F.when(full, stops).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")))).first()
        now = (share * words - (row[0] or 0.0)) / row[1] if row[1] else level
        if now <= level or not row[1]:
            break
        level = now
    return each.withColumn("target", F.least(stops, F.col("weight") * F.lit(max(level, 0.0))))


def _streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row with words, with the place ``start`` of its first word in its source's shuffled stream."""
    rows = sizes.where("size > 0").withColumn("source", F.struct("source"))
    plan = sources.select(F.struct("source").alias("source"), "docs", "rank", "source_size", "blocks")
    rows = rows.join(plan, "source")
    groups = F.ceil(F.col("docs") / GROUP_ROWS)
    first = F.conv(F.substring("at", 1, 8), 16, 10).cast("long")
    rows = stored(rows.withColumn("group", F.floor(first * groups / F.lit(1 << 32)).cast("long")), "streams")
    sums = rows.groupBy("rank", "group").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rank").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "group", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "group").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums, ["rank", "group"]).withColumn("start", F.col("base") + F.col("within"))


def schedule(spark, sources: DataFrame) -> DataFrame:
    """``(slot, rank, turn, block)``: the source of every slot, how many slots it had before, and the block it takes."""
    plan = sources.where("source_size > 0 AND target > 0").select("rank", "blocks", F.expr("target * blocks / source_size").alias("need"))
    total = plan.agg(F.sum("need")).first()[0] or 0.0
    slots = int(round(total))
    up_to = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    plan = stored(plan.withColumn("high", F.sum("need").over(up_to) / F.lit(total or 1.0)).withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("rank")), F.lit(0.0))), "plan")
    last = plan.agg(F.max("rank")).first()[0]
    chunk, rest = F.floor(F.col("slot") / SLOT_GROUP), F.col("slot") % SLOT_GROUP
    raw = chunk * F.lit(PHI_GROUP) + (rest + F.lit(0.5)) * F.lit(PHI)
    points = spark.range(slots).select(F.col("id").alias("slot")).withColumn("point", raw - F.floor(raw)).withColumn("chunk", chunk)
    # The few hundred cells of the unit interval turn the range lookup into an equi-join.
    cells = plan.select("rank", "blocks", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * 1024), F.least(F.floor(F.col("high") * 1024), F.lit(1023)))).alias("cell"))
    named = points.withColumn("cell", F.floor(F.col("point") * 1024)).join(cells, "cell").where((F.col("point") >= F.col("low")) & ((F.col("point") < F.col("high")) | (F.col("rank") == F.lit(last))))
    named = named.select("slot", "chunk", "rank", "blocks")
    counts = named.groupBy("rank", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("rank", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "chunk").orderBy("slot")
    turn = F.col("base") + F.col("nth") - 1
    named = named.withColumn("nth", F.row_number().over(inside)).join(counts, ["rank", "chunk"])
    return named.select("slot", "rank", turn.alias("turn"), (turn % F.col("blocks")).alias("block"), "blocks")


def with_blocks(sources: DataFrame, least_blocks: int = LEAST_BLOCKS, block_words: tuple[int, int] = BLOCK_WORDS) -> DataFrame:
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    block = min(max(words // 200_000, block_words[0]), block_words[1])
    blocks = F.greatest(F.floor(F.col("source_size") / block), F.lit(least_blocks))
    return sources.withColumn("blocks", F.greatest(F.least(blocks, F.col("source_size")), F.lit(1)).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", most: float = MOST) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs``.

    ``taken``: words of the row in the blocks that the schedule takes, repeats counted; slots past
    ``most`` rounds of a source stay empty, so no row exceeds ``most`` times its size. Null and
    wordless texts have size 0 and take nothing; a null source is a source of its own. Equal rows
    are separate rows of the mix. The shuffle depends on ids and ``seed`` alone, so reruns agree.
    """
    spark = docs.sparkSession
    sizes = stored(sized(docs, id_col, text_col, source_col, seed), "sizes")
    sources = stored(with_blocks(targets(sizes, most=most)), "targets")
    slots = schedule(spark, sources).where(F.col("turn") < F.lit(int(most)) * F.col("blocks"))
    used = slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
    rows = _streams(sizes, sources)
    # Every block holds ``bw`` words, the first ``extra`` blocks one more.
    rows = rows.withColumn("bw", F.expr("source_size div blocks")).withColumn("extra", F.expr("source_size % blocks"))
    edge = lambda b: F.expr(f"({b}) * bw + least({b}, extra)")
    at = lambda w: F.expr(f"CASE WHEN ({w}) < extra * (bw + 1) THEN ({w}) div (bw + 1) ELSE extra + (({w}) - extra * (bw + 1)) div bw END")
    pieces = rows.select("*", F.explode(F.sequence(at("start"), at("start + size - 1"))).alias("block"))
    here = F.least(F.col("start") + F.col("size"), edge("block + 1")) - F.greatest(F.col("start"), edge("block"))
    taken = pieces.withColumn("here", here).join(used, ["rank", "block"])
    taken = taken.groupBy("rank", "start").agg(F.sum(F.col("here") * F.col("times")).alias("taken"))
    plain = sources.select(F.struct("source").alias("key"), "source_size", "target")
    full = rows.join(taken, ["rank", "start"], "left").select("doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    full = full.unionByName(sizes.where("size = 0").select("doc_id", F.struct("source").alias("source"), "size", F.lit(0).cast("long").alias("taken")))
    return full.join(plain, full["source"] == plain["key"]).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
