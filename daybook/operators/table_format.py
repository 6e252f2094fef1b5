"""Live partitions of a table-format (Iceberg-style) table, as one lazy plan (P5).

Inputs are DataFrames, so any reader works (Avro manifests with
:mod:`daybook.sources.avro`, Parquet, JSON):

* metadata log ``(file, timestamp)`` → newest metadata file (P5a);
* metadata document ``current-snapshot-id``, ``snapshots[snapshot-id,
  manifest-list]`` → current snapshot's manifest list (P5b);
* manifest entries ``status``, ``data_file{content, file_path, partition{…}}``
  → inserted data files (P5c), delete files (P5d), removed entries (P5e);
* position-delete records ``(file_path, pos)`` read from the delete files →
  files hit by a delete (P5f);
* live = inserted LEFT ANTI removed (P5g) → distinct partition dates;
* exact row counts: deleted positions as bitmaps per file (P5f), equality
  deletes bounded by their sequence number (:func:`drop_equal`).

Every step is a distributed filter / distinct / anti join; nothing is
collected except the short path lists a file scan must receive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_metadata_file(metadata_log: DataFrame) -> DataFrame:
    """``(file)`` of the newest entry; ties broken by file name.

    A ``max_by`` aggregate (combined map-side) rather than a global sort.
    Returns no row for an empty log.
    """
    return metadata_log.agg(
        F.max_by("file", F.struct("timestamp", "file")).alias("file"),
        F.count(F.lit(1)).alias("_n"),
    ).where("_n > 0").select("file")


def current_snapshot(metadata: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The snapshot whose id equals ``current-snapshot-id``.

    ``keys`` are extra columns kept to tell several metadata documents apart.
    Output: ``keys…, snapshot_id, manifest_list``.
    """
    keys = keys or []
    snaps = metadata.select(
        *keys,
        F.col("`current-snapshot-id`").alias("_current"),
        F.explode("snapshots").alias("snapshot"),
    )
    return snaps.where(F.col("snapshot.`snapshot-id`") == F.col("_current")).select(
        *keys,
        F.col("snapshot.`snapshot-id`").alias("snapshot_id"),
        F.col("snapshot.`manifest-list`").alias("manifest_list"),
    )


def inserted_files(entries: DataFrame, partition_column: str) -> DataFrame:
    """Data files (content 0) added or existing (status 0/1), with their partition."""
    return (
        entries.where((F.col("data_file.content") == 0) & F.col("status").isin(0, 1))
        .select(
            F.col("data_file.file_path").alias("file_path"),
            F.col(f"data_file.partition.{partition_column}").alias("partition_date"),
        )
        .distinct()
    )


def delete_files(entries: DataFrame) -> DataFrame:
    """P5d: distinct paths of delete files (content != 0)."""
    return entries.where(F.col("data_file.content") != 0).select(
        F.col("data_file.file_path").alias("file_path")
    ).distinct()


def removed_files(entries: DataFrame, position_deletes: DataFrame | None = None, mode: str = "first_row") -> DataFrame:
    """P5e ∪ P5f: files removed from the snapshot (status 2) or emptied by
    position deletes.

    ``mode="first_row"`` keeps the reference heuristic: a delete of row 0
    counts the whole file as gone.  ``mode="exact"`` counts a file as gone
    only when its distinct deleted positions (:func:`deleted_counts`) reach its
    ``data_file.record_count``.
    """
    if mode not in ("first_row", "exact"):
        raise ValueError(f"mode must be 'first_row' or 'exact', not {mode!r}")
    removed = entries.where(F.col("status") == 2).select(F.col("data_file.file_path").alias("file_path"))
    if position_deletes is not None:
        if mode == "first_row":
            hit = position_deletes.where(F.col("pos") == 0).select("file_path")
        else:
            deleted = deleted_counts(deleted_positions(position_deletes))
            records = entries.where(F.col("data_file.content") == 0).select(
                F.col("data_file.file_path").alias("file_path"),
                F.col("data_file.record_count").alias("record_count"),
            ).distinct()
            hit = deleted.join(records, "file_path").where(F.col("n_deleted") >= F.col("record_count")).select("file_path")
        removed = removed.union(hit)
    return removed.distinct()


def deleted_positions(position_deletes: DataFrame) -> DataFrame:
    """P5f: ``(file_path, bucket, bits)``, the deleted positions of each file as bitmaps.

    A bitmap holds 32,768 positions and is built map-side, so repeated deletes
    of one position, or a file with very many of them, cost one bit each.
    """
    known = position_deletes.where("file_path IS NOT NULL AND pos IS NOT NULL")
    return known.groupBy("file_path", F.bitmap_bucket_number("pos").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bits")
    )


def merged_positions(*bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several sets of delete files as one ``(file_path, bucket, bits)``."""
    both = bitmaps[0].select("file_path", "bucket", "bits")
    for b in bitmaps[1:]:
        both = both.unionByName(b.select("file_path", "bucket", "bits"))
    return both.groupBy("file_path", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def deleted_counts(bitmaps: DataFrame) -> DataFrame:
    """``(file_path, n_deleted)``: distinct deleted positions; every file and bucket has one bitmap."""
    return bitmaps.groupBy("file_path").agg(F.sum(F.bitmap_count("bits")).alias("n_deleted"))


def live_rows(entries: DataFrame, partition_column: str, bitmaps: DataFrame) -> DataFrame:
    """``(partition_date, n_files, n_rows)`` of the partitions that still hold a row.

    The rows of a file are its ``data_file.record_count`` without the deleted
    positions; files with status 2 are gone, files without rows do not count.
    """
    named = F.col("data_file.file_path").alias("file_path")
    removed = entries.where("status = 2").select(named).distinct()
    files = entries.where((F.col("data_file.content") == 0) & F.col("status").isin(0, 1)).select(
        named, F.col(f"data_file.partition.{partition_column}").alias("partition_date"), F.col("data_file.record_count").alias("n")
    ).distinct().join(removed, "file_path", "left_anti")
    left = files.join(deleted_counts(bitmaps), "file_path", "left").withColumn(
        "n", F.greatest(F.col("n") - F.coalesce("n_deleted", F.lit(0)), F.lit(0))
    )
    return left.where("n > 0").groupBy("partition_date").agg(F.count("*").alias("n_files"), F.sum("n").cast("bigint").alias("n_rows"))


def drop_equal(rows: DataFrame, deletes: DataFrame, keys: list[str], sequence: str = "sequence", spread: int = 1) -> DataFrame:
    """``rows`` without those that an equality delete names: same ``keys`` and a later sequence number.

    A delete removes only rows that are older than itself; a null key equals a
    null key. Only the latest delete of a key matters, so the deletes are folded
    to one row per key first (map-side too): a key that is deleted very often
    costs one row. A key with very many *rows* is dealt over ``spread`` tasks by
    a salt, the folded deletes being repeated that many times.
    """
    taken, names = set(rows.columns), []
    for c in (*keys, "last", "salt"):
        name = f"_{c}"
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        names.append(name)
    *key_names, last, salt = names
    folded = deletes.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, key_names, strict=True)]).agg(F.max(sequence).alias(last))
    same = F.lit(True)
    for k, n in zip(keys, key_names, strict=True):
        same = same & rows[k].eqNullSafe(folded[n])
    left = rows
    if spread > 1:
        left = rows.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(spread)).cast("int"))
        folded = folded.withColumn(f"{salt}s", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        same = F.lit(True)
        for k, n in zip(keys, key_names, strict=True):
            same = same & left[k].eqNullSafe(folded[n])
        same = same & (left[salt] == folded[f"{salt}s"])
    met = left.join(folded, same, "left")
    return met.where(folded[last].isNull() | left[sequence].isNull() | (left[sequence] >= folded[last])).select(*[left[c] for c in rows.columns])


#: Paths that one file scan is given at least, and scans that a list is cut into at most.
SCAN_PATHS = 1000
SCANS = 16


def _scan(spark: SparkSession, file_format: str, paths: list[str]) -> DataFrame:
    if file_format == "avro":
        from daybook.sources.avro import read_avro

        return read_avro(spark, *paths)
    return spark.read.format(file_format).load(paths)


def read_many(spark: SparkSession, paths: DataFrame, file_format: str, columns: list[str], batch: int = SCAN_PATHS) -> DataFrame | None:
    """The files listed in ``paths(file_path)``, read some at a time and stored; None for no paths.

    A file scan takes its paths from the driver. They come partition by
    partition, ``batch`` of them to a scan; a list so long that this would give
    more than ``SCANS`` scans one after another is read in ``SCANS`` larger ones.
    """
    from daybook.session import scratch_path

    batch = max(batch, -(-paths.count() // SCANS))
    out, held = None, []

    def read() -> None:
        nonlocal out
        if out is None:
            out = scratch_path(spark, "listed_files")
        _scan(spark, file_format, held).select(*columns).write.mode("append").parquet(out)
        held.clear()

    for row in paths.select("file_path").toLocalIterator():
        held.append(row["file_path"])
        if len(held) == batch:
            read()
    if held:
        read()
    return None if out is None else spark.read.parquet(out)


def read_position_deletes(spark: SparkSession, entries: DataFrame, file_format: str = "parquet", batch: int = SCAN_PATHS) -> DataFrame | None:
    """The rows ``(file_path, pos)`` of the delete files that the entries list."""
    return read_many(spark, delete_files(entries), file_format, ["file_path", "pos"], batch)


def read_manifest_list(spark: SparkSession, path: str, file_format: str = "avro") -> DataFrame:
    """``(file_path)`` of the manifests in a manifest list."""
    return _scan(spark, file_format, [path]).select(F.col("manifest_path").alias("file_path"))


def read_manifest_entries(spark: SparkSession, manifests: DataFrame, file_format: str = "avro", batch: int = SCAN_PATHS) -> DataFrame | None:
    """The entries ``(status, data_file)`` of all manifests."""
    return read_many(spark, manifests, file_format, ["status", "data_file"], batch)


def live_partitions_of(
    spark: SparkSession, metadata_log: DataFrame, partition_column: str, *,
    manifest_format: str = "avro", delete_format: str = "parquet", base: str | None = None, mode: str = "first_row",
) -> DataFrame:
    """P5 from a table's metadata log to its live dates ``(partition_date)``.

    Newest metadata file → JSON document → current snapshot → manifest list →
    manifests → entries and delete files → live partitions. ``base`` is put
    before paths without a scheme. A table without a snapshot has no dates.
    """
    empty = spark.createDataFrame([], "partition_date date")

    def full(path: str) -> str:
        return path if base is None or "://" in path or path.startswith("/") else f"{base.rstrip('/')}/{path}"

    newest = latest_metadata_file(metadata_log).first()
    if newest is None:
        return empty
    document = spark.read.option("multiLine", "true").json(full(newest["file"]))
    snapshot = current_snapshot(document).first()
    if snapshot is None:
        return empty
    manifests = read_manifest_list(spark, full(snapshot["manifest_list"]), manifest_format)
    entries = read_manifest_entries(spark, manifests, manifest_format)
    if entries is None:
        return empty
    return live_partitions(entries, partition_column, read_position_deletes(spark, entries, delete_format), mode)


def metadata_log_of(documents: DataFrame) -> DataFrame:
    """The metadata log ``(file, timestamp)`` that a table's own metadata documents record.

    Each document names itself (``metadata-file``, ``last-updated-ms``) and, in
    ``metadata-log``, those before it; an entry that several documents hold is one.
    """
    own = documents.select(F.col("`metadata-file`").alias("file"), F.col("`last-updated-ms`").alias("ms"))
    logged = documents.select(F.explode("metadata-log").alias("e")).select(
        F.col("e.`metadata-file`").alias("file"), F.col("e.`timestamp-ms`").alias("ms")
    )
    return own.unionByName(logged).where("file IS NOT NULL").distinct().select("file", F.timestamp_millis("ms").alias("timestamp"))


def snapshots_as_of(asks: DataFrame, ask_time: str, metadata_log: DataFrame, documents: DataFrame, grain: str = "month") -> DataFrame:
    """P5a/P5b for a table of times: ``asks`` with ``snapshot_id`` and ``manifest_list`` of the snapshot that was
    current then (nulls before the first one).

    The metadata file in force comes from an as-of lookup, its current snapshot from its document.
    """
    from daybook.operators.asof import as_of

    held = as_of(asks, metadata_log, ask_time, "timestamp", ["file"], grain=grain)
    current = current_snapshot(documents.withColumnRenamed("metadata-file", "file"), keys=["file"])
    return held.join(current, "file", "left").select(*asks.columns, "snapshot_id", "manifest_list")


def live_files(
    entries: DataFrame, partition_column: str, position_deletes: DataFrame | None = None, mode: str = "first_row"
) -> DataFrame:
    """P5g: inserted files that were not removed, ``(file_path, partition_date)``."""
    return inserted_files(entries, partition_column).join(
        removed_files(entries, position_deletes, mode), "file_path", "left_anti"
    )


def live_partitions(
    entries: DataFrame, partition_column: str, position_deletes: DataFrame | None = None, mode: str = "first_row"
) -> DataFrame:
    """Distinct partition dates that still have a live data file, ``(partition_date)``."""
    return live_files(entries, partition_column, position_deletes, mode).select("partition_date").distinct()
