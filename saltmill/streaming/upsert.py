"""Keyed upserts from a stream: change log, latest view, compaction.

Layout below a root folder: ``changes/batch_id=N`` holds the rows and rejects of one
batch and is overwritten if the batch runs again; ``snapshots/upto=N`` holds one row per key
for all batches up to N and counts once its _SUCCESS file is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import first_per_key
from ..sources.paths import children, exists, remove_older
from .ingest import CORRUPT, read_batches, write_batches


def split_payload(df: DataFrame, parts: list[str], seq: str) -> dict[str, DataFrame]:
    """One table per nested struct, each with the arrival number."""
    return {p: df.where(F.col(p).isNotNull()).select(f"{p}.*", seq) for p in parts}


def _by_latest(df: DataFrame, seq: str) -> list[Column]:
    """Newest first; rows of one arrival number by the greatest hash of their values."""
    return [F.desc(seq), F.desc(F.xxhash64(*df.columns)), *[F.desc(c) for c in df.columns]]


def latest(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Last write per key."""
    return first_per_key(df, keys, *_by_latest(df, seq))


def log_changes(stream: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append each batch of a stream to the change log.

    The stream has the nested parts and the arrival number, and, if it was parsed
    from text, the rejects: a payload that lacks a part changes no table.
    """
    if CORRUPT not in stream.columns:
        stream = stream.withColumn(CORRUPT, F.lit(None).cast("string"))
    return write_batches(stream, f"{root}/changes", checkpoint, every)


def changes(
    spark: SparkSession, root: str, schema: T.StructType, after: int = -1, upto: int | None = None
) -> DataFrame:
    """Logged rows of the complete batches past ``after``, up to ``upto``; other folders, and
    a batch that is being written or was left half done, are not read."""
    done = [b for b in complete_batches(spark, root, after) if upto is None or b <= upto]
    return read_batches(spark, f"{root}/changes", schema, done).where(~F.col("rejected"))


def complete_batches(spark: SparkSession, root: str, after: int = -1) -> list[int]:
    """Numbers past ``after`` of the batches that were written to the end.

    The list is as long as the time since the last ``trim`` makes it.
    """
    base = f"{root}/changes"
    ids = [int(d.removeprefix("batch_id=")) for d in children(spark, base) if d.startswith("batch_id=")]
    return sorted(b for b in ids if b > after and exists(spark, f"{base}/batch_id={b}/_SUCCESS"))


def newest_snapshot(spark: SparkSession, root: str, name: str) -> int | None:
    """Batch number of the newest complete snapshot of a table."""
    base = f"{root}/snapshots/{name}"
    done = [
        int(d.removeprefix("upto="))
        for d in children(spark, base)
        if d.startswith("upto=") and exists(spark, f"{base}/{d}/_SUCCESS")
    ]
    return max(done, default=None)


def current(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    part: str,
    keys: list[str],
    seq: str,
    upto: int | None = None,
) -> DataFrame:
    """Last write per key of one nested part: newest snapshot plus later batches."""
    snap = newest_snapshot(spark, root, part)
    logged = changes(spark, root, schema, -1 if snap is None else snap, upto)
    fresh = split_payload(logged, [part], seq)[part]
    if snap is not None:
        stored = spark.read.schema(fresh.schema).parquet(f"{root}/snapshots/{part}/upto={snap}")
        fresh = stored.unionByName(fresh)
    return latest(fresh, keys, seq)


def compact(
    spark: SparkSession, root: str, schema: T.StructType, part: str, keys: list[str], seq: str
) -> int | None:
    """Write a new snapshot up to the last complete batch; old folders wait for ``trim``.

    Returns the number of the newest snapshot, None if there is nothing to write.
    """
    snap = newest_snapshot(spark, root, part)
    ids = complete_batches(spark, root, -1 if snap is None else snap)
    if not ids:
        return snap
    rows = current(spark, root, schema, part, keys, seq, ids[-1])
    rows.write.mode("overwrite").parquet(f"{root}/snapshots/{part}/upto={ids[-1]}")
    return ids[-1]


def trim(spark: SparkSession, root: str, parts: list[str], grace_seconds: float) -> list[str]:
    """Delete what no reader needs: batches that the newest snapshots of all ``parts`` hold, and
    older snapshots. Returns the folders deleted.

    Folders younger than ``grace_seconds`` stay, for readers that have listed them; the grace
    must be longer than any read. A part without a snapshot keeps all batches.
    """
    newest = {p: newest_snapshot(spark, root, p) for p in parts}
    if not parts or any(n is None for n in newest.values()):
        return []
    held = min(newest.values())
    doomed = [f"{root}/changes/batch_id={b}" for b in complete_batches(spark, root) if b <= held]
    for p, n in newest.items():
        names = [d for d in children(spark, f"{root}/snapshots/{p}") if d.startswith("upto=")]
        doomed += [f"{root}/snapshots/{p}/{d}" for d in names if int(d.removeprefix("upto=")) < n]
    return [d for d in doomed if remove_older(spark, d, grace_seconds)]


def merge_touch(
    stored: DataFrame,
    updates: DataFrame,
    keys: list[str],
    seq: str,
    touched: str,
    as_of: Column,
) -> DataFrame:
    """Upsert that refreshes ``touched`` (a last-update time).

    An update to a key that exists sets it to ``as_of``; a new key keeps the time
    it brings, else ``as_of``; stored rows without an update stay as they are.
    ``stored`` has one row per key and no ``seq`` column.
    """
    cols = stored.columns
    both = stored.withColumn(seq, F.lit(None).cast(updates.schema[seq].dataType)).withColumn(
        "_new", F.lit(0)
    ).unionByName(updates.select(*cols, seq).withColumn("_new", F.lit(1)))
    # Combined map-side: one row per key and task reaches the shuffle.
    rest = [c for c in cols if c not in keys]
    row = F.struct(*rest)
    last = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.struct("_new", seq, row.alias("row"))).alias("_last"),
    )
    given = F.col(f"_last.row.{touched}")
    time = (
        F.when(F.col("_last._new") == 0, given)
        .when(F.col("_n") > 1, as_of)
        .otherwise(F.coalesce(given, as_of))
    )
    return last.select(
        *[
            F.col(c) if c in keys else (time if c == touched else F.col(f"_last.row.{c}")).alias(c)
            for c in cols
        ]
    )
