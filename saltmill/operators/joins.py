"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot above this share of the rows, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.002
# Counters of the frequent-items sketch; its error stays below half of HOT_SHARE.
SKETCH_ITEMS = 3072
# Sketches of the scan tasks are merged in this many groups before the last merge.
MERGE_GROUPS = 256


def _names(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def fits(
    df: DataFrame,
    max_rows: int = 200_000,
    max_bytes: int = 32 << 20,
    rows_of: DataFrame | None = None,
) -> bool:
    """True if the table has at most max_rows rows and max_bytes bytes of text form.

    Rows are counted first (file footers only, for a plain scan); sizes are added
    up only for a table with few rows. ``rows_of`` is a cheaper table known to have
    at least as many rows, counted instead.
    """
    if (df if rows_of is None else rows_of).count() > max_rows:
        return False
    size = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns),
        F.lit(0).cast("long"),
    )
    return (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def merge_group() -> Column:
    """Group number of a task, for aggregates whose partial results are large."""
    return F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys holding at least ``share`` of the rows (about 1 / share at most)."""
    return list(hot_shares(df, keys, share))


def hot_shares(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> dict[int, float]:
    """The same, each with its share of the rows.

    One pass over the key columns with a mergeable sketch: no shuffle by key.
    A key missed or added by the sketch changes the balance, never the result.
    """
    limit = int(1 / share)
    per_group = (
        df.select(F.xxhash64(*keys).alias("h"), merge_group().alias("g"))
        .groupBy("g")
        .agg(
            F.expr(f"approx_top_k(h, {limit}, {max(SKETCH_ITEMS, limit)})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # At most MERGE_GROUPS rows of at most limit counters reach the driver.
    seen, total = Counter(), 0
    for group in per_group.collect():
        total += group["n"]
        for item, n in group["top"]:
            seen[item] += n
    return {h: n / total for h, n in seen.most_common(limit) if n >= total * share}


def hot_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    salts: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose hot left keys are spread over several tasks.

    A hot key gets salts by its share of the rows, two at least, ``salts`` (the number of
    shuffle partitions) for half of the rows or more. Left rows of a hot key get a salt from a hash of the whole row and of the task
    they come from, so equal rows are spread too and a retry gives the same salt;
    the matching right rows are repeated once per salt. Without a hot key this is a
    plain join. ``right`` should have few rows per key (a dimension, or an aggregate).

    Hot keys are looked for, by a job of its own, in ``hot_from``, by default
    ``left``. If ``left`` is itself the result of a join, pass the table its keys
    were scanned from.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"hot_join cannot do a {how} join")
    keys = _names(on)
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a.simpleString() != b.simpleString():
            raise TypeError(f"join key {k}: {a.simpleString()} against {b.simpleString()}")
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    hot = hot_shares(left if hot_from is None else hot_from, keys)
    if not hot:
        return left.join(right, keys, how)
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_key = {h: max(2, min(salts, math.ceil(2 * share * salts))) for h, share in hot.items()}
    table = F.create_map(*[F.lit(x) for pair in of_key.items() for x in pair])
    key_salts = F.coalesce(F.try_element_at(table, F.xxhash64(*keys)), F.lit(1))
    row_salt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), key_salts)
    salted_left = left.withColumn("_salt", row_salt.cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), key_salts - 1)))
    return salted_left.join(salted_right, keys + ["_salt"], how).drop("_salt")


def small_join(
    big: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_rows: int = 200_000,
    max_bytes: int = 32 << 20,
    rows_of: DataFrame | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Broadcast ``dim`` if a check of its size allows it, else a salted shuffle join.

    See ``fits`` for ``rows_of`` and ``hot_join`` for ``hot_from``.
    """
    if fits(dim, max_rows, max_bytes, rows_of):
        return big.join(F.broadcast(dim), _names(on), how)
    return hot_join(big, dim, on, how, hot_from=hot_from)


def unmatched(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left rows without a right row; rows with a NULL key have none.

    The right side is cut to its distinct keys, so its copies are combined before
    the shuffle; a hot left key, or very many NULL keys, are salted.
    """
    return hot_join(left, right, on, "left_anti")
