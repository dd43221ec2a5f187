"""Top-k and rank filters without sorting a whole key group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import small_join
from .numbering import POSITION_BITS


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """First k rows; ``order`` must end in a unique column so ties are settled."""
    return df.orderBy(*order).limit(k)


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """One row per key, the first by ``order`` (which must settle ties).

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def rank_first(df: DataFrame, keys: list[str], order: str, name: str = "rank") -> DataFrame:
    """Rows of rank 1 by one ascending column (NULL first), ties kept.

    The ties of a key can be any share of the table, so rows are never gathered
    per key: the smallest value per key is joined back.
    """
    first = df.groupBy(F.struct(*keys).alias("_k")).agg(
        F.min(order).alias("_min"), F.count_if(F.col(order).isNull()).alias("_nulls")
    )
    first = first.select("_k", F.when(F.col("_nulls") == 0, F.col("_min")).alias("_first"))
    # Written once: the size check and the join then read the small result only.
    first = materialize(first, "rank-first")
    rows = small_join(df.withColumn("_k", F.struct(*keys)), first, "_k")
    return rows.where(F.col(order).eqNullSafe(F.col("_first"))).select(
        *df.columns, F.lit(1).alias(name)
    )


def dense_rank_upto(
    df: DataFrame, keys: list[str], order: str, upto: int, name: str = "dense_rank"
) -> DataFrame:
    """Rows of dense rank 1..upto by one ascending column (NULL first), ties kept.

    Ranks the distinct values per key, of which at most ``upto`` per key and task
    reach the shuffle, and joins the ranks back.
    """
    w = Window.partitionBy("_k").orderBy("_v")
    ranks = (
        df.select(F.struct(*keys).alias("_k"), F.struct(order).alias("_v"))
        .distinct()
        .withColumn(name, F.row_number().over(w))
        .where(F.col(name) <= upto)
    )
    ranks = materialize(ranks, "dense-rank")
    rows = df.withColumn("_k", F.struct(*keys)).withColumn("_v", F.struct(order))
    return small_join(rows, ranks, ["_k", "_v"]).select(*df.columns, name)


def running(
    df: DataFrame,
    keys: list[str],
    peers: list[str],
    ties: list[str],
    total: str | None = None,
    names: tuple[str, str, str, str] = ("row_number", "rank", "dense_rank", "running_sum"),
) -> DataFrame:
    """Row number, rank, dense rank and running sum of every row, whatever the share of its key.

    Rows of a key are ordered by ``peers``, which decide the ranks, then by ``ties``, which must
    settle the order (both ascending, NULL first). The table is sorted by ranges of key and
    order, so a large key is spread over many ranges, and windows run within a range only. What
    a range needs of those before it (rows, sum, distinct values, where its first value began)
    comes from one row per range and key; only keys of several ranges have such rows, at
    most two per range. ``total`` should be a whole number or a decimal: sums of
    doubles depend on the order of addition.
    """
    order = [*keys, *peers, *ties]
    stored = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "running")
    stored = stored.withColumn("_part", F.shiftright("_id", POSITION_BITS))
    value, key, add = F.struct(*peers), F.struct(*keys), F.col(total) if total else F.lit(0).cast("long")
    rows = stored.withColumns({"_k": key, "_v": value, "_add": add})
    local = Window.partitionBy("_part", "_k").orderBy("_id")
    by_value = Window.partitionBy("_part", "_k").orderBy("_v")
    rows = rows.withColumns({
        "_rn": F.row_number().over(local),
        "_rank": F.rank().over(by_value),
        "_dense": F.dense_rank().over(by_value),
        "_sum": F.sum("_add").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    ranges = rows.groupBy("_part", "_k").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_add").alias("s"),
        F.max("_dense").alias("d"),
        F.min("_v").alias("first"),
        F.max("_v").alias("last"),
        F.max("_rank").alias("last_rank"),
    )
    ranges = materialize(ranges, "running-ranges")
    several = ranges.groupBy("_k").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("_k")
    ranges = small_join(ranges, materialize(several, "running-keys"), "_k", "left_semi")
    # One row per range of a key.
    w = Window.partitionBy("_k").orderBy("_part")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumns({
        "_rows": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "_total": F.sum("s").over(before),
        "_goes_on": F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(w)) & (F.row_number().over(w) > 1), F.lit(False)),
    })
    # Where the last value of a range began; a range of one value that goes on began earlier.
    began = F.when(~F.col("_goes_on") | (F.col("d") > 1), F.col("_rows") + F.col("last_rank"))
    ranges = ranges.withColumn("_began", F.last(began, ignorenulls=True).over(upto))
    ranges = ranges.select(
        "_part", "_k", "_rows", "_total", "_goes_on",
        F.lag("_began").over(w).alias("_first_rank"),
        (F.coalesce(F.sum("d").over(before), F.lit(0)) - F.sum(F.col("_goes_on").cast("int")).over(upto)).alias("_values"),
    )
    rows = small_join(rows, materialize(ranges, "running-carry"), ["_part", "_k"], "left")
    ahead = F.coalesce("_rows", F.lit(0))
    out = [
        (ahead + F.col("_rn")).cast("long"),
        F.when(F.col("_goes_on") & (F.col("_rank") == 1), F.col("_first_rank")).otherwise(ahead + F.col("_rank")).cast("long"),
        (F.coalesce("_values", F.lit(0)) + F.col("_dense")).cast("long"),
        F.when(F.col("_total").isNull(), F.col("_sum")).otherwise(F.col("_total") + F.coalesce("_sum", F.lit(0))),
    ]
    wanted = list(zip(out, names, strict=True))[: 4 if total else 3]
    return rows.select(*df.columns, *[c.alias(name) for c, name in wanted])
