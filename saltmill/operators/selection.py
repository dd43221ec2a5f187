"""Exact order statistics by counting ranges, without a sort.

The values of a column are counted in ranges that keep their order, each with its least and
greatest value; the range that holds the wanted rank is cut into finer ones, until a range holds
one value only. The first ranges are sixteenths of a power of two, so a range is at most 5 %
wide, and every further round makes it RANGES times narrower: six rounds settle any double, two or
three are usual. A round is one scan for all columns, groups and probabilities. Counts are combined
before they are shuffled, and what a group sends on is bounded by its ranges, so neither a hot group
nor a hot value gathers rows in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import small_join

# Ranges per round; the first round has at most 2 * 2125 * 16 and a few for special values.
RANGES = 4096
OCTAVE_PARTS = 16
# Beyond every octave: infinities, then NaN, which Spark orders last.
_INFINITE, _NAN = 90_000, 90_001


def _octave(x: Column) -> Column:
    """A number that never falls as x grows, for any double."""
    part = F.floor((F.log2(F.abs(x)) + 1100) * OCTAVE_PARTS)
    infinite = float("inf")
    return (
        F.when(F.isnan(x), _NAN)
        .when(x == infinite, _INFINITE)
        .when(x == -infinite, -_INFINITE)
        .when(x == 0, 0)
        .when(x < 0, -part)
        .otherwise(part)
        .cast("long")
    )


def _counted(rows: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Ranges with the values up to and including them, ``upto``, and in all of the key, ``n``."""
    ranges = (
        rows.withColumn("bucket", bucket)
        .groupBy(*keys, "bucket")
        .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    )
    key = Window.partitionBy(*keys)
    run = key.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return ranges.withColumns({"upto": F.sum("c").over(run), "n": F.sum("c").over(key)})


def _holding(ranges: DataFrame) -> DataFrame:
    """The range that holds the rank, and the rank within it."""
    before = F.col("upto") - F.col("c")
    held = ranges.where((before < F.col("rank")) & (F.col("rank") <= F.col("upto")))
    return held.select("key", "prob", "lo", "hi", (F.col("rank") - before).alias("rank"))


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], by: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """(by..., column, prob, value): the least value that at least ``prob`` of the values do not exceed.

    Columns are taken as doubles, NULLs are left out; a group or column without a value has no row. NULL
    groups are groups. NaN is the greatest value. ``df`` is scanned once per round.
    """
    if not cols or not all(0 <= p <= 1 for p in probs):
        raise ValueError("give columns, and probabilities from 0 to 1")
    values = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]
    )
    each = df.select(*[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], F.inline(values))
    key = F.struct(*[f"by_{i}" for i in range(len(by))], "column")
    each = each.where("x is not null").select(key.alias("key"), "x")

    first = _counted(each, ["key"], _octave(F.col("x")))
    asked = first.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    # Ranks count from 1; the form of the product keeps halves and quarters exact.
    rank = F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("n") * F.col("prob")))
    state = materialize(_holding(asked.withColumn("rank", rank)), "quantile-ranges")
    done = state.where("not lo < hi")
    while not (open_ := state.where("lo < hi")).isEmpty():
        near = small_join(each, open_.withColumnsRenamed({"lo": "l", "hi": "h"}), "key")
        near = near.where("x between l and h")
        bucket = F.floor((F.col("x") - F.col("l")) / (F.col("h") - F.col("l")) * RANGES)
        finer = _counted(near, ["key", "prob", "rank"], bucket)
        state = materialize(_holding(finer), "quantile-ranges")
        done = done.unionByName(state.where("not lo < hi"))
    groups = [F.col(f"key.by_{i}").alias(c) for i, c in enumerate(by)]
    return done.select(*groups, "key.column", "prob", F.col("lo").alias("value"))
