"""Dense row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# Spark puts the partition in the bits above 33 and the position below.
POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str | Column], name: str, start: int = 1) -> DataFrame:
    """Add start, start + 1, ... in ``order`` (which must settle ties).

    The table is range-partitioned and sorted in parallel, and written once with
    partition and position, so numbers stay the same if a task runs again. Only
    the row count per partition is gathered to find the offsets.
    """
    stored = materialize(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "number-rows"
    )
    part = F.shiftright("_id", POSITION_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sorted table.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_id") - F.shiftleft(F.col("_part"), POSITION_BITS)
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start).cast("long"))
        .select(*df.columns, name)
    )


def assign_ids(df: DataFrame, id_col: str, order: list[str | Column]) -> DataFrame:
    """Fill NULL ids with max(id) + 1, max(id) + 2, ... in ``order``; given ids stay.

    The input is written once, so that one that is not stable cannot give an id twice.
    """
    df = materialize(df, "assign-ids")
    top = df.agg(F.max(id_col)).first()[0] or 0
    missing = number_rows(df.where(F.col(id_col).isNull()).drop(id_col), order, id_col, top + 1)
    given = df.where(F.col(id_col).isNotNull())
    typed = missing.withColumn(id_col, F.col(id_col).cast(df.schema[id_col].dataType))
    return given.unionByName(typed)
