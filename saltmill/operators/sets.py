"""Set operations that combine copies before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Copies of one row emitted by one task before the work is spread further.
COPIES_PER_TASK = 100_000


def intersect_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both; one aggregation, so copies are combined map-side."""
    cols = a.columns
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionAll(
        b.select(*cols).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    hits = both.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return hits.where("_a = 1 AND _b = 1").select(*cols)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times; a row with very many copies is split over tasks."""
    cols = [c for c in df.columns if c != times]
    step = F.lit(COPIES_PER_TASK)
    chunks = df.where(F.col(times) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / step).cast("int")))
    )
    spread = chunks.repartition(*cols, "_chunk")
    left = F.least(step.cast("long"), F.col(times) - F.col("_chunk") * step).cast("int")
    return spread.select(*cols, F.explode(F.sequence(F.lit(1), left)).alias("_i")).drop("_i")


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference: a row stays (copies in a - copies in b) times."""
    cols = a.columns
    signed = a.withColumn("_n", F.lit(1)).unionAll(b.select(*cols).withColumn("_n", F.lit(-1)))
    return repeat_rows(signed.groupBy(*cols).agg(F.sum("_n").alias("_n")), "_n")


def all_users(riders: DataFrame, drivers: DataFrame) -> DataFrame:
    """Riders and drivers as one user list; drivers get ``is_driver`` = true."""
    recast = drivers.select(
        F.col("driver_uuid").alias("user_uuid"), "name", "surname", F.lit(True).alias("is_driver")
    )
    return riders.select("user_uuid", "name", "surname", "is_driver").unionByName(recast)


def text_key(text: str) -> Column:
    """A 256-bit hash that stands for a long text as a key; NULL for NULL."""
    return F.unhex(F.sha2(text, 256))


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """Distinct rows; the long text column is compared and sorted by its hash."""
    rest = [c for c in df.columns if c != text]
    return df.withColumn("_text", text_key(text)).dropDuplicates(["_text", *rest]).drop("_text")
