from __future__ import annotations

import pytest
from rows import rows
from pyspark.sql import functions as F

from saltmill.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows of key 1, one row each of keys 2 to 101, two rows with a NULL key."""
    many = spark.range(900).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    few = spark.range(2, 102).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    none = spark.range(2).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    return many.unionAll(few).unionAll(none)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(1, 60).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("n"))


def test_hot_keys_finds_the_hot_key(skewed):
    want = skewed.where("k = 1").select(F.xxhash64("k")).first()[0]
    assert joins.hot_keys(skewed.repartition(9), ["k"], share=0.1) == [want]


def test_hot_keys_are_bounded(spark):
    even = spark.range(1000).withColumn("k", F.col("id") % 10)
    assert len(joins.hot_keys(even, ["k"], share=0.1)) == 10
    assert joins.hot_keys(even, ["k"], share=0.2) == []
    assert joins.hot_keys(even.where("id < 0"), ["k"]) == []


def test_hot_keys_over_many_tasks(spark, conf):
    conf("spark.sql.shuffle.partitions", "1")
    df = spark.range(0, 6000, 1, 300).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k")
    )
    assert joins.hot_keys(df, ["k"]) == [df.where("k = 7").select(F.xxhash64("k")).first()[0]]


def test_hot_join_without_hot_key_is_a_plain_join(spark):
    even = spark.range(5000).withColumn("k", F.col("id"))
    out = joins.hot_join(even, spark.range(10).withColumnRenamed("id", "k"), "k")
    assert "_salt" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 10


def test_hot_join_with_empty_partitions_and_sides(spark, conf, skewed, dim):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "40")
    assert rows(joins.hot_join(skewed, dim, "k")) == rows(skewed.join(dim, "k"))
    assert joins.hot_join(skewed.where("v < 0"), dim, "k").collect() == []
    assert joins.hot_join(skewed, dim.where("k < 0"), "k").collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_join_equals_join(skewed, dim, how):
    assert rows(joins.hot_join(skewed, dim, "k", how, salts=7)) == rows(skewed.join(dim, "k", how))


def test_hot_join_with_struct_key(skewed, dim):
    left = skewed.withColumn("s", F.struct("k")).drop("k")
    right = dim.withColumn("s", F.struct("k")).drop("k")
    assert rows(joins.hot_join(left, right, "s", salts=5)) == rows(left.join(right, "s"))


def test_hot_join_of_equal_rows_uses_many_tasks(spark, conf, dim):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    same = spark.range(0, 4000, 1, 32).select(F.lit(1).alias("k"))
    out = joins.hot_join(same, dim, "k", salts=64)
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 4000
    assert len(per_task) >= 6 and max(r["count"] for r in per_task) < 2000


def test_hot_join_looks_in_another_table(skewed, dim):
    out = joins.hot_join(skewed, dim, "k", salts=3, hot_from=skewed.select("k"))
    assert rows(out) == rows(skewed.join(dim, "k"))


def test_hot_join_refuses_other_types_and_kinds(skewed, dim):
    with pytest.raises(TypeError):
        joins.hot_join(skewed, dim.withColumn("k", F.col("k").cast("long")), "k")
    with pytest.raises(ValueError):
        joins.hot_join(skewed, dim, "k", "full")


def test_fits_counts_rows_and_bytes(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert joins.fits(df)
    assert not joins.fits(df, max_rows=9)
    assert not joins.fits(df, max_bytes=1000)
    assert not joins.fits(df, max_rows=9, rows_of=spark.range(10))


@pytest.mark.parametrize("max_rows", [1000, 5])
def test_small_join_same_result_either_way(skewed, dim, max_rows):
    got = joins.small_join(skewed, dim, "k", "left", max_rows=max_rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (max_rows == 5)
    assert rows(got) == rows(skewed.join(dim, "k", "left"))


def test_unmatched_keeps_null_keys(skewed, dim):
    want = skewed.join(dim.withColumnRenamed("k", "d"), F.col("k") == F.col("d"), "left").where("d IS NULL")
    assert rows(joins.unmatched(skewed, dim, "k")) == rows(want.select("k", "v"))


def test_many_null_keys_are_spread(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = joins.unmatched(left, spark.range(10).withColumnRenamed("id", "k"), "k")
    per_task = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 2000
    assert len(per_task) >= 4
