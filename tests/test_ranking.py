from __future__ import annotations

import random

import pytest
from rows import rows
from pyspark.sql import Window, functions as F

from saltmill.operators import numbering, ranking


@pytest.fixture(scope="module")
def people(spark):
    data = [("m", 0, 1), ("m", 0, 2), ("m", 1, 3), ("f", 1, 4), ("f", 2, 5), ("f", 3, 6)]
    data += [(None, 1, 7), (None, 1, 8), (None, 2, 9), ("x", None, 10), ("x", 1, 11), ("x", 2, 12)]
    return spark.createDataFrame(data, "sex string, survived int, id int")


def _window(df, fn, name):
    return df.withColumn(name, fn.over(Window.partitionBy("sex").orderBy("survived")))


def test_rank_first_equals_window(people):
    want = _window(people, F.rank(), "rank").where("rank = 1")
    assert rows(ranking.rank_first(people, ["sex"], "survived")) == rows(want)


def test_dense_rank_upto_equals_window(people):
    want = _window(people, F.dense_rank(), "dense_rank").where(F.col("dense_rank").isin(1, 2))
    assert rows(ranking.dense_rank_upto(people, ["sex"], "survived", 2)) == rows(want)


def test_first_per_key_settles_ties(people):
    got = ranking.first_per_key(people, ["sex"], "survived", F.desc("id"))
    assert rows(got.select("sex", "id")) == sorted([("f", 4), ("m", 2), ("x", 10), (None, 8)], key=repr)


def test_top_k_tie_at_the_end(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 9)], "id int, n int")
    assert [r["id"] for r in ranking.top_k(df, 2, F.desc("n"), "id").collect()] == [4, 1]


def test_number_rows_is_dense_over_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("v"))
    got = numbering.number_rows(df, ["v"], "n", start=10)
    assert got.where(F.col("n") != F.col("v") + 10).count() == 0
    assert got.count() == 5000


def test_number_rows_of_nothing(spark):
    assert numbering.number_rows(spark.range(0), ["id"], "n").collect() == []


def test_assign_ids_keeps_given_ids(spark):
    df = spark.createDataFrame([(3, "a"), (None, "c"), (None, "b"), (7, "d")], "id int, name string")
    got = numbering.assign_ids(df, "id", ["name"])
    assert got.schema == df.schema
    assert rows(got) == [(3, "a"), (7, "d"), (8, "b"), (9, "c")]


# ---- all rows of hot keys -----------------------------------------------------


def _all_windows(docs):
    """(key, peer, tie, amount) with row number, rank, dense rank and running sum, plainly."""
    out, none_first = [], lambda v: (v is not None, v)
    for key in {d[0] for d in docs}:
        mine = sorted((d for d in docs if d[0] == key), key=lambda d: (none_first(d[1]), d[2]))
        values = [d[1] for d in mine]
        distinct = sorted(set(values), key=none_first)
        done = None
        for i, d in enumerate(mine):
            done = done if d[3] is None else (done or 0) + d[3]
            out.append((*d, i + 1, values.index(d[1]) + 1, distinct.index(d[1]) + 1, done))
    return sorted(out, key=repr)


def _running_rows(n, seed, keys="aaab", values=5):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        key, value = rng.choice([*keys, None]), rng.choice([None, *range(values)])
        docs.append((key, value, i, rng.choice([None, rng.randrange(-50, 50)])))
    return docs


@pytest.mark.parametrize("n, values", [(0, 5), (1, 5), (400, 1), (400, 3), (400, 100)])
@pytest.mark.parametrize("parts", ["1", "13"])
def test_running_over_ranges_of_hot_keys(spark, conf, n, values, parts):
    """One key with most rows and values that fill whole ranges."""
    conf("spark.sql.shuffle.partitions", parts)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = _running_rows(n, values, values=values)
    df = spark.createDataFrame(docs, "key string, value int, tie int, amount long")
    assert rows(ranking.running(df, ["key"], ["value"], ["tie"], "amount")) == _all_windows(docs)


def test_running_keeps_a_hot_key_out_of_one_task(spark, conf):
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).selectExpr("'k' AS key", "0 AS value", "id AS tie")
    got = ranking.running(df, ["key"], ["value"], ["tie"], names=("i", "r", "d", "s"))
    assert got.columns == ["key", "value", "tie", "i", "r", "d"]
    assert got.where("i <> tie + 1 OR r <> 1 OR d <> 1").count() == 0
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3 and max(t["count"] for t in tasks) < 2000
