from __future__ import annotations

import pytest
from rows import rows
from pyspark.sql import functions as F

from saltmill.operators import sampling, stats


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _rank_error(df, col: str, value: float, prob: float) -> float:
    """How far prob lies outside the share range that equals value, 0 if inside."""
    n, below, upto = df.agg(
        F.count(col), F.count_if(F.col(col) < value), F.count_if(F.col(col) <= value)
    ).first()
    return max(0.0, below / n - prob, prob - upto / n)


def test_quantiles_within_one_percent(lines):
    for row in stats.quantiles(lines.repartition(7), "l_extendedprice", [0.25, 0.5, 0.75]).collect():
        assert _rank_error(lines, "l_extendedprice", row["value"], row["prob"]) <= 0.01


def test_summary_quantiles_within_one_percent(lines):
    got = stats.profile(lines, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75]).where("stat LIKE '%\\%'")
    found = got.collect()
    assert len(found) == 6
    for row in found:
        assert _rank_error(lines, row["column"], row["value"], float(row["stat"][:-1]) / 100) <= 0.01


def test_profile_equals_describe(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (4, 5.0)], "a int, b double")
    got = {(r["column"], r["stat"]): r["value"] for r in stats.profile(df, ["a", "b"]).collect()}
    for row in df.describe("a", "b").collect():
        for col in ("a", "b"):
            assert got[col, row["summary"]] == pytest.approx(float(row[col]))


def test_quantiles_leave_out_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,)], "v double")
    assert stats.quantiles(df, "v", [0.5]).first()["value"] == 2.0


def test_quantiles_with_empty_partitions(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "40")
    df = spark.range(0, 100, 1, 8).where("id < 11").withColumn("v", F.col("id").cast("double"))
    assert stats.quantiles(df, "v", [0.5]).first()["value"] == 5.0
    assert stats.quantiles(df.where("id < 0"), "v", [0.5]).first()["value"] is None
    assert stats.quantiles(df.withColumn("v", F.lit(None).cast("double")), "v", [0.5]).first()["value"] is None


def test_correlation_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (50.0, None)], "a double, b double")
    whole = df.dropna()
    assert stats.corr_clean(df, "a", "b").first()[0] == pytest.approx(whole.corr("a", "b"))
    assert stats.cov_clean(df, "a", "b").first()[0] == pytest.approx(whole.cov("a", "b"))
    assert stats.corr_clean(df, "a", "b").first()[0] > 0.9 > df.fillna(0).corr("a", "b")


def test_rollup_tells_null_group_from_total(spark):
    df = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    got = stats.rollup_labeled(df, "k", F.sum("v"), "s")
    assert rows(got) == sorted([("x", 1, 0), (None, 2, 0), (None, 3, 1)], key=repr)


# ---- samples ---------------------------------------------------------------


def test_sample_share_and_stability(spark):
    df = spark.range(20_000)
    kept = sampling.sample_rows(df, ["id"], 0.5, 1)
    n = kept.count()
    assert abs(n - 10_000) < 3 * (20_000 * 0.25) ** 0.5
    again = sampling.sample_rows(df.repartition(5), ["id"], 0.5, 1)
    assert kept.exceptAll(again).isEmpty() and again.count() == n
    assert not sampling.sample_rows(df, ["id"], 0.5, 2).exceptAll(kept).isEmpty()


def test_sample_ends(spark):
    df = spark.range(500)
    assert sampling.sample_rows(df, ["id"], 0.0, 1).count() == 0
    assert sampling.sample_rows(df, ["id"], 1.0, 1).count() == 500


def test_sample_by_drops_unlisted_strata(spark):
    df = spark.range(9000).withColumn("s", F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")))
    got = {r["s"]: r["count"] for r in sampling.sample_by(df, ["id"], "s", {"a": 0.5, "b": 1.0}, 1).groupBy("s").count().collect()}
    assert set(got) == {"a", "b"} and got["b"] == 3000
    assert abs(got["a"] - 1500) < 3 * (3000 * 0.25) ** 0.5


def test_splits_cover_the_input_once(spark):
    df = spark.range(10_000)
    got = sampling.split_rows(df, ["id"], [3, 4, 3], 5)
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert got.count() == got.select("id").distinct().count() == 10_000
    for i, share in enumerate([0.3, 0.4, 0.3]):
        assert abs(counts[i] - 10_000 * share) < 200
