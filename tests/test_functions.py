from __future__ import annotations

import datetime as dt

import pytest
from rows import rows
from pyspark.sql import functions as F

from saltmill.functions import dates, strings


def test_pg_concat_and_pipe(spark):
    df = spark.createDataFrame([("A", None), (None, "B"), ("A", "B")], "a string, b string")
    got = df.select(strings.pg_concat("a", F.lit(" "), "b").alias("c"), F.concat("a", F.lit(" "), "b"))
    assert [tuple(r) for r in got.collect()] == [("A ", None), (" B", None), ("A B", "A B")]


@pytest.mark.parametrize("text, want", [("JOHN", "John"), ("de la CRUZ", "De la cruz"), ("", ""), (None, None), ("éA", "Éa")])
def test_capitalize(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strings.capitalize("t")).first()[0] == want


def test_group_concat(spark):
    data = [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (3, "it's")]
    df = spark.createDataFrame(data, "k int, v string")
    assert rows(strings.group_concat(df, ["k"], "v", "c")) == [(1, "a, b, b"), (2, None), (3, "it's")]
    assert rows(strings.group_concat(df, ["k"], "v", "c", distinct=True)) == [(1, "a, b"), (2, None), (3, "it's")]
    for distinct, text in ((False, "a, b, b"), (True, "a, b")):
        got = strings.group_concat(df, ["k"], "v", "c", distinct=distinct, count_copies=False)
        assert rows(got) == [(1, text), (2, None), (3, "it's")]
    assert rows(strings.group_concat(df, ["k"], "v", "c", sep="'|\\")) == [(1, "a'|\\b'|\\b"), (2, None), (3, "it's")]


@pytest.mark.parametrize(
    "text, shape, real",
    [
        ("2022-08-09", True, True),
        ("2022-99-01", True, False),
        ("2022-02-30", True, False),
        ("invalid-date", False, False),
        ("2022-08-09-extra", False, False),
        ("2022-8-9", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_valid_date(spark, text, shape, real):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(dates.valid_date("t"), dates.real_date("t")).first()) == (shape, real)


def test_month_start_back(spark):
    df = spark.createDataFrame([(dt.date(2022, 5, 31),), (dt.date(2022, 1, 15),)], "d date")
    got = [r[0] for r in df.select(dates.month_start_back("d", 3)).collect()]
    assert got == [dt.date(2022, 2, 1), dt.date(2021, 10, 1)]


@pytest.mark.parametrize(
    "hours, allowed, want", [(72, 3, 0), (71, 3, 0), (73, 3, 0), (96, 3, 1), (108, 3, 1), (None, 3, 0)]
)
def test_whole_days_over(spark, hours, allowed, want):
    start = dt.datetime(2022, 1, 1)
    end = None if hours is None else start + dt.timedelta(hours=hours)
    df = spark.createDataFrame([(start, end, allowed)], "s timestamp, e timestamp, a int")
    assert df.select(dates.whole_days_over(F.col("s"), F.col("e"), F.col("a"))).first()[0] == want
