from __future__ import annotations

import pytest
from rows import rows
from pyspark.sql import functions as F

from saltmill import schemas
from saltmill.operators import quality


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(1, 10), (1, 11), (9, 12), (9, 13), (None, 14)], "parent_id int, v int")


def test_not_null(parent):
    assert rows(quality.check_not_null(parent, "p", ["id", "name"])) == [("p", "not_null", "name", 1)]


def test_unique(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "z"), (None, "z")], "a int, b string")
    assert rows(quality.check_unique(df, "t", ["a", "b"])) == [
        ("t", "unique(a, b)", "1|x", 2),
    ]
    named = spark.createDataFrame([("NULL", 1), ("NULL", 1), (None, 1), (None, 1)], "a string, b int")
    assert rows(quality.check_unique(named, "t", ["a", "b"])) == [("t", "unique(a, b)", "NULL|1", 2)]


def test_values_in_one_pass(spark):
    df = spark.createDataFrame([(1900, "G"), (1901, "X"), (2155, None), (2156, "G"), (None, "X")], "y int, r string")
    single = (
        quality.check_not_null(df, "f", ["y", "r"])
        .unionAll(quality.check_range(df, "f", "y", *schemas.YEARS))
        .unionAll(quality.check_enum(df, "f", "r", schemas.RATINGS))
    )
    whole = quality.check_values(df, "f", ["y", "r"], {"y": schemas.YEARS}, {"r": schemas.RATINGS})
    assert rows(whole) == rows(single) and len(rows(whole)) == 5
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan") == 1


def test_time_defaults_come_from_outside(spark):
    as_of = F.lit("2022-02-03 04:05:06").cast("timestamp")
    empty = spark.createDataFrame([(None, None, None)], "activebool boolean, create_date date, last_update timestamp")
    row = quality.apply_defaults(empty, schemas.typed_defaults("customer", as_of)).first()
    assert (row["activebool"], str(row["create_date"]), str(row["last_update"])) == (
        True, "2022-02-03", "2022-02-03 04:05:06",
    )
    assert set(schemas.typed_defaults("customer")) == {"activebool"}
    assert set(schemas.typed_defaults("actor", as_of)) == {"last_update"}


def test_foreign_key_lets_null_pass(child, parent):
    got = quality.check_fk(child, "c", "parent_id", parent, "id")
    assert rows(got) == [("c", "foreign_key(parent_id)", "9", 2)]


def test_range_and_enum_let_null_pass(spark):
    df = spark.createDataFrame([(1900, "G"), (1901, "X"), (2155, None), (2156, "G"), (None, "X")], "y int, r string")
    assert rows(quality.check_range(df, "f", "y", *schemas.YEARS)) == [
        ("f", "range(y)", "1900", 1),
        ("f", "range(y)", "2156", 1),
    ]
    assert rows(quality.check_enum(df, "f", "r", schemas.RATINGS)) == [("f", "enum(r)", "X", 2)]


def test_enum_sorts_by_declaration(spark):
    df = spark.createDataFrame([(r,) for r in sorted(schemas.RATINGS)], "r string")
    got = df.orderBy(quality.enum_rank("r", schemas.RATINGS))
    assert [x["r"] for x in got.collect()] == schemas.RATINGS


def test_summary(child, parent):
    found = quality.check_fk(child, "c", "parent_id", parent.where("id = 2"), "id")
    assert rows(quality.summarize(found)) == [("c", "foreign_key(parent_id)", 2, 4)]


def test_plan_delete_over_two_children(spark, parent, child):
    other = spark.createDataFrame([(2,)], "p int")
    got = quality.plan_delete(parent.select("id"), "id", [(child, "parent_id"), (other, "p")])
    assert rows(got) == [(1, False), (2, False), (3, True)]


def test_cascade(child, spark):
    renamed = spark.createDataFrame([(1, 100)], "old int, new int")
    got = quality.cascade_key(child, "parent_id", renamed)
    assert got.columns == child.columns
    assert rows(got) == sorted([(100, 10), (100, 11), (9, 12), (9, 13), (None, 14)], key=repr)


def test_defaults(spark):
    df = spark.createDataFrame([(None, None), (1, "x")], "a int, b string")
    got = quality.apply_defaults(df, {"a": 5, "b": F.lit("d")})
    assert rows(got) == [(1, "x"), (5, "d")]


def test_declared_defaults_have_column_types(spark):
    schema = schemas.rental_schema("film")
    film = spark.createDataFrame([(None,) * len(schema)], "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema) + ">")
    row = quality.apply_defaults(film, schemas.typed_defaults("film")).first()
    assert (row["rental_duration"], str(row["rental_rate"]), str(row["replacement_cost"]), row["rating"]) == (3, "4.99", "19.99", "G")


def test_unique_keys_are_counted_by_small_tasks(spark, monkeypatch):
    """Memory of a task follows the rows it gets, so many rows get more tasks than shuffle partitions."""
    # Key 0 is hot; the keys from 1 to 400 come twice, those up to 4000 once.
    pairs = [(0, 0)] * 2_000 + [(i, -i) for i in range(1, 4_001)] + [(i, -i) for i in range(1, 401)]
    df = spark.createDataFrame([*pairs, (None, 1), (None, 1)], "a long, b long")
    monkeypatch.setattr(quality, "GROUPED_ROWS", 100)
    found = quality.check_unique(df, "t", ["a", "b"])
    assert "64)" in found._jdf.queryExecution().executedPlan().toString()
    got = {r["key"]: r["n"] for r in found.collect()}
    assert got == {"0|0": 2_000} | {f"{i}|{-i}": 2 for i in range(1, 401)}
