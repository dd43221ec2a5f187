from __future__ import annotations

import pytest
from rows import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from saltmill.operators import sets

PAIRS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=12)
RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.fixture(scope="module")
def table(spark):
    return lambda data: spark.createDataFrame(data, "name string, age int")


def test_common_rows_and_difference(table):
    a, b = table([("oak", 4), ("elm", 9), ("elm", 9)]), table([("oak", 4), ("elm", 9), ("ash", 1)])
    assert rows(sets.intersect_rows(a, b)) == [("elm", 9), ("oak", 4)]
    assert rows(sets.except_all(a, b)) == [("elm", 9)]


@RELAXED
@given(PAIRS, PAIRS)
def test_equal_to_spark(table, x, y):
    a, b = table(x), table(y)
    assert rows(sets.intersect_rows(a, b)) == rows(a.intersect(b))
    assert rows(sets.except_all(a, b)) == rows(a.exceptAll(b))


@RELAXED
@given(PAIRS, PAIRS)
def test_difference_and_common_part_rebuild_the_input(table, x, y):
    a, b = table(x), table(y)
    assert rows(sets.except_all(a, b).unionAll(a.intersectAll(b))) == rows(a)


def test_many_copies_are_split(spark, monkeypatch):
    monkeypatch.setattr(sets, "COPIES_PER_TASK", 100)
    df = spark.createDataFrame([("a", 1050), ("b", 1), ("c", 0), ("d", 100)], "k string, n long")
    got = sets.repeat_rows(df, "n").groupBy("k").count()
    assert rows(got) == [("a", 1050), ("b", 1), ("d", 100)]


def test_all_users(spark):
    riders = spark.createDataFrame([("u1", "A", "B", False)], "user_uuid string, name string, surname string, is_driver boolean")
    drivers = spark.createDataFrame([("d1", "C", "D", "car")], "driver_uuid string, name string, surname string, car_uuid string")
    assert rows(sets.all_users(riders, drivers)) == [("d1", "C", "D", True), ("u1", "A", "B", False)]
