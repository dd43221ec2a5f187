from __future__ import annotations

import math
import random

import pytest

from saltmill.operators.selection import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _want(values, prob):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    return values[max(1, len(values) - math.floor(len(values) - len(values) * prob)) - 1]


def _check(spark, data):
    """``data``: rows (group, a, b)."""
    df = spark.createDataFrame(data, "g string, a double, b double").repartition(7)
    got = {}
    for r in exact_quantiles(df, ["a", "b"], PROBS, ["g"]).collect():
        assert (r["g"], r["column"], r["prob"]) not in got
        got[r["g"], r["column"], r["prob"]] = r["value"]
    want = {}
    for g in {r[0] for r in data}:
        for i, c in ((1, "a"), (2, "b")):
            values = [r[i] for r in data if r[0] == g and r[i] is not None]
            want |= {(g, c, p): _want(values, p) for p in PROBS if values}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == v or (math.isnan(got[k]) and math.isnan(v)), k


def test_quantiles_with_a_hot_group_and_value(spark):
    rng = random.Random(5)
    data = [("hot", rng.lognormvariate(0, 3), 7.0 if rng.random() < 0.4 else rng.gauss(7, 1e-9)) for _ in range(3000)]
    data += [(rng.choice("xyz"), rng.choice([None, -1.5, 0.0, 2.25]), rng.uniform(-1e6, 1e6)) for _ in range(500)]
    data += [(None, 1.0, None), (None, 3.0, None), ("empty", None, None)]
    _check(spark, data)


def test_quantiles_of_awkward_doubles(spark):
    inf, tiny = math.inf, 5e-324
    odd = [math.nan, inf, -inf, 0.0, tiny, -tiny, 1.7e308, -1.7e308, 2.2e-308, 1.0, math.nextafter(1.0, 2), -1.0]
    rng = random.Random(6)
    _check(spark, [("o", x, y) for x, y in zip(odd, reversed(odd))] + [("o", rng.choice(odd), 1.0) for _ in range(40)])


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, ["v"], [0.5]).collect() == []
    assert exact_quantiles(spark.range(1), ["id"], [0.5]).collect() == [("id", 0.5, 0.0)]
    with pytest.raises(ValueError):
        exact_quantiles(empty, ["v"], [1.5])


def test_quantiles_join_large_groups_by_shuffle(spark, monkeypatch):
    from saltmill.operators import joins

    monkeypatch.setattr(joins, "fits", lambda *a, **k: False)
    rng = random.Random(7)
    _check(spark, [(rng.choice("aaab"), rng.random(), rng.gauss(0, 1)) for _ in range(800)])
