"""Sums kept up by signed batches against sums over all rows."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from rows import rows

from saltmill.plans import maintained

SCHEMA = "key string, amount decimal(12,2)"


def merge(spark, root, batch, changes):
    df = spark.createDataFrame(changes, f"{SCHEMA}, sign int")
    return maintained.apply_changes(df, root, batch, SCHEMA, "amount")


def test_batches_equal_a_full_sum(spark, tmp_path):
    rng = random.Random(1)
    table, root = [], str(tmp_path / "sums")
    assert rows(maintained.read_sums(spark, root, SCHEMA)) == []
    for batch in range(1, 5):
        news = [(rng.choice([*"aaaaab", None]), Decimal(rng.randrange(-999, 999)) / 100) for _ in range(40)]
        old = rng.sample(table, len(table) // 2)
        for row in old:
            table.remove(row)
        table += news
        assert merge(spark, root, batch, [(*r, 1) for r in news] + [(*r, -1) for r in old])
        want = defaultdict(lambda: [Decimal(0), 0])
        for key, amount in table:
            want[key][0] += amount
            want[key][1] += 1
        got = {r["key"]: [r["amount"], r["rows"]] for r in maintained.read_sums(spark, root, SCHEMA).collect()}
        assert got == want


def test_a_repeated_batch_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "sums")
    assert merge(spark, root, 1, [("a", Decimal(1), 1)])
    assert merge(spark, root, 2, [("a", Decimal(2), 1)])
    assert not merge(spark, root, 1, [("a", Decimal(1), 1)])
    assert not merge(spark, root, 2, [("a", Decimal(9), 1)])
    assert rows(maintained.read_sums(spark, root, SCHEMA)) == [("a", Decimal("3.00"), 2)]


def test_a_stopped_batch_is_written_again(spark, tmp_path):
    """A snapshot without its mark is not read, and the batch runs again over the one before."""
    root = str(tmp_path / "sums")
    merge(spark, root, 1, [("a", Decimal(1), 1), ("b", None, 1)])
    merge(spark, root, 2, [("a", Decimal(5), 1)])
    (tmp_path / "sums" / "version=2" / "_SUCCESS").unlink()
    assert rows(maintained.read_sums(spark, root, SCHEMA)) == [("a", Decimal("1.00"), 1), ("b", Decimal("0.00"), 1)]
    assert merge(spark, root, 2, [("a", Decimal(4), 1)])
    assert rows(maintained.read_sums(spark, root, SCHEMA))[0] == ("a", Decimal("5.00"), 2)


@pytest.mark.parametrize("amount", [Decimal(1), None])
def test_a_key_without_rows_leaves(spark, tmp_path, amount):
    root = str(tmp_path / "sums")
    merge(spark, root, 1, [("a", amount, 1), ("b", Decimal(0), 1)])
    merge(spark, root, 2, [("a", amount, -1)])
    assert rows(maintained.read_sums(spark, root, SCHEMA)) == [("b", Decimal("0.00"), 1)]
