"""Repeatable samples: a row's fate depends on its key and the seed only.

The same rows are chosen for every partitioning, file order and retry. Rows with
equal keys share one fate, so the key should be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HASH_RANGE = 1 << 32


def unit_hash(key: list[str], seed: int) -> Column:
    """Integer in [0, 2^32) from the key columns and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _bound(share: float) -> int:
    return round(share * HASH_RANGE)


def sample_rows(df: DataFrame, key: list[str], fraction: float, seed: int) -> DataFrame:
    """Each row kept with probability ``fraction``."""
    return df.where(unit_hash(key, seed) < _bound(fraction))


def sample_by(
    df: DataFrame, key: list[str], stratum: str, fractions: dict[object, float], seed: int
) -> DataFrame:
    """Own fraction per stratum; strata that are not listed are dropped."""
    bound = F.lit(0)
    for value, fraction in fractions.items():
        bound = F.when(F.col(stratum) == F.lit(value), F.lit(_bound(fraction))).otherwise(bound)
    return df.where(unit_hash(key, seed) < bound)


def split_rows(
    df: DataFrame, key: list[str], weights: list[float], seed: int, name: str = "split"
) -> DataFrame:
    """Number each row's split, 0 to len(weights) - 1; weights are normalized."""
    total = float(sum(weights))
    ends, run = [], 0.0
    for w in weights[:-1]:
        run += w
        ends.append(_bound(run / total))
    h = unit_hash(key, seed)
    number = F.lit(0)
    for end in ends:
        number = number + (h >= end).cast("int")
    return df.withColumn(name, number)
