"""Sums kept up by signed changes instead of a full recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.paths import children, exists


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete snapshots, oldest first."""
    found = [int(d.removeprefix("version=")) for d in children(spark, root) if d.startswith("version=")]
    return sorted(v for v in found if exists(spark, f"{root}/version={v}/_SUCCESS"))


def read_sums(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Key columns, the sum and ``rows``, the number of rows behind it, after the newest batch."""
    done = _versions(spark, root)
    if not done:
        return spark.createDataFrame([], f"{schema}, rows BIGINT")
    return spark.read.schema(f"{schema}, rows BIGINT").parquet(f"{root}/version={done[-1]}")


def apply_changes(
    changes: DataFrame, root: str, batch: int, schema: str, amount: str, sign: str = "sign"
) -> bool:
    """Merge a batch of signed rows into the stored sums; False if it was merged before.

    ``changes`` has the columns of ``schema`` (keys and ``amount``, a whole number or decimal) and
    ``sign``: 1 for a row that came, -1 for one that went; a correction is one of each. Rows are
    added up per key before they meet the stored sums, so the work follows the size of the batch
    and of the sums, not of the table behind them. A key without rows leaves. Batch numbers rise;
    a batch that stopped is written again, one that is complete is passed over. NULL amounts
    count as rows without an amount.
    """
    spark = changes.sparkSession
    done = _versions(spark, root)
    if done and batch <= done[-1]:
        return False
    stored = read_sums(spark, root, schema)
    kind, keys = stored.schema[amount].dataType, [c for c in stored.columns if c not in (amount, "rows")]
    signed = F.coalesce(F.col(amount), F.lit(0)) * F.col(sign)
    delta = changes.groupBy(*keys).agg(
        F.sum(signed).cast(kind).alias(amount), F.sum(F.col(sign).cast("long")).alias("rows")
    )
    merged = stored.unionByName(delta).groupBy(*keys).agg(
        F.sum(amount).cast(kind).alias(amount), F.sum("rows").alias("rows")
    )
    merged.where("rows <> 0").write.mode("overwrite").parquet(f"{root}/version={batch}")
    return True
