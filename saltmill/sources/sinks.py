"""Raw and staged folders, and the monthly store."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import materialize
from .files import RECORD, read_raw, read_raw_checked
from .paths import exists, replace_dir, under


def land(df: DataFrame, base: str, path: str, allow_empty: bool = False) -> str:
    """Replace a raw folder below ``base`` by JSON files with the rows of ``df``.

    No rows: the old folder stays and the call fails, unless ``allow_empty``.
    """
    target = under(base, path)
    replace_dir(df, target, "json", keep=None if allow_empty else "no rows to land")
    return target


def write_json_arrays(df: DataFrame, path: str, per_file: int = 5000) -> None:
    """Write indented JSON arrays of at most ``per_file`` records, one array per file, all in
    one folder.

    Rows are numbered in a written copy first, so a task that runs again deals the
    same rows to the same array. Arrays are dealt to the tasks by number; a task starts a
    file for each.
    """
    stored = materialize(df.withColumn("_id", F.monotonically_increasing_id()), "json-arrays")
    pages = stored.groupBy(F.expr(f"_id div {int(per_file)}").alias("page")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns)), {"pretty": "true"}).alias("value")
    )
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)


def stage(
    spark: SparkSession,
    base: str,
    raw_dir: str,
    stg_dir: str,
    schema: T.StructType,
    fmt: str = "parquet",
    indented: bool = False,
    rejects_dir: str | None = None,
) -> str:
    """Read a raw folder, check the required fields and replace the staged folder.

    A missing source, a line that is no record, or a NULL in a field declared not nullable,
    fails the call and leaves the old target in place. With ``rejects_dir`` such lines and
    records go there instead, as JSON with ``_record`` (the text of a line that is no record)
    and the fields that were read; the rest is staged.
    """
    source, target = under(base, raw_dir), under(base, stg_dir)
    if not exists(spark, source):
        raise FileNotFoundError(f"source folder {source} does not exist")
    required = [f.name for f in schema if not f.nullable]
    if rejects_dir is not None:
        rows, broken = read_raw_checked(spark, source, schema, indented)
        gap = F.lit(False)
        for name in required:
            gap = gap | F.col(name).isNull()
        lacking = rows.where(gap).withColumn(RECORD, F.lit(None).cast("string"))
        replace_dir(lacking.unionByName(broken), under(base, rejects_dir), "json")
        replace_dir(rows.where(~gap).select(*schema.names), target, fmt)
        return target
    rows = read_raw(spark, source, schema, indented).select(*schema.fieldNames())
    for f in schema:
        if not f.nullable:
            missing = F.raise_error(F.lit(f"NULL in required field {f.name}")).cast(f.dataType)
            rows = rows.withColumn(f.name, F.coalesce(F.col(f.name), missing))
    replace_dir(rows, target, fmt)
    return target


def month_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def split_months(df: DataFrame, ts: str, first: str, last: str) -> tuple[DataFrame, DataFrame]:
    """(stored, rejected): rows inside and outside the months first..last (yyyy-MM).

    A NULL time is rejected. The stored part carries its month in ``month``.
    """
    month = month_of(ts)
    inside = F.coalesce(month.between(first, last), F.lit(False))
    return df.where(inside).withColumn("month", month), df.where(~inside)


def write_monthly(df: DataFrame, ts: str, path: str, first: str, last: str) -> DataFrame:
    """Write one folder per month, replacing only the months present; returns the rejects.

    The rebalance gathers a month into few files and splits a large month by size,
    so a month with a third of the rows is written by many tasks.
    """
    stored, rejected = split_months(df, ts, first, last)
    (
        stored.hint("rebalance", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )
    return rejected


def read_monthly(
    spark: SparkSession, path: str, schema: T.StructType, ts: str, start: date, end: date
) -> DataFrame:
    """Rows with start <= ts < end; the month filter skips the other folders."""
    full = T.StructType([*schema.fields, T.StructField("month", T.StringType())])
    rows = spark.read.schema(full).parquet(path)
    return rows.where(
        F.col("month").between(f"{start:%Y-%m}", f"{end - timedelta(days=1):%Y-%m}")
        & (F.col(ts) >= F.lit(start))
        & (F.col(ts) < F.lit(end))
    ).drop("month")
