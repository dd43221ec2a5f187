"""Profiles, quantiles, correlation and labelled subtotals; one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import merge_group

# Size of the quantile sketch for a relative rank error well below 0.01.
SKETCH_SIZE = 1000


def _stats_row(df: DataFrame, cols: list[str], stats: dict) -> DataFrame:
    """(column, stat, value) from one global aggregation."""
    one = df.agg(
        *[f(F.col(c)).alias(f"{i}_{j}") for i, c in enumerate(cols) for j, f in enumerate(stats.values())]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"{i}_{j}").alias("value"))
        for i, c in enumerate(cols)
        for j, s in enumerate(stats)
    ]
    return one.select(F.inline(F.array(*entries)))


def profile(df: DataFrame, cols: list[str], quantiles: list[float] | None = None) -> DataFrame:
    """(column, stat, value) for count, mean, stddev, min, max and asked quantiles."""
    basic = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    out = _stats_row(df, cols, basic)
    if quantiles:
        found = _sketches(df, cols)
        asked = {f"{q * 100:g}%": lambda c, q=q: _quantile(c, q) for q in quantiles}
        entries = [
            F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), f(F.col(c)).alias("value"))
            for c in cols
            for s, f in asked.items()
        ]
        out = out.unionAll(found.select(F.inline(F.array(*entries))))
    return out


def _sketches(df: DataFrame, cols: list[str]) -> DataFrame:
    """One quantile sketch per column, merged in two steps; NULLs are left out."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols], merge_group().alias("_g"))
    per_group = typed.groupBy("_g").agg(
        *[F.kll_sketch_agg_double(c, F.lit(SKETCH_SIZE)).alias(c) for c in cols]
    )
    return per_group.agg(*[F.kll_merge_agg_double(c, F.lit(SKETCH_SIZE)).alias(c) for c in cols])


def profile_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, stat, value) for count, min and max of columns of any type, as text."""
    stats = {"count": F.count, "min": F.min, "max": F.max}
    return _stats_row(df, cols, {s: lambda c, f=f: f(c).cast("string") for s, f in stats.items()})


def _quantile(sketch: Column, prob: float) -> Column:
    """Value at a rank share; NULL if the sketch saw no value."""
    filled = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(float(prob))))


def quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """(prob, value) within a relative rank error of 0.01; NULLs are left out."""
    entries = [
        F.struct(F.lit(float(p)).alias("prob"), _quantile(F.col(col), p).alias("value"))
        for p in probs
    ]
    return _sketches(df, [col]).select(F.inline(F.array(*entries)))


def rank_errors(df: DataFrame, found: DataFrame, col: str) -> DataFrame:
    """``found`` (prob, value) with the share of values below and up to each value, and ``error``:
    how far the probability lies outside of that span. One pass; NULLs are left out.

    ``found`` is a handful of rows and is read by the driver.
    """
    probes = [(r["prob"], r["value"]) for r in found.select("prob", "value").collect()]
    x = F.col(col).cast("double")
    counts = [F.count(x).alias("n")]
    for i, (_, v) in enumerate(probes):
        value = F.lit(v).cast("double")
        counts += [F.count_if(x < value).alias(f"b{i}"), F.count_if(x <= value).alias(f"u{i}")]
    entries = [
        F.struct(
            F.lit(p).alias("prob"),
            F.lit(v).cast("double").alias("value"),
            (F.col(f"b{i}") / F.nullif("n", F.lit(0))).alias("below"),
            (F.col(f"u{i}") / F.nullif("n", F.lit(0))).alias("upto"),
        )
        for i, (p, v) in enumerate(probes)
    ]
    spans = df.agg(*counts).select(F.inline(F.array(*entries)))
    error = F.greatest(F.lit(0.0), F.col("below") - F.col("prob"), F.col("prob") - F.col("upto"))
    return spans.withColumn("error", error)


def corr_clean(df: DataFrame, a: str, b: str, name: str = "corr") -> DataFrame:
    """Pearson correlation over rows where both values are present."""
    return df.agg(F.corr(a, b).alias(name))


def cov_clean(df: DataFrame, a: str, b: str, name: str = "cov") -> DataFrame:
    """Sample covariance over rows where both values are present."""
    return df.agg(F.covar_samp(a, b).alias(name))


def rollup_labeled(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Sum per key plus the grand total; ``is_total`` tells it from the NULL key."""
    return df.rollup(key).agg(value.alias(name), F.grouping(key).cast("int").alias("is_total"))
