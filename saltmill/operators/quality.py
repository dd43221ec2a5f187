"""Constraint checks as jobs. Each returns (table, rule, key, n) rows of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import hot_keys, small_join

# Rows whose keys one task counts; more rows than the shuffle partitions hold get more tasks.
GROUPED_ROWS = 1_000_000


def _report(df: DataFrame, table: str, rule: str, key: Column, n: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        key.cast("string").alias("key"),
        n.cast("long").alias("n"),
    )


def _key_text(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def check_not_null(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """NULL count per column (``key`` is the column name), from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("c")) for c in cols])
    found = counts.select(F.inline(rows)).where("c > 0")
    return _report(found, table, "not_null", F.col("k"), F.col("c"))


def _key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key as ``_n``. Tasks hold about GROUPED_ROWS rows, so their memory does not grow with
    the table; the few hot keys are counted before the shuffle.
    """
    count = F.count(F.lit(1)).alias("_n")
    tasks = -(-df.count() // GROUPED_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.groupBy(*keys).agg(count)
    hot = F.xxhash64(*keys).isin(hot_keys(df, keys))
    rest = df.where(~hot).repartition(tasks, *keys).groupBy(*keys).agg(count)
    return rest.unionAll(df.where(hot).groupBy(*keys).agg(count))


def check_unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL in it passes, as in a unique index."""
    whole = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    found = _key_counts(whole, keys).where("_n > 1")
    return _report(found, table, f"unique({', '.join(keys)})", _key_text(keys), F.col("_n"))


def check_fk(
    child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str
) -> DataFrame:
    """Child keys without a parent, with their row count; NULL passes.

    Child rows are counted per key before the join.
    """
    used = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = parent.select(F.col(parent_col).alias("_k")).distinct()
    found = used.join(known, "_k", "left_anti")
    return _report(found, table, f"foreign_key({col})", F.col("_k"), F.col("_n"))


def check_where(df: DataFrame, table: str, rule: str, col: str, ok: Column) -> DataFrame:
    """Values that fail a predicate, with their row count; NULL passes."""
    found = df.where(~ok).groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return _report(found, table, rule, F.col("_k"), F.col("_n"))


def check_range(df: DataFrame, table: str, col: str, low=None, high=None) -> DataFrame:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(col) >= F.lit(low))
    if high is not None:
        ok = ok & (F.col(col) <= F.lit(high))
    return check_where(df, table, f"range({col})", col, ok)


def check_enum(df: DataFrame, table: str, col: str, values: list[str]) -> DataFrame:
    return check_where(df, table, f"enum({col})", col, F.col(col).isin(*values))


def check_values(
    df: DataFrame,
    table: str,
    required: list[str],
    ranges: dict[str, tuple] | None = None,
    enums: dict[str, list[str]] | None = None,
) -> DataFrame:
    """NULLs, ranges and enums of a table in one scan and one aggregation.

    A row gives an entry per rule it breaks; entries are counted per rule and value. The
    rows are those of the single checks.
    """
    rules = [("not_null", F.lit(c), F.col(c).isNull()) for c in required]
    for c, (low, high) in (ranges or {}).items():
        rules.append((f"range({c})", F.col(c), ~F.col(c).between(F.lit(low), F.lit(high))))
    for c, values in (enums or {}).items():
        rules.append((f"enum({c})", F.col(c), ~F.col(c).isin(*values)))
    entries = [
        F.when(broken, F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("_k")))
        for rule, key, broken in rules
    ]
    broken = F.filter(F.array(*entries), lambda x: x.isNotNull())
    found = df.select(F.inline(broken)).groupBy("rule", "_k").agg(F.count(F.lit(1)).alias("_n"))
    return found.select(F.lit(table).alias("table"), "rule", F.col("_k").alias("key"), F.col("_n").alias("n"))


def summarize(violations: DataFrame) -> DataFrame:
    """Broken keys and rows per table and rule."""
    return violations.groupBy("table", "rule").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")
    )


def enum_rank(col: str, values: list[str]) -> Column:
    """Position in the declared order, 1 first; NULL for NULL, 0 for unknown values."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(col))


def plan_delete(doomed: DataFrame, key: str, children: list[tuple[DataFrame, str]]) -> DataFrame:
    """Delete set with ``allowed`` = false where a child row still refers to the key."""
    out = doomed.withColumn("allowed", F.lit(True))
    cols = doomed.columns
    for child, col in children:
        used = child.select(F.col(col).alias(key)).distinct().withColumn("_used", F.lit(True))
        out = out.join(used, key, "left").select(
            *cols, (F.col("allowed") & F.col("_used").isNull()).alias("allowed")
        )
    return out


def cascade_key(child: DataFrame, col: str, renamed: DataFrame) -> DataFrame:
    """Child rows with keys replaced by the (old, new) map; other keys stay."""
    by_old = renamed.select(F.col("old").alias(col), F.col("new").alias("_new"))
    out = small_join(child, by_old, col, "left")
    return out.select(
        *[F.coalesce("_new", col).alias(c) if c == col else F.col(c) for c in child.columns]
    )


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULLs replaced by the column default (a value or a Column)."""
    return df.select(
        *[
            F.coalesce(
                F.col(c),
                defaults[c] if isinstance(defaults[c], Column) else F.lit(defaults[c]),
            ).alias(c)
            if c in defaults
            else F.col(c)
            for c in df.columns
        ]
    )
