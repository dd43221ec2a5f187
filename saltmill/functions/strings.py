"""String functions with fixed NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pg_concat(*parts: str | Column) -> Column:
    """CONCAT as in PostgreSQL: NULL counts as an empty string."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def capitalize(name: str | Column) -> Column:
    """First letter upper, the rest lower; words after a blank stay lower."""
    c = F.col(name) if isinstance(name, str) else name
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def group_concat(
    df: DataFrame,
    keys: list[str],
    value: str,
    name: str,
    sep: str = ", ",
    distinct: bool = False,
    count_copies: bool = True,
) -> DataFrame:
    """Values per key joined in ascending order; NULL values skipped, all-NULL gives NULL.

    Copies are counted first, so the rows of a hot key are combined before the
    shuffle and only its distinct values meet. Without ``count_copies`` that
    step is left out, which saves a shuffle where copies are rare. The joined text is one
    cell and must fit in one.
    """
    if not count_copies and distinct:
        values = F.array_sort(F.collect_set(value)).cast("array<string>")
        joined = F.when(F.size(values) > 0, F.array_join(values, sep))
        return df.groupBy(*keys).agg(joined.alias(name))
    if not count_copies:
        return df.groupBy(*keys).agg(_listed(value, value, sep).alias(name))
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    piece = F.col(value).cast("string")
    if not distinct:
        piece = F.when(piece.isNotNull(), F.array_join(F.array_repeat(piece, F.col("_n")), sep))
    pairs = counted.withColumn("_piece", piece)
    return pairs.groupBy(*keys).agg(_listed("_piece", value, sep).alias(name))


def _listed(piece: str, order: str, sep: str) -> Column:
    listed = f"listagg(CAST(`{piece}` AS STRING), '{_quoted(sep)}') WITHIN GROUP (ORDER BY `{order}`)"
    return F.expr(listed)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
