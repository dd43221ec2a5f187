"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import tune

# Word patterns as Java regular expressions; positive classes, since Java's negated
# unions of ranges are many times slower.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Records per Arrow batch: texts may be long, so batches are kept short.
BATCH_ROWS = 256
# A key is hot above this share of the rows and this many rows.
HOT_SHARE = 0.002
HOT_ROWS = 5_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus queries."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores in front where the table has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column, pattern: str) -> Column:
    """Array of words; NULL text has none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def count_words(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def row_key(*columns: str) -> Column:
    """A 64-bit name for a row; rows equal in these columns share it, NULLs included."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(modulus))


def hashed_sample(rows: DataFrame, group: str, key: str, k: int, max_groups: int) -> DataFrame:
    """At most ``k`` rows per group, the first by a hash of ``key``; ``max_groups`` groups at most.

    Keys of groups are counted first, and rows thinned by their hash to about 4 k per group before they
    meet, so what a task ranks does not grow with the table. The hash of a key is the same in
    every run. NULL groups and keys are left out; a key that a group has several times counts
    once and gives one row.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(key).isNotNull())
    # One row per group, max_groups at most.
    counts = rows.groupBy(group).agg(F.approx_count_distinct(key).alias("n")).orderBy(F.desc("n"), group)
    share = {r[0]: min(1.0, 4 * k / r["n"]) for r in counts.limit(max_groups).collect()}
    if not share:
        return rows.limit(0)
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    place = F.xxhash64(F.lit("sample"), F.col(key))
    # The upper 32 bits of the hash as a number from 0 to 1.
    part = F.shiftrightunsigned(place, 32) / F.lit(float(1 << 32))
    first = Window.partitionBy(group).orderBy("_place", key)
    return (
        rows.where(part < F.coalesce(F.try_element_at(shares, F.col(group)), F.lit(0.0)))
        .dropDuplicates([group, key])
        .withColumn("_place", place)
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= k)
        .drop("_place", "_rank")
    )


def map_rows(df: DataFrame, fn: Callable[..., list], schema: str, setup: Callable | None = None):
    """Apply ``fn(*column values) -> tuple`` to every row in Arrow batches.

    ``setup`` runs once per task and gives ``fn`` its first argument.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if setup is None else (setup(),)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [fn(*first, *r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)],
                schema=arrow,
            )

    return df.mapInArrow(run, fields)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
    "array<double>": pa.list_(pa.float64()),
    "array<binary>": pa.list_(pa.binary()),
}


def counted_join(
    left: DataFrame, right: DataFrame, key: str, n: str, spread: Column, how: str = "inner"
) -> DataFrame:
    """Join ``left`` to one right row per key, whose column ``n`` counts the left rows.

    Keys above HOT_SHARE of all rows (at most 1 / HOT_SHARE of them) are known by their
    hashes from the counts; their left rows are dealt over salts by a hash of ``spread``, and their right
    row is repeated once per salt. ``right`` should be materialized: it is read twice more.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    bar = max(HOT_ROWS, int(total * HOT_SHARE))
    found = right.where(F.col(n) >= bar).select(F.xxhash64(key), n).collect()
    hot = {r[0]: r[1] // bar + 1 for r in found}
    right = right.drop(n)
    if not hot:
        return left.join(right, key, how)
    table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    salts = F.coalesce(F.try_element_at(table, F.xxhash64(key)), F.lit(1)).cast("long")
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), salts))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")
