"""Filter interaction audit: what each of five filters removes in every order of them.

Every text is measured once and gets a mask, one bit per failed filter; documents are counted
per part and mask (cells, at most 32 per part). A recursive query extends filter prefixes: level
s holds every sequence of s different letters with the bits applied so far, joins the cells of
its part and emits the numbers of that step: 5 + 20 + 60 + 120 + 120 prefixes per part, whatever
the size of the corpus. Full orders then look up their five prefixes.

Filters, on words that are maximal runs without ASCII white space: A fewer than ``min_words``
words; B distinct words below half of the words; C more than 3 % of the code points in A to Z;
D holds one of # $ % & * |; E text equal to that of a smaller doc_id, anywhere in the table.

For E, equal texts meet by their SHA-256: the smallest id per digest is found by a combined
aggregation, and joined back to the rows with the digests that are hot dealt over salts.

NULL text is an empty one (and fails A, and E beside another empty text of a smaller id), NULL
lang is the part ''. A NULL doc_id is smaller than nothing and never fails E; rows repeated
with their id do not fail E against each other. Several label rows of one document: a flag
holds if any row sets it. Without documents there are no parts and no rows. Other columns are
not read. Texts are measured whole, one Arrow batch of them in memory at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.joins import small_join
from ..session import materialize
from .common import counted_join, pick
from .registry import query

LETTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))


def failed(text: bytes, min_words: int = MIN_WORDS) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    words = text.split()
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < min_words)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def measure(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """doc_id, part, digest of the text and mask of the failed filters A to D, row by row."""
    rows = pick(docs, doc_id=id_column, part=part_column, text=text_column).select(
        "doc_id",
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    schema = T.StructType(
        [*rows.schema.fields[:2], T.StructField("digest", T.BinaryType()), T.StructField("mask", T.IntegerType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for cell in batch.column(2):
                text = cell.as_buffer().to_pybytes()
                digests.append(hashlib.sha256(text).digest())
                masks.append(failed(text, min_words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def with_copies(measured: DataFrame) -> DataFrame:
    """The same rows, the bit of E set where a smaller id has the same text."""
    measured = materialize(measured, "audit-masks")
    # Only texts that occur twice can fail; the counts tell which of them are hot.
    shared = measured.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.where("n > 1"), "audit-shared-texts")
    spread = F.struct("doc_id", F.spark_partition_id())
    rows = counted_join(measured, shared, "digest", "n", spread, "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.withColumn("mask", F.col("mask").bitwiseOR(F.when(copy, 16).otherwise(0))).drop("first", "digest")


def graded(
    masks: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    good_column: str = "quality",
    toxic_column: str = "toxic",
) -> DataFrame:
    """Rows with the flags ``good`` and ``toxic`` of the labels; false without a label."""
    flags = pick(labels, doc_id=id_column, quality=good_column, toxic=toxic_column).where("doc_id is not null")
    flags = flags.groupBy(F.col("doc_id").cast(masks.schema["doc_id"].dataType).alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = small_join(masks, materialize(flags, "audit-labels"), "doc_id", "left")
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})


def cells(rows: DataFrame) -> DataFrame:
    """One row per part: its masks with the number of documents, of good and of toxic ones."""
    counts = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    # At most 32 masks per part.
    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


# What a filter with ``bit`` does to the cells after the filters in ``bits``.
_METRICS = {
    "kept": ("n", "c.mask & (bits | bit) = 0"),
    "removed": ("n", "c.mask & bits = 0 AND c.mask & bit <> 0"),
    "redundant": ("n", "c.mask & bits <> 0 AND c.mask & bit <> 0"),
    "unique_fails": ("n", "c.mask = bit"),
    "good_lost": ("good", "c.mask & bits = 0 AND c.mask & bit <> 0"),
    "toxic_lost": ("toxic", "c.mask & bits = 0 AND c.mask & bit <> 0"),
}


def _levels(letters: str) -> str:
    sums = ", ".join(
        f"aggregate(cells, 0L, (total, c) -> total + if({when}, c.{what}, 0L)) AS {name}"
        for name, (what, when) in _METRICS.items()
    )
    zeros = ", ".join("0L" for _ in _METRICS)
    names = ", ".join(_METRICS)
    return f"""
    WITH RECURSIVE levels(part, prefix, letter, bits, step, {names}) AS (
      SELECT part, '', '', 0, 0, {zeros} FROM {{cells}}
      UNION ALL
      SELECT part, prefix || letter, letter, bits | bit, step + 1, {sums}
      FROM (
        SELECT part, prefix, bits, step, cells, substr('{letters}', i + 1, 1) AS letter, shiftleft(1, i) AS bit
        FROM (
          SELECT l.part, l.prefix, l.bits, l.step, c.cells, explode(sequence(0, {len(letters) - 1})) AS i
          FROM levels l JOIN {{cells}} c ON l.part = c.part)
      ) WHERE bits & bit = 0
    )
    SELECT * FROM levels WHERE step > 0"""


def steps(per_part: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Part, prefix, its last letter, bits, step and the numbers of that step, for every prefix.

    Levels and rows of the recursion depend on the letters and the parts only. Spark stops a
    recursion at a million rows unless told otherwise, so the limit is lifted for this job.
    """
    spark, limit = per_part.sparkSession, "spark.sql.cteRecursionRowLimit"
    per_part = materialize(per_part, "audit-cells")
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return materialize(spark.sql(_levels(letters), cells=per_part), "audit-steps")
    finally:
        spark.conf.set(limit, before)


def orders(levels: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every part, full order and step with the numbers of its prefix, and ``shapley``: what the
    filter of the step removes, summed over all orders and steps."""
    n = len(letters)
    every = levels.where(F.col("step") == n).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")
    )
    every = every.withColumn("prefix", F.col("filter_order").substr(F.lit(1), F.col("step")))
    rows = every.join(levels.drop("step", "bits"), ["part", "prefix"])
    # One row per part and letter.
    total = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(total, ["part", "letter"]).select("part", "filter_order", "step", *_METRICS, "shapley")


def audit(docs: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The whole audit of documents and labels under their usual column names."""
    return orders(steps(cells(graded(with_copies(measure(docs, min_words)), labels))))


_SQL_WORD = r"[^\x20\x09-\x0D]+"


@query(
    "op12_filter_audit",
    rf"""
    WITH RECURSIVE texts AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
    flags AS (
      SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    measured AS (
      SELECT t.doc_id, t.part, t.text, t.doc_id > f.first AS copy,
        coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
        regexp_extract_all(t.text, '{_SQL_WORD}') AS w
      FROM texts t JOIN firsts f ON t.text = f.text LEFT JOIN flags l ON t.doc_id = l.doc_id),
    masks AS (
      SELECT part, good, toxic,
        CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN copy THEN 16 ELSE 0 END AS mask
      FROM measured),
    cells AS (
      SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
    prefixes AS (
      SELECT '' AS prefix, '' AS letter, 0 AS bits, 0 AS bit, 0 AS step
      UNION ALL
      SELECT p.prefix || l.letter, l.letter, p.bits + p.bit, l.bit, p.step + 1
      FROM prefixes p, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) l(letter, bit)
      WHERE ((p.bits + p.bit) & l.bit) = 0),
    levels AS (
      SELECT c.part, p.prefix, p.letter, p.step,
        sum(CASE WHEN (c.mask & (p.bits + p.bit)) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN (c.mask & p.bits) = 0 AND (c.mask & p.bit) <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN (c.mask & p.bits) <> 0 AND (c.mask & p.bit) <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN c.mask = p.bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN (c.mask & p.bits) = 0 AND (c.mask & p.bit) <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN (c.mask & p.bits) = 0 AND (c.mask & p.bit) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM cells c, prefixes p WHERE p.step > 0 GROUP BY ALL),
    every AS (
      SELECT o.part, o.prefix AS filter_order, l.* EXCLUDE (part)
      FROM levels o JOIN levels l ON o.part = l.part AND starts_with(o.prefix, l.prefix) WHERE o.step = 5)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
      CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
      CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
      CAST(toxic_lost AS BIGINT) AS toxic_lost,
      CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM every""",
)
def op12_filter_audit(load) -> DataFrame:
    """All 120 orders of the five filters, per language."""
    return audit(load("documents"), load("labels"))
