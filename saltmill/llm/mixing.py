"""Mixing sources to target weights.

Documents are packed per source into blocks of ``block`` words, or of fewer for a source whose target
spans only a few such blocks (``block_of``). Every output shard draws
how many blocks it takes of each source from a multinomial; a source's slots run through a
pseudorandom permutation of its block numbers (again from the start when they are used
up), and slots and blocks are joined by number.

Each shard draws from what is left of the targets, so noise of earlier shards is made up
by later ones. NULL sources are one source, the last; documents without words are in no
block. Repeated rows are packed
one by one. An empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import SPACED_WORD, count_words, pick, row_key
from .registry import query

# Sources are a configured list, not data: more than this is taken for a mistake.
MAX_SOURCES = 100_000
# Shards are drawn on the driver, with a count per shard and source.
MAX_SHARDS, MAX_COUNTS = 4_096, 1_000_000
# Packing units per corpus beside one per source: their table goes through the driver.
MAX_UNITS = 16_384
# A target spans about this many blocks at least, but blocks have this many words unless the
# target is below two of them.
LEAST_BLOCKS, LEAST_BLOCK = 16, 8


def targets_of(sizes: list[int], weights: list[float], cap: float = 3.0) -> list[float]:
    """Words to take of each source: shares of the total by weight, at most cap times the size.

    What a capped source cannot take is shared again by weight among the others.
    """
    left, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    out = [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def block_of(target: float, block: int) -> int:
    """Words of a block of a source with this target, so that a quota in blocks can come near it."""
    small = max(LEAST_BLOCK, int(target) // LEAST_BLOCKS)
    return max(1, min(block, small, int(target) // 2))


def draw_shards(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts: a multinomial per shard over what is left of the quotas."""
    rng = np.random.default_rng(seed)
    left = np.array(quotas, dtype=np.int64)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    for k in range(shards):
        total = int(left.sum())
        if not total:
            break
        slots = total // (shards - k)
        if k == shards - 1:
            out[k] = left
            break
        drawn = rng.multinomial(slots, left / total)
        out[k] = np.minimum(drawn, left)
        left -= out[k]
    return out


def permuted(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of j in a pseudorandom permutation of 0..n-1 (n and key per element).

    A four-round Feistel network over the next power of four, walked until the image is
    below n; the walk ends since j itself lies on the cycle.
    """
    j, n, key = (np.asarray(a).astype(np.uint64) for a in (j, n, key))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = j.copy(), np.arange(len(j))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k = half[todo], mask[todo], key[todo]
            a, b = out[todo] >> h, out[todo] & m
            for r in range(4):
                x = (b + k + np.uint64(r * 0x9E37)) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                a, b = b, a ^ ((x ^ (x >> np.uint64(32))) & m)
            out[todo] = (a << h) | b
            todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _permuted(j: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(j, n, key))


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """Sizes, and a row number that is written down, so it stays as it is from then on."""
    rows = pick(docs, doc_id=id_column, text=text_column, source=source_column)
    return rows.select(
        "doc_id",
        "source",
        count_words(F.col("text"), SPACED_WORD).alias("size"),
        row_key("doc_id", "text").alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    block: int = 256,
    cap: int = 3,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with sizes and targets, block pieces, slots).

    Sources by code point, NULL last, weigh ``weights`` in turn. A piece is the part
    [start, stop) of a document's words that lies in block ``number`` of its source; a slot
    is a place (shard, slot) in the output that takes one block. ``mixed`` joins the two.
    """
    spark = docs.sparkSession
    sized = materialize(_sized(docs, id_column, text_column, source_column), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in totals]
    total = sum(sizes)
    targets = targets_of(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    words = [block_of(t, block) for t in targets]
    sources = spark.createDataFrame(
        [(i, r["source"], r["size"], float(t)) for i, (r, t) in enumerate(zip(totals, targets, strict=True))],
        "nr int, source string, source_size long, target double",
    )
    listed = sized.join(F.broadcast(sources), sized["source"].eqNullSafe(sources["source"])).drop(
        sources["source"]
    )
    # A source is packed in units by a hash of the document, so a large one is many tasks' work.
    unit_words = max(1 << 20, total // MAX_UNITS + 1)
    n_units = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(unit_words)))
    listed = listed.withColumn("unit", F.pmod(F.xxhash64("key"), n_units).cast("long"))
    order = Window.partitionBy("nr", "unit").orderBy(
        F.col("doc_id").asc_nulls_first(), "key", "row"
    )
    packed = (
        listed.withColumn("stop_word", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("first_word", F.col("stop_word") - F.col("size"))
        .drop("stop_word")
    )
    # At most MAX_UNITS + sources rows.
    units = listed.groupBy("nr", "unit").agg(F.sum("size").alias("words")).collect()
    bases, blocks = [], [0] * len(sizes)
    for r in sorted(units, key=lambda r: (r["nr"], r["unit"])):
        bases.append((r["nr"], r["unit"], blocks[r["nr"]], words[r["nr"]]))
        blocks[r["nr"]] += -(-r["words"] // words[r["nr"]])
    base = spark.createDataFrame(bases, "nr int, unit long, base long, block long")
    at = F.sequence(F.expr("first_word div block"), F.expr("(first_word + size - 1) div block"))
    pieces = (
        packed.where("size > 0")
        .join(F.broadcast(base), ["nr", "unit"])
        .withColumn("at", F.explode(at))
        .select(
            "row",
            "doc_id",
            "nr",
            (F.col("base") + F.col("at")).alias("number"),
            F.greatest(F.lit(0), F.col("at") * F.col("block") - F.col("first_word")).alias("start"),
            F.least(F.col("size"), (F.col("at") + 1) * F.col("block") - F.col("first_word")).alias("stop"),
        )
    )
    slots = _slots(spark, sizes, targets, blocks, cap, seed)
    return listed.drop("unit", "key"), pieces, slots


def _slots(spark, sizes, targets, blocks, cap, seed) -> DataFrame:
    """Rows (shard, slot, nr, number): which block of which source goes where."""
    # A tail block is shorter than the others, so quotas follow the mean block of the source.
    quotas = [
        min(cap * b, round(t * b / s)) if s else 0
        for s, t, b in zip(sizes, targets, blocks, strict=True)
    ]
    most = min(MAX_SHARDS, MAX_COUNTS // max(1, len(quotas)))
    shards = int(min(most, max(16, sum(quotas) // 4096)))
    counts = draw_shards(quotas, shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    places = np.cumsum(counts, axis=1) - counts
    rows = [
        (int(k), int(s), int(places[k, s]), int(first[k, s]), int(counts[k, s]), int(blocks[s]))
        for k, s in zip(*np.nonzero(counts), strict=True)
    ]
    draws = spark.createDataFrame(
        rows, "shard int, nr int, place long, first long, taken long, n_blocks long"
    )
    tasks = max(1, min(len(rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    slots = draws.repartition(tasks, "shard", "nr").withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1))
    )
    j = F.col("first") + F.col("i")
    turn = F.floor(j / F.col("n_blocks"))
    key = F.xxhash64(F.lit(seed), F.col("nr"), turn)
    image = F.pandas_udf(_permuted, "bigint")
    return slots.select(
        "shard",
        (F.col("place") + F.col("i")).alias("slot"),
        "nr",
        image(j % F.col("n_blocks"), F.col("n_blocks"), key).alias("number"),
    )


def mixed(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Every piece of every slot: the output in rows (shard, slot, doc_id, start, stop).

    Both sides grow with the corpus; the hint keeps Spark from broadcasting the slots, whose
    number it cannot know from the few draws they are made of.
    """
    return slots.hint("merge").join(pieces, ["nr", "number"])


def taken_words(listed: DataFrame, pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Per document the words the mix takes, repeats counted."""
    taken = mixed(pieces, slots).groupBy("row").agg(F.sum(F.col("stop") - F.col("start")).alias("taken"))
    return listed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


@query("op2_source_mix")
def op2_source_mix(load) -> DataFrame:
    """All documents, weights 5, 2, 1 in turn."""
    return taken_words(*mix(load("documents")))
