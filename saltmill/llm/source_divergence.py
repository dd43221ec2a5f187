"""Source divergence audit: which terms tell the sources of a language apart.

Terms of a language are found by iceberg prefix refinement. Each document is written once as
its distinct terms with their counts, documents of a language and source side by side (a large
source is split over several files), so that tasks combine their counts well. Level by level, every document gives the distinct byte
prefixes of its terms, the number of documents per (language, prefix) is added up, and prefixes
in fewer than ``min_docs`` documents are discarded; the next level extends only those that are
left. Terms carry an end mark, so a prefix with the mark is a complete term and is not extended.
Levels are 3, 9, 27, ... bytes wide: a term of any length takes a logarithmic number of them.
Complete terms that reach the threshold are kept, and only they are counted by source afterwards.

What is left of a level reaches the tasks as a bitmap of BITMAP_BITS bits, a fixed size: a
prefix that another one's bit lets through costs work only, since its documents are counted
exactly and kept terms are joined by their bytes.

With p = 1 + floor(10^9 (count + 2) / (N + 2 V)) for a kept term (V kept terms, N their
occurrences) and f(p, q) = floor((p - q)^2 / (p + q)), a source is compared with every other
source of its language over all kept terms, and its terms with the whole language. Terms that a
source lacks all have the same p, so they are never written out: sums over them come from the
number of terms and from the histogram of p of each source, and only terms that two sources
share meet in a join. All arithmetic is in whole numbers, products by 10^9 in decimals.

NULL text, language and source are empty strings. A row is a document, repeated rows count
each. A source without terms, and a language without kept terms (all values 0), keep their
pairs; a source that is alone has none. Without documents there are no rows. Other columns are
not read. Ties of a value are ranked by the bytes of the item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import small_join
from ..session import materialize
from .common import pick
from .registry import query

MIN_DOCS = 10
TOP_TERMS = 10
# Bits of a level's bitmap, as a power of two: 8 MB.
BITMAP_BITS = 26
# Bytes of the first level, and by how much the next one is wider.
FIRST_WIDTH = 3
WIDEN = 3
# One word of Spark's bitmaps.
WORD_BITS = 15
# Partial counts of a task are passed on when there are this many of them.
FLUSH = 500_000
# Ends every term; no byte of a term.
END = b" "

# Letters and bytes of other scripts stay, A to Z in lower case; all else separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def term_table(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """One row per document: lang, source, its distinct terms, each with END, and their counts."""
    rows = pick(docs, lang=lang_column, source=source_column, text=text_column).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(terms_of(text)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([b"".join(t + END for t in c) for c in found], pa.binary()),
                    pa.array([np.fromiter(c.values(), "<i4", len(c)).tobytes() for c in found], pa.binary()),
                ],
                names=["lang", "source", "terms", "counts"],
            )

    table = rows.mapInArrow(run, "lang string, source string, terms binary, counts binary")
    return materialize(table.hint("rebalance", "lang", "source"), "terms")


def place_of(lang: str, prefix: bytes) -> int:
    """Bit of a prefix in a bitmap."""
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + prefix) >> (64 - BITMAP_BITS)


def bitmap(prefixes: DataFrame) -> bytes:
    """Bits of the rows (lang, prefix); its size on the driver is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = map(place_of, batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64())], names=["place"])

    places = prefixes.select("lang", "prefix").mapInArrow(run, "place bigint").distinct()
    words = places.groupBy(F.shiftright("place", WORD_BITS).alias("word")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << WORD_BITS) - 1)).alias("bits")
    )
    size = 1 << (WORD_BITS - 3)
    bits = bytearray(1 << (BITMAP_BITS - 3))
    for word in words.collect():
        bits[word["word"] * size : (word["word"] + 1) * size] = word["bits"]
    return bytes(bits)


class Alive(dict):
    """Remembers, for one task, which prefixes of a language a bitmap lets through."""

    def __init__(self, bits: bytes, lang: str):
        self.bits, self.lang = bits, lang

    def __missing__(self, prefix: bytes) -> bool:
        place = place_of(self.lang, prefix)
        found = self[prefix] = bool(self.bits[place >> 3] >> (place & 7) & 1)
        return found


class Levels(dict):
    """``Alive`` by language."""

    def __init__(self, bits: bytes):
        self.bits = bits

    def __missing__(self, lang: str) -> Alive:
        found = self[lang] = Alive(self.bits, lang)
        return found


def _added(
    table: DataFrame, groups: list[str], per_batch: Callable, bits: bytes | None, before: int | None
) -> DataFrame:
    """Rows (groups, prefix, n) of all batches, added up by task and then by Spark.

    ``per_batch(batch, group number of each row)`` gives group numbers, prefixes and counts; the
    groups are the first columns of the table.
    ``bits``: leave out rows whose first ``before`` bytes (None: all) the bitmap does not hold.
    """
    shared = table.sparkSession.sparkContext.broadcast(bits)
    names = [*groups, "prefix"]
    schema = ", ".join(f"{g} string" for g in groups) + ", prefix binary, n bigint"

    def combined(held: list[pa.RecordBatch], known: list[tuple], alive: Levels | None) -> pa.RecordBatch:
        added = pa.Table.from_batches(held).group_by(["group", "prefix"], use_threads=False).aggregate([("n", "sum")])
        if alive is not None:
            rows = zip(added["group"].to_pylist(), added["prefix"].to_pylist(), strict=True)
            lets = [alive[group[0]] for group in known]
            added = added.filter(pa.array([lets[group][prefix[:before]] for group, prefix in rows], pa.bool_()))
        number, prefix, n = (added[c].combine_chunks() for c in ("group", "prefix", "n_sum"))
        columns = [pa.array([g[i] for g in known], pa.string()).take(number) for i in range(len(groups))]
        return pa.RecordBatch.from_arrays([*columns, prefix, n], names=[*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, {}
        alive = None if shared.value is None else Levels(shared.value)
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(len(groups))], strict=True)
            group = np.array([number.setdefault(row, len(number)) for row in rows], np.int64)
            held.append(pa.RecordBatch.from_arrays(per_batch(batch, group), names=["group", "prefix", "n"]))
            size += held[-1].num_rows
            if size > FLUSH:
                yield combined(held, list(number), alive)
                held, size = [], 0
        if held:
            yield combined(held, list(number), alive)

    return table.mapInArrow(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def _flat(blobs: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All terms of a batch with END, the number of their row, and their lengths."""
    texts = blobs.to_pylist()
    data = b"".join(texts)
    ends = (np.flatnonzero(np.frombuffer(data, np.uint8) == END[0]) + 1).astype(np.int32)
    offsets = np.concatenate([np.zeros(1, np.int32), ends])
    terms = pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    )
    row = np.searchsorted(np.cumsum([len(t) for t in texts]), offsets[:-1], side="right")
    return terms, row, np.diff(offsets)


def prefix_counts(terms: DataFrame, width: int, before: int, bits: bytes | None) -> DataFrame:
    """lang, prefix and n, the number of documents, at one level.

    Terms of more than ``before`` bytes with their END, the width of the last level, take part
    if the bitmap of that level lets their prefix through (None: all do).
    """

    def per_batch(batch: pa.RecordBatch, group: np.ndarray) -> list[pa.Array]:
        found, row, size = _flat(batch.column(1))
        longer = size > before
        prefix = pc.binary_slice(found.filter(pa.array(longer)), 0, width).dictionary_encode()
        of, n = prefix.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(prefix.dictionary))
        # A document counts once per prefix.
        once = np.unique(row[longer] * n + of)
        key, docs = np.unique(group[once // n] * n + once % n, return_counts=True)
        return [pa.array(key // n), prefix.dictionary.take(pa.array(key % n)), pa.array(docs, pa.int64())]

    return _added(terms.select("lang", "terms"), ["lang"], per_batch, bits, before)


def kept_terms(terms: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang and term, as prefix with its end mark, of all terms in ``min_docs`` documents."""
    width, before, bits, ended = FIRST_WIDTH, 0, None, []
    while True:
        level = prefix_counts(terms, width, before, bits).where(F.col("n") >= min_docs)
        level = materialize(level.select("lang", "prefix"), "prefixes")
        is_term = F.expr("substring(prefix, -1, 1) = X'20'")
        ended.append(level.where(is_term))
        longer = level.where(~is_term)
        if longer.isEmpty():
            break
        bits, before, width = bitmap(longer), width, WIDEN * width
    kept = ended[0]
    for more in ended[1:]:
        kept = kept.unionAll(more)
    return kept


def source_counts(terms: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, n: occurrences of kept terms, where there are any."""

    def per_batch(batch: pa.RecordBatch, group: np.ndarray) -> list[pa.Array]:
        found, row, _ = _flat(batch.column(2))
        counts = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4")
        return [pa.array(group[row]), found, pa.array(counts, pa.int64())]

    found = _added(terms, ["lang", "source"], per_batch, bitmap(kept), None)
    # Exact: the bitmap may have let other terms through.
    found = found.join(kept, ["lang", "prefix"])
    term = F.expr("substring(prefix, 1, octet_length(prefix) - 1)")
    return found.select("lang", "source", term.alias("term"), "n")


def rate(n: Column, total: Column) -> Column:
    """p of a count; ``total`` is N + 2 V and not 0."""
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, total.cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """f of two rates: they are at most 10^9 + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups_of(terms: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per lang and source: found (terms), vocabulary V, total N + 2 V, none (p of a lacking term)."""
    each = terms.select("lang", "source", F.lit(0).cast("long").alias("n"), F.lit(0).alias("one"))
    each = each.unionAll(counts.select("lang", "source", "n", F.lit(1)))
    each = each.groupBy("lang", "source").agg(F.sum("n").alias("in_all"), F.sum("one").alias("found"))
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    groups = small_join(each, size, "lang", "left").fillna(0, ["vocabulary"])
    total = F.col("in_all") + 2 * F.col("vocabulary")
    none = F.when(total > 0, rate(F.lit(0).cast("long"), total)).otherwise(1)
    return materialize(groups.select("lang", "source", "found", "vocabulary", total.alias("total"), none.alias("none")), "groups")


def pair_values(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the lang) and value, summed over all kept terms.

    ``rated`` has lang, source, term, p and none. With p0 for the p of a lacking term, a pair
    sums f(p, q) over shared terms, f(p, q0) and f(p0, q) over those of one source, f(p0, q0)
    over the rest. Both one-sided sums run over all terms of a source here, and shared terms
    are corrected for it.
    """
    other = groups.select(
        "lang", F.col("source").alias("item"), F.col("found").alias("found_too"), F.col("none").alias("none_too")
    )
    differ = F.col("source") != F.col("item")
    rest = F.col("vocabulary") - F.col("found") - F.col("found_too")
    lacking = groups.join(other, "lang").where(differ)
    lacking = lacking.select("lang", "source", "item", (rest * gap(F.col("none"), F.col("none_too"))).alias("value"))

    shape = rated.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    one_sided = shape.join(other, "lang").where(differ)
    one_sided = one_sided.select("lang", "source", "item", (F.col("n") * gap(F.col("p"), F.col("none_too"))).alias("value"))

    right = rated.select(
        "lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("none").alias("none_too")
    )
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "none", "none_too"))
    shared = rated.join(right, ["lang", "term"]).where(F.col("source") < F.col("item"))
    shared = shared.select("lang", "source", "item", (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("value"))

    # Combined before both directions of a pair get them.
    both = one_sided.unionAll(shared).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = materialize(both, "pair-sums")
    turned = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    every = lacking.unionAll(both).unionAll(turned)
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(counts: DataFrame, rated: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term that the source uses more than its language) and value."""
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    size = groups.groupBy("lang").agg(
        F.max("vocabulary").alias("vocabulary"), F.sum(F.col("total") - 2 * F.col("vocabulary")).alias("in_all")
    )
    size = materialize(size, "languages")
    whole = small_join(whole, size, "lang").select(
        "lang", "term", rate(F.col("n"), F.col("in_all") + 2 * F.col("vocabulary")).alias("q")
    )
    more = rated.join(whole, ["lang", "term"]).where("p > q")
    return more.select("lang", "source", F.col("term").cast("string").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Pairs of sources with all ranks and the ``top`` terms of every source."""
    terms = term_table(docs)
    kept = materialize(kept_terms(terms, min_docs), "kept-terms")
    counts = materialize(source_counts(terms, kept), "source-counts")
    groups = groups_of(terms, counts, kept)
    rated = small_join(counts, groups.select("lang", "source", "total", "none"), ["lang", "source"])
    rated = rated.withColumn("p", rate(F.col("n"), F.col("total"))).select("lang", "source", "term", "p", "none")
    rated = materialize(rated, "rates")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(rated, groups).withColumn("rank", place)
    terms_of_source = term_values(counts, rated, groups).withColumn("rank", place).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns)
        .unionAll(terms_of_source.withColumn("part", F.lit("term")).select(columns))
    )


_SQL_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@query(
    "op13_source_divergence",
    rf"""
    WITH texts AS (
      SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '{_SQL_TERM}')) AS term FROM texts),
    kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    counts AS (
      SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM texts),
    dense AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
      FROM groups g JOIN kept k ON g.lang = k.lang
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    rates AS (
      SELECT lang, source, term, n,
        1 + (1000000000 * CAST(n + 2 AS HUGEINT)) // (CAST(total AS HUGEINT) + 2 * v) AS p
      FROM dense JOIN sizes USING (lang)),
    whole AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM counts GROUP BY lang, term),
    lang_rates AS (
      SELECT lang, term, 1 + (1000000000 * CAST(n + 2 AS HUGEINT)) // (CAST(total AS HUGEINT) + 2 * v) AS q
      FROM whole JOIN sizes USING (lang)),
    sums AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (
      SELECT r.lang, r.source, 'term' AS part, r.term AS item, (p - q) * (p - q) // (p + q) AS value
      FROM rates r JOIN lang_rates l ON r.lang = l.lang AND r.term = l.term WHERE r.n > 0 AND p > q),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 10""",
)
def op13_source_divergence(load) -> DataFrame:
    """All documents: pairs of sources per language, and the ten terms that mark each source."""
    return audit(load("documents"))
