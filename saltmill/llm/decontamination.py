"""Benchmark decontamination as a prefix-filtered set join.

Items are cut into windows of ``window`` consecutive words (an item of fewer words is one window).
Corpus words that occur in the benchmark are counted, each window's words are put in order of
rarity, and the rarest one is its prefix: for full containment one prefix word is enough, any
document that holds the window holds it. Documents are joined with the prefixes; a candidate
must leave room for the whole window before and after the word (positional and length bounds)
and is then compared with the window as a whole.

The benchmark is the query set: it is joined in blocks of at most ``block`` windows and
BLOCK_BYTES of words, each broadcast, against all documents; a benchmark of any size is handled,
at one pass over the documents per block. Which items hold a window is looked up after the
join, by the hash of the set of items, so that many items with one passage cost nothing there.

NULL text has no words and no hits. NULL items have no windows. Windows equal in several items
belong to all of them, a NULL item id counts as no id. Documents equal in id and text are
judged as one, and every row of them gets the result; repeated items count as one. Without items nothing is hit. Other columns are not
read. Only built-in functions: no Python in the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import fits
from ..session import materialize
from .common import PLAIN_WORD, count_words, free_names, lower_ascii, pick, words_of
from .registry import query

WINDOW = 10
BLOCK = 100_000
BLOCK_BYTES = 64 << 20


def item_windows(items: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """Distinct windows: the words as a phrase, their number, the items that hold them, and
    ``set``, a name for these items."""
    words = words_of(lower_ascii(F.col("text")), PLAIN_WORD)
    rows = pick(items, item_id=id_column, text=text_column).select("item_id", words.alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1)))
    )
    words = F.slice("w", F.col("i"), F.lit(window))
    rows = rows.select("item_id", F.array_join(words, " ").alias("phrase"), F.size(words).alias("length"))
    windows = rows.groupBy("phrase", "length").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    return windows.withColumn("set", F.xxhash64("items"))


def with_prefix(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Windows with ``prefix``, their rarest word in the corpus, and ``place``, where it stands.

    Words are counted and joined in full lower case, which only adds candidates. Only words of
    the benchmark are counted, so the counts are no larger than its vocabulary.
    """
    each = windows.select(
        "phrase", "length", "set", F.posexplode(F.split(F.lower("phrase"), " ")).alias("place", "word")
    )
    vocabulary = each.select("word").distinct()
    found = docs.select(F.explode(words_of(F.col("text"), PLAIN_WORD)).alias("raw"))
    found = found.select(F.lower("raw").alias("word"))
    small = fits(vocabulary, max_rows=1_000_000, max_bytes=BLOCK_BYTES)
    known = F.broadcast(vocabulary) if small else vocabulary
    counts = found.join(known, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Ties go to the word itself, then to the first place.
    order = Window.partitionBy("phrase").orderBy(F.coalesce("n", F.lit(0)), "word", "place")
    ranked = each.join(counts, "word", "left").withColumn("rank", F.row_number().over(order))
    return ranked.where("rank = 1").select("phrase", "length", "set", F.col("word").alias("prefix"), "place")


def find_windows(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Every occurrence: doc_id, row hash ``th``, first word (from 0), length and items."""
    windows = materialize(item_windows(items, window, item_column, item_text_column), "bench-windows")
    hits = _find(_texts(docs, id_column, text_column), windows, block)
    return hits.join(_item_sets(windows), "set").drop("set")


def _item_sets(windows: DataFrame) -> DataFrame:
    return windows.groupBy("set").agg(F.min("items").alias("items"))


def _find(texts: DataFrame, windows: DataFrame, block: int) -> DataFrame:
    """Every occurrence: doc_id, th, first, length and the name of the set of items."""
    prefixes = materialize(with_prefix(windows, texts), "bench-prefixes")
    size = F.octet_length("phrase") + F.octet_length("prefix") + 64
    total = prefixes.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).first()
    # Blocks are dealt by hash, so they are about equal; half of the bound leaves room.
    n_blocks = max(1, -(-total["n"] // block), -(-2 * (total["size"] or 0) // BLOCK_BYTES))
    number = F.pmod(F.xxhash64("phrase"), F.lit(n_blocks))
    found = [_hits(texts, prefixes.where(number == b)) for b in range(n_blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    texts = pick(docs, doc_id=id_column, text=text_column)
    return texts.withColumn("th", F.xxhash64("text"))


def _hits(texts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Candidates by prefix word, bounded by position and length, compared as phrases.

    All expressions after the explode compile into one stage with it, so the words of a
    document are referred to, not copied per word.
    """
    words = texts.select("doc_id", "th", words_of(F.col("text"), PLAIN_WORD).alias("w"))
    words = words.select("doc_id", "th", "w", F.posexplode("w").alias("at", "raw"))
    words = words.withColumn("prefix", F.lower("raw"))
    start = F.col("at") - F.col("place")
    candidates = words.join(F.broadcast(prefixes), "prefix").where(
        (start >= 0) & (start + F.col("length") <= F.size("w"))
    )
    found = F.array_join(F.slice("w", start + 1, F.col("length")), " ")
    return candidates.where(lower_ascii(found) == F.col("phrase")).select(
        "doc_id", "th", start.alias("first"), "length", "set"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document: words, words hit, and the ids of the items found (sorted texts)."""
    windows = materialize(item_windows(items, window, item_column, item_text_column), "bench-windows")
    texts = _texts(docs, id_column, text_column)
    per_doc = _per_document(_find(texts, windows, BLOCK), _item_sets(windows))
    texts = texts.select("doc_id", "th", count_words(F.col("text"), PLAIN_WORD).alias("n_words"))
    same = texts["doc_id"].eqNullSafe(per_doc["doc_id"]) & (texts["th"] == per_doc["th"])
    return texts.join(per_doc, same, "left").select(
        texts["doc_id"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _per_document(hits: DataFrame, sets: DataFrame) -> DataFrame:
    """Hits of a document are merged: at most one place per word and window length, and each
    set of items once."""
    covered = F.expr("""
        aggregate(places, named_struct('n', 0L, 'to', 0), (a, x) -> named_struct(
          'n', a.n + greatest(x.first + x.length - greatest(x.first, a.to), 0),
          'to', greatest(a.to, x.first + x.length)), a -> a.n)
    """)
    places = hits.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set(F.struct("first", "length"))).alias("places"),
        F.collect_set("set").alias("sets"),
    )
    each = places.select("doc_id", "th", covered.alias("n_hit"), F.explode("sets").alias("set"))
    return each.join(sets, "set").groupBy("doc_id", "th").agg(
        F.first("n_hit").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window occurs."""
    windows = materialize(item_windows(items, window, item_column, item_text_column), "bench-windows")
    hits = _find(_texts(docs, id_column, text_column), windows, BLOCK)
    id_, th = free_names(docs, "_id", "_th")
    hit = hits.select(F.col("doc_id").alias(id_), F.col("th").alias(th)).distinct()
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(id_)) & (
        F.xxhash64(F.col(f"`{text_column}`")) == F.col(th)
    )
    return docs.join(hit.hint("shuffle_hash"), same, "left_anti")


@query(
    "op8_decontamination",
    sql=r"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
b as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
bw as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + 9], ' ') as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
),
sizes as (select distinct n from bw),
dw as (
  select r, n, i, array_to_string(w[i : i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)
),
hits as (select r, i, dw.n, item_id from dw join bw on dw.n = bw.n and dw.g = bw.g),
hit_words as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r
),
hit_items as (
  select r, count(distinct item_id) as n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from hits group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (r) left join hit_items using (r)
""",
)
def op8_decontamination(load) -> DataFrame:
    """Every document against every item; windows of 10 words."""
    found = contamination(load("documents"), load("benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
