"""A positional token index that takes changes in batches: segments, delete marks, merges.

Layout below one folder: ``settings`` (number of buckets, stop words), ``segments/<name>`` (token,
doc_id, version, positions; split by token bucket), ``marks/<name>`` (doc_id, version, gone: which
batch a document was last changed in) and ``manifest/<number>``, which lists the segments and marks
in use. A change writes its own segment and marks and then a manifest, so its work follows the size
of the change; what it wrote counts only with the manifest. A posting is live if no mark of its
document is newer. Merging writes the live postings of some segments into one.

One writer at a time; readers go on with the manifest they found. A batch that runs again after
a stop finds its number in the manifest, or overwrites what it left. NULL ids are left out, NULL
texts have no tokens. A batch must hold a document once.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.paths import children
from .text import TOKEN_BREAK

POSTING = "token STRING, doc_id {id}, version BIGINT, positions ARRAY<INT>"
MARK = "doc_id {id}, version BIGINT, gone BOOLEAN"
BUCKETS = 64
# A merge is due above so many segments.
MOST_SEGMENTS = 8
# Marks that Spark may broadcast, by its own bound on bytes.
MANY_MARKS = 200_000

# Suffix rules in order: each is a pattern and what stays of the token.
STEM_RULES = (
    (r"^(.+ss)es$", 1),
    (r"^(.+[^aeiou])ies$", "y"),
    (r"^(.{2,}[^siu])s$", 1),
    (r"^(.{3,})ly$", 1),
    (r"^(.*[aeiouy][^aeiouy]+)(ing|ed)$", 1),
)


# How a token ends that a rule may change, with the first rule to try (the last one has no number); others
# are left as they are.
STEM_ENDS = ((("s",), 0), (("ly", "ing", "ed"), 3), (tuple(2 * c for c in "bdfgmnprt"), len(STEM_RULES)))


def stem(token: Column, first: int = 0) -> Column:
    """The token without English endings: plurals, -ly, -ing, -ed, then a doubled last consonant."""
    for pattern, keep in STEM_RULES[first:]:
        token = F.regexp_replace(token, pattern, "$1" + (keep if isinstance(keep, str) else ""))
    return F.regexp_replace(token, r"([bdfgmnprt])\1$", "$1")


def _stem_some(token: Column) -> Column:
    """``stem``, with its rules tried only on tokens that end as one of them asks."""
    (plural, _), (ends, rule), (doubled, last) = STEM_ENDS
    two = F.substring(token, -2, 2)
    return (
        F.when(F.endswith(token, F.lit(plural[0])), stem(token))
        .when(reduce(Column.__or__, [F.endswith(token, F.lit(end)) for end in ends]), stem(token, rule))
        .when(two.isin(*doubled), stem(token, last))
        .otherwise(token)
    )


def _words(text: Column) -> Column:
    """Lower-case tokens of a text in their order."""
    found = F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def positions(text: Column, stemmed: bool) -> Column:
    """Array of (token, position from 1) of a text; stop words are still in it."""
    return F.transform(
        _words(text),
        lambda t, i: F.struct((stem(t) if stemmed else t).alias("token"), t.alias("raw"), (i + 1).alias("position")),
    )


def _postings(texts: DataFrame, index: Index, twice: bool) -> DataFrame:
    """token, doc_id, version and positions of texts, each document by itself.

    The places of a document are sorted by token and cut where the token changes, so no row per place
    is shuffled or sorted. If ``twice``, rows of one document are put together first.
    """
    places = F.transform(_words(F.col("text")), lambda t, i: F.struct(t.alias("token"), (i + 1).alias("position")))
    if index.stop_words:
        places = F.filter(places, lambda p: ~p["token"].isin(*index.stop_words))
    if index.stemmed:
        places = F.transform(
            places, lambda p: F.struct(_stem_some(p["token"]).alias("token"), p["position"].alias("position"))
        )
    rows = texts.select("doc_id", "version", places.alias("places"))
    if twice:
        rows = rows.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("places")).alias("places"))
    rows = rows.where(F.size("places") > 0).withColumn("places", F.sort_array("places"))
    # Not ``places.token``, which would be taken out of the whole array again for every element.
    parts = F.transform("places", lambda p: p["token"]), F.transform("places", lambda p: p["position"])
    rows = rows.select("doc_id", "version", parts[0].alias("tokens"), parts[1].alias("all"))
    tokens = F.col("tokens")
    differ = lambda t, i: F.when((i == 0) | (t != F.get(tokens, i - 1)), i)
    rows = rows.withColumn("at", F.array_compact(F.transform(tokens, differ)))

    def run(first, k):
        after = F.coalesce(F.get("at", k + 1), F.size("all"))
        return F.struct(F.get(tokens, first).alias("token"), F.slice("all", first + 1, after - first).alias("positions"))

    return rows.select("doc_id", "version", F.inline(F.transform("at", run)))


def create(spark: SparkSession, path: str, id_type: str = "bigint", stop_words: list[str] = (), stemmed: bool = True, buckets: int = BUCKETS) -> None:
    """An empty index; its settings hold for all batches and searches."""
    words = sorted({w.lower() for w in stop_words})
    row = [(id_type, words, stemmed, buckets)]
    schema = "id_type STRING, stop_words ARRAY<STRING>, stemmed BOOLEAN, buckets INT"
    spark.createDataFrame(row, schema).write.mode("overwrite").parquet(f"{path}/settings")
    _publish(spark, path, 0, [])


def _publish(spark: SparkSession, path: str, number: int, entries: list[tuple]) -> None:
    """Entries: (kind, folder, highest version in it)."""
    rows = spark.createDataFrame(entries, "kind STRING, folder STRING, version BIGINT")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{number}")


class Index:
    """What the newest complete manifest of a folder lists."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        settings = spark.read.parquet(f"{path}/settings").first()
        self.id_type, self.stop_words, self.stemmed, self.buckets = settings
        done = [int(n) for n in children(spark, f"{path}/manifest") if "_SUCCESS" in children(spark, f"{path}/manifest/{n}")]
        self.number = max(done)
        listed = spark.read.parquet(f"{path}/manifest/{self.number}").collect()
        self.segments = sorted((r["folder"] for r in listed if r["kind"] == "segment"), key=_order)
        self.marks = sorted((r["folder"] for r in listed if r["kind"] == "marks"), key=_order)
        self.version = max((r["version"] for r in listed), default=0)

    def entries(self, segments: list[str], marks: list[str], version: int) -> list[tuple]:
        return [("segment", s, version) for s in segments] + [("marks", m, version) for m in marks]

    def postings(self, names: list[str] | None = None) -> DataFrame:
        names = self.segments if names is None else names
        schema = POSTING.format(id=self.id_type) + ", token_bucket INT"
        if not names:
            return self.spark.createDataFrame([], schema)
        read = [
            self.spark.read.schema(schema).option("basePath", f"{self.path}/segments/{n}").parquet(f"{self.path}/segments/{n}")
            for n in names
        ]
        out = read[0]
        for more in read[1:]:
            out = out.unionByName(more)
        return out

    def _marks(self) -> DataFrame:
        schema = MARK.format(id=self.id_type)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/marks/{m}" for m in self.marks])

    def last_marks(self, of: DataFrame | None = None) -> DataFrame:
        """doc_id, newest version, whether the document is gone; only of the documents in ``of``."""
        if not self.marks:
            return self.spark.createDataFrame([], MARK.format(id=self.id_type).replace("version", "newest"))
        read = self._marks()
        if of is not None:
            read = read.join(of.select("doc_id").distinct(), "doc_id", "left_semi")
        # A long that orders by version first and holds the flag.
        newest = F.max(F.col("version") * 2 + F.col("gone").cast("int"))
        last = read.groupBy("doc_id").agg(newest.alias("v"))
        return last.select("doc_id", F.shiftright("v", 1).alias("newest"), (F.col("v") % 2 == 1).alias("gone"))

    def live(self, postings: DataFrame, few: bool = False) -> DataFrame:
        """Postings of the newest version of each document; ``few``: look only at their marks.

        Joins on the id: documents are about equally large there, and Spark broadcasts the hits of a
        search by their measured size. Many marks are looked up by hash, so postings are not sorted for them.
        """
        marks = self.last_marks(postings if few else None)
        if not few and self.marks and self._marks().count() > MANY_MARKS:
            marks = marks.hint("shuffle_hash")
        kept = postings.join(marks, "doc_id")
        return kept.where((F.col("version") == F.col("newest")) & ~F.col("gone")).drop("newest", "gone")


def _order(folder: str) -> tuple:
    return tuple(int(n) for n in re.findall(r"\d+", folder))


def _write_segment(postings: DataFrame, path: str) -> None:
    """Rebalanced, so that a bucket with a token of very many documents becomes several files."""
    (
        postings.hint("rebalance", "token_bucket")
        .sortWithinPartitions("token_bucket", "token", "doc_id")
        .write.mode("overwrite")
        .partitionBy("token_bucket")
        .parquet(path)
    )


def apply_batch(spark: SparkSession, path: str, batch: int, changes: DataFrame, doc_id: str, texts: list[str], gone: str | None = None) -> bool:
    """Add, replace and delete documents; ``batch`` numbers rise. False if it was applied before.

    ``gone`` names a flag of rows to delete (texts of theirs are not read).
    """
    index = Index(spark, path)
    if batch <= index.version:
        return False
    deleted = F.coalesce(F.col(f"`{gone}`"), F.lit(False)) if gone else F.lit(False)
    rows = changes.select(
        F.col(f"`{doc_id}`").cast(index.id_type).alias("doc_id"),
        F.lit(batch).cast("bigint").alias("version"),
        deleted.alias("gone"),
        F.concat_ws(" ", *[F.col(f"`{t}`").cast("string") for t in texts]).alias("text"),
    ).where("doc_id is not null")
    rows.select("doc_id", "version", "gone").write.mode("overwrite").parquet(f"{path}/marks/batch-{batch}")
    marks = spark.read.schema(MARK.format(id=index.id_type)).parquet(f"{path}/marks/batch-{batch}")
    twice = marks.where("not gone").groupBy("doc_id").count().where("count > 1")
    found = _postings(rows.where("not gone"), index, twice=not twice.isEmpty())
    bucket = F.pmod(F.xxhash64("token"), F.lit(index.buckets)).cast("int")
    _write_segment(found.withColumn("token_bucket", bucket), f"{path}/segments/batch-{batch}")
    entries = index.entries([*index.segments, f"batch-{batch}"], [*index.marks, f"batch-{batch}"], batch)
    _publish(spark, path, index.number + 1, entries)
    return True


def merge(spark: SparkSession, path: str, at_most: int = MOST_SEGMENTS) -> bool:
    """If there are more than ``at_most`` segments, merge the newest ones until half as many are left.

    The oldest segments are the largest and stay as they are, but for every other merge or so; dead
    postings leave with the merge of their segment. Marks are combined to one per document.
    """
    index = Index(spark, path)
    if len(index.segments) <= at_most:
        return False
    keep = at_most // 2
    # Oldest first; with nothing to keep, all become one.
    old, new = index.segments[: max(0, keep - 1)], index.segments[max(0, keep - 1) :]
    name = f"merge-{index.version}-{index.number + 1}"
    _write_segment(index.live(index.postings(new)), f"{path}/segments/{name}")
    marks = index.last_marks().select("doc_id", F.col("newest").alias("version"), "gone")
    marks.write.mode("overwrite").parquet(f"{path}/marks/{name}")
    _publish(spark, path, index.number + 1, index.entries([*old, name], [name], index.version))
    return True


def _asked(index: Index, query: str) -> list[tuple[str, int]]:
    """Tokens of a query with their positions, cut and stemmed as the texts were, without stop words."""
    row = index.spark.createDataFrame([(query,)], "text STRING").select(positions(F.col("text"), index.stemmed).alias("p")).first()
    found = [(p["token"], p["position"]) for p in row["p"] if p["raw"] not in index.stop_words]
    if not found:
        raise ValueError("the query holds nothing but stop words" if row["p"] else "the query holds no token")
    return found


def _hits(index: Index, tokens: list[str]) -> DataFrame:
    """Live postings of some tokens; only their buckets are read."""
    row = index.spark.createDataFrame([(t,) for t in tokens], "token STRING")
    numbers = row.select(F.pmod(F.xxhash64("token"), F.lit(index.buckets)).cast("int")).distinct().collect()
    wanted = F.col("token_bucket").isin([r[0] for r in numbers]) & F.col("token").isin(tokens)
    return index.live(index.postings().where(wanted), few=True)


def search(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Documents that hold every token of the query, in any order; stop words in it do not count."""
    index = Index(spark, path)
    tokens = sorted({t for t, _ in _asked(index, query)})
    held = _hits(index, tokens).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return held.where(F.col("n") == len(tokens)).select("doc_id")


def phrase_search(spark: SparkSession, path: str, query: str) -> DataFrame:
    """doc_id and n, how often the tokens of the query stand one after the other.

    Stop words keep their places: any word may stand there. Every posting is shifted to
    the place where the phrase would start; a start that all tokens agree on is a hit.
    """
    index = Index(spark, path)
    asked = _asked(index, query)
    offsets = F.create_map(
        *[x for t in sorted({t for t, _ in asked}) for x in (F.lit(t), F.array(*[F.lit(p - asked[0][1]) for u, p in asked if u == t]))]
    )
    starts = F.flatten(F.transform(F.try_element_at(offsets, F.col("token")), lambda o: F.transform("positions", lambda p: p - o)))
    each = _hits(index, sorted({t for t, _ in asked})).select("doc_id", F.explode(starts).alias("start"))
    agreed = each.groupBy("doc_id", "start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(asked))
    return agreed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
