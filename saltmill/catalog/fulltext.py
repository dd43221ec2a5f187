"""Searches in a positional token index that is kept up by batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import fulltext
from .registry import Tables, query

_STOP_WORDS = ["the", "of", "and", "to", "in"]

# Tokens of a text column with their positions, as the index has them; {docs} has doc_id and body.
_SQL_TOKENS = """
    cut AS (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(body), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM ({docs})),
    raw AS (SELECT doc_id, unnest(w) AS raw, unnest(range(1, len(w) + 1)) AS position FROM cut),
    ends AS (
      SELECT doc_id, position, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
        '^(.+ss)es$', '\\1'), '^(.+[^aeiou])ies$', '\\1y'), '^(.{{2,}}[^siu])s$', '\\1'), '^(.{{3,}})ly$', '\\1'),
        '^(.*[aeiouy][^aeiouy]+)(ing|ed)$', '\\1') AS t
      FROM raw WHERE raw NOT IN ('the', 'of', 'and', 'to', 'in')),
    tokens AS (
      SELECT doc_id, position, CASE WHEN t[-1] = t[-2] AND t[-1] IN ('b', 'd', 'f', 'g', 'm', 'n', 'p', 'r', 't')
        THEN t[:-2] ELSE t END AS token FROM ends)"""


def _indexed(t: Tables) -> str:
    """All documents, then the edited text of German ones, then those of one source deleted, and a merge."""
    path = t.scratch("fulltext")
    fulltext.create(t.spark, path, stop_words=_STOP_WORDS)
    docs = t("documents").select("doc_id", "text", "source", "lang")
    fulltext.apply_batch(t.spark, path, 1, docs, "doc_id", ["text"])
    edited = docs.where("lang = 'de'")
    fulltext.apply_batch(t.spark, path, 2, edited, "doc_id", ["source", "text"])
    gone = docs.where("source = 'src0'").withColumn("gone", F.lit(True))
    fulltext.apply_batch(t.spark, path, 3, gone, "doc_id", ["text"], gone="gone")
    # A batch that comes again changes nothing.
    fulltext.apply_batch(t.spark, path, 2, docs, "doc_id", ["lang"])
    return path


_SQL_STATE = """SELECT doc_id, CASE WHEN lang = 'de' THEN source || ' ' || text ELSE text END AS body
      FROM documents WHERE source <> 'src0'"""


@query(
    "token_index_batches",
    f"""WITH {_SQL_TOKENS.format(docs=_SQL_STATE)}
    SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS n, CAST(sum(position) AS BIGINT) AS places
    FROM tokens GROUP BY token""",
)
def token_index_batches(t: Tables) -> DataFrame:
    """The live postings after adds, edits, deletes and a merge, per token."""
    path = _indexed(t)
    fulltext.merge(t.spark, path, at_most=1)
    index = fulltext.Index(t.spark, path)
    live = index.live(index.postings())
    places = F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, p: a + p)
    return live.groupBy("token").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.size("positions")).alias("n"), F.sum(places).alias("places")
    )


@query(
    "phrase_search",
    f"""WITH {_SQL_TOKENS.format(docs=_SQL_STATE)}
    SELECT a.doc_id, count(*) AS n FROM tokens a JOIN tokens b
      ON a.doc_id = b.doc_id AND b.position = a.position + 2 AND a.token = 'attion' AND b.token = 'thanedble'
    GROUP BY a.doc_id""",
)
def phrase_search(t: Tables) -> DataFrame:
    """A phrase with a stop word inside and one at its end, over three segments."""
    return fulltext.phrase_search(t.spark, _indexed(t), "Attion to thanedble, the")
