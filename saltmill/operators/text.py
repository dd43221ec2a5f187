"""Line, word and token operators over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A run of ASCII letters with no letter, digit or underscore of any script beside it.
REAL_WORD = r"(?<![\p{L}\p{N}_])[A-Za-z]++(?![\p{L}\p{N}_])"
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
# Least number of index buckets, documents per further bucket, and most buckets (folders).
TOKEN_BUCKETS = 16
DOCS_PER_BUCKET = 500_000
MOST_BUCKETS = 4096
# Stands before a stop word in an index; no token begins with it.
STOP_MARK = "!"


def lines(df: DataFrame, text: str) -> DataFrame:
    """One row per line of a text column, as ``value``."""
    return df.select(F.explode(F.split(text, "\n")).alias("value"))


def split_words(df: DataFrame, value: str = "value") -> DataFrame:
    """Split on single blanks; empty strings between blanks are kept."""
    return df.select(F.explode(F.split(value, " ")).alias("word"))


def extract_words(df: DataFrame, value: str = "value") -> DataFrame:
    """Runs of ASCII letters that stand between word borders."""
    return df.select(
        F.explode(F.regexp_extract_all(value, F.lit(REAL_WORD), F.lit(0))).alias("word")
    )


def word_count(words: DataFrame) -> DataFrame:
    """(word, count); counts are long, since a common word can pass the int range."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def tokens(df: DataFrame, doc_id: str, texts: list[str], stop_words: list[str] | None = None) -> DataFrame:
    """Distinct (token, doc_id); lower-case runs of letters and digits, no stemming."""
    whole = F.lower(F.concat_ws(" ", *texts))
    per_doc = F.array_distinct(F.split(whole, TOKEN_BREAK))
    out = df.select(F.explode(per_doc).alias("token"), F.col(doc_id).alias("doc_id")).where("token <> ''")
    return out.where(~F.col("token").isin([w.lower() for w in stop_words])) if stop_words else out


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def build_token_index(
    df: DataFrame,
    doc_id: str,
    texts: list[str],
    path: str,
    stop_words: list[str] | None = None,
    buckets: int | None = None,
) -> None:
    """Write the (token, doc_id) table, split by token bucket and sorted by token.

    The number of buckets follows the number of documents, unless given, and is kept in
    the index as the partition column ``token_buckets``, where the search finds it.
    The rebalance splits a bucket by size, so a token found in a third of the
    documents does not end in one task or file. One document's tokens are made
    distinct inside its row, so the build has a single shuffle. A stop word is kept as one
    row with a mark before it, which tells the search to pass over it.
    """
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(TOKEN_BUCKETS, df.count() // DOCS_PER_BUCKET))
    found = tokens(df, doc_id, texts, stop_words)
    if stop_words:
        words = [(STOP_MARK + w,) for w in sorted({w.lower() for w in stop_words})]
        marks = df.sparkSession.createDataFrame(words, "token string")
        found = found.unionByName(marks.withColumn("doc_id", F.lit(None).cast(found.schema["doc_id"].dataType)))
    index = found.withColumn("token_buckets", F.lit(buckets)).withColumn(
        "token_bucket", _bucket(F.ltrim(F.col("token"), F.lit(STOP_MARK)), buckets)
    )
    (
        index.hint("rebalance", "token_bucket")
        .sortWithinPartitions("token_bucket", "token", "doc_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("token_buckets", "token_bucket")
        .parquet(path)
    )


def search_tokens(index: DataFrame, query: list[str]) -> DataFrame:
    """Documents that hold every token of the query; reads the buckets of those tokens only.

    The query is cut into tokens as the texts were, and stop words of the index are passed
    over. A query without another token is refused, and so is an index that does not state its
    number of buckets.
    """
    if "token_buckets" not in index.columns:
        raise ValueError("not a token index: no column token_buckets")
    asked = index.sparkSession.createDataFrame([(" ".join(query),)], "query string")
    asked = tokens(asked.withColumn("doc_id", F.lit(0)), "doc_id", ["query"])
    wanted = sorted(r["token"] for r in asked.collect())
    if not wanted:
        raise ValueError("the query holds no token")
    # Partition values: the first row of one file tells.
    first = index.select("token_buckets").first()
    buckets = first[0] if first else 1
    numbers = [r[0] for r in asked.select(_bucket(F.col("token"), buckets)).distinct().collect()]
    marks = {STOP_MARK + w: w for w in wanted}
    hits = index.where(F.col("token_bucket").isin(numbers) & F.col("token").isin([*wanted, *marks]))
    # At most one row per token of the query.
    stops = {marks[r[0]] for r in hits.where(F.col("token").isin(list(marks))).select("token").distinct().collect()}
    wanted, hits = [w for w in wanted if w not in stops], hits.where(~F.col("token").isin(list(marks)))
    if not wanted:
        raise ValueError("the query holds nothing but stop words")
    found = [F.bool_or(F.col("token") == w).alias(f"_{i}") for i, w in enumerate(wanted)]
    held = hits.groupBy("doc_id").agg(*found)
    for i in range(len(wanted)):
        held = held.where(F.col(f"_{i}"))
    return held.select("doc_id")
