"""Aggregates, profiles, samples and text counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.strings import group_concat
from ..operators import numbering, ranking, sampling, stats, text
from ..operators.selection import exact_quantiles
from ..session import materialize
from .registry import Tables, query

MONEY = "decimal(18,2)"


@query("agg_count", "SELECT p_size, count(*) AS count FROM part GROUP BY p_size")
def agg_count(t: Tables) -> DataFrame:
    return t("part").groupBy("p_size").count()


@query(
    "agg_avg",
    "SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_quantity FROM lineitem GROUP BY l_returnflag",
)
def agg_avg(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 6).alias("avg_quantity"))


@query(
    "agg_global",
    "SELECT round(avg(l_quantity), 6) AS a, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem",
)
def agg_global(t: Tables) -> DataFrame:
    return t("lineitem").agg(
        F.round(F.avg("l_quantity"), 6).alias("a"),
        F.min("l_quantity").alias("lo"),
        F.max("l_quantity").alias("hi"),
    )


@query(
    "agg_count_col",
    """SELECT c_mktsegment, count(nullif(c_nationkey, 0)) AS with_nation FROM customer GROUP BY c_mktsegment""",
)
def agg_count_col(t: Tables) -> DataFrame:
    return t("customer").groupBy("c_mktsegment").agg(
        F.count(F.nullif("c_nationkey", F.lit(0))).alias("with_nation")
    )


@query("agg_count_star", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def agg_count_star(t: Tables) -> DataFrame:
    return t("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_sum",
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey""",
)
def agg_sum(t: Tables) -> DataFrame:
    return t("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"))


@query(
    "agg_two_level",
    """WITH s AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1)
    SELECT p_brand, CAST(sum(amount) AS DOUBLE) AS total FROM s JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def agg_two_level(t: Tables) -> DataFrame:
    brands = t("part").select(F.col("p_partkey").alias("film_id"), "p_brand")
    return t.star.film_sales().join(brands, "film_id").groupBy("p_brand").agg(F.sum("amount").alias("total"))


@query(
    "agg_bround",
    """SELECT l_suppkey, CAST(round_even(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))), 2) AS DOUBLE) AS off
    FROM lineitem GROUP BY l_suppkey""",
)
def agg_bround(t: Tables) -> DataFrame:
    off = F.sum((F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)"))
    return t("lineitem").groupBy("l_suppkey").agg(F.bround(off, 2).alias("off"))


@query(
    "agg_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag",
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"))


@query(
    "agg_having",
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
    FROM orders GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000 AND count(*) > 10""",
)
def agg_having(t: Tables) -> DataFrame:
    per = t("orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return per.filter((F.col("total") > 2500000) & (F.col("n") > 10))


@query(
    "agg_coalesce_sum",
    """SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
    FROM orders WHERE o_totalprice < 0""",
)
def agg_coalesce_sum(t: Tables) -> DataFrame:
    below = t("orders").where("o_totalprice < 0")
    return below.agg(F.coalesce(F.sum(F.col("o_totalprice").cast(MONEY)), F.lit(0)).alias("total"))


@query(
    "rollup_sum",
    """SELECT nation, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total,
      CAST(grouping(nation) AS INTEGER) AS is_total
    FROM (SELECT nullif(c_nationkey, 0) AS nation, c_acctbal FROM customer) GROUP BY ROLLUP (nation)""",
)
def rollup_sum(t: Tables) -> DataFrame:
    rows = t("customer").select(F.nullif("c_nationkey", F.lit(0)).alias("nation"), "c_acctbal")
    return stats.rollup_labeled(rows, "nation", F.sum(F.col("c_acctbal").cast(MONEY)), "total")


@query(
    "group_concat",
    """SELECT c_nationkey, string_agg(nullif(c_mktsegment, 'MACHINERY'), ', ' ORDER BY c_mktsegment) AS segments
    FROM customer GROUP BY c_nationkey""",
)
def group_concat_all(t: Tables) -> DataFrame:
    rows = t("customer").select("c_nationkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"))
    return group_concat(rows, ["c_nationkey"], "segment", "segments")


@query(
    "group_concat_distinct",
    """SELECT l_partkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS flags
    FROM lineitem GROUP BY l_partkey""",
)
def group_concat_distinct(t: Tables) -> DataFrame:
    return group_concat(t("lineitem"), ["l_partkey"], "l_returnflag", "flags", distinct=True)


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return t("lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_fd",
    """SELECT s_suppkey, s_name, count(*) AS n FROM supplier JOIN lineitem ON s_suppkey = l_suppkey
    GROUP BY s_suppkey, s_name""",
)
def agg_fd(t: Tables) -> DataFrame:
    """Grouping by a key while showing the columns it determines."""
    per = t("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    return per.join(t("supplier").select("s_suppkey", "s_name"), "s_suppkey").select("s_suppkey", "s_name", "n")


# ---- profiles --------------------------------------------------------------

_DESCRIBED = ["l_quantity", "l_linenumber", "l_discount"]


def _describe_sql(col: str) -> str:
    parts = {
        "count": f"CAST(count({col}) AS DOUBLE)",
        "mean": f"round(avg({col}), 6)",
        "stddev": f"round(stddev_samp({col}), 6)",
        "min": f"CAST(min({col}) AS DOUBLE)",
        "max": f"CAST(max({col}) AS DOUBLE)",
    }
    return " UNION ALL ".join(
        f"SELECT '{col}' AS \"column\", '{s}' AS stat, {e} AS value FROM lineitem" for s, e in parts.items()
    )


@query("describe_cols", " UNION ALL ".join(_describe_sql(c) for c in _DESCRIBED))
def describe_cols(t: Tables) -> DataFrame:
    return stats.profile(t("lineitem"), _DESCRIBED).withColumn("value", F.round("value", 6))


@query(
    "describe_text",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{s}' AS stat, CAST({s}({c}) AS VARCHAR) AS value FROM customer"
        for c in ("c_name", "c_mktsegment", "c_nationkey")
        for s in ("count", "min", "max")
    ),
)
def describe_text(t: Tables) -> DataFrame:
    return stats.profile_text(t("customer"), ["c_name", "c_mktsegment", "c_nationkey"])


_PROBS = (0.25, 0.5, 0.75)


@query(
    "summary_cols",
    " UNION ALL ".join(
        [
            *[_describe_sql(c) for c in _DESCRIBED],
            *[
                f"SELECT '{c}' AS \"column\", '{p * 100:g}%' AS stat, "
                f"CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem"
                for c in _DESCRIBED
                for p in _PROBS
            ],
        ]
    ),
)
def summary_cols(t: Tables) -> DataFrame:
    """The profile with exact quartiles."""
    lines = t("lineitem")
    found = exact_quantiles(lines, _DESCRIBED, list(_PROBS))
    label = F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%"))
    basic = stats.profile(lines, _DESCRIBED).withColumn("value", F.round("value", 6))
    return basic.unionAll(found.select("column", label, "value"))


_GROUPED = ("l_quantity", "l_extendedprice")


@query(
    "quantiles_by_group",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS \"column\", {p}::DOUBLE AS prob, "
        f"CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem GROUP BY l_returnflag"
        for c in _GROUPED
        for p in _PROBS
    ),
)
def quantiles_by_group(t: Tables) -> DataFrame:
    """Exact quartiles of every group of lines."""
    return exact_quantiles(t("lineitem"), list(_GROUPED), list(_PROBS), ["l_returnflag"])


@query(
    "corr",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem""",
)
def corr(t: Tables) -> DataFrame:
    return stats.corr_clean(t("lineitem"), "l_quantity", "l_extendedprice").select(
        F.round("corr", 6).alias("corr")
    )


@query("cov", "SELECT round(covar_samp(l_quantity, l_discount), 6) AS cov FROM lineitem")
def cov(t: Tables) -> DataFrame:
    return stats.cov_clean(t("lineitem"), "l_quantity", "l_discount").select(F.round("cov", 6).alias("cov"))


@query(
    "approx_quantiles",
    " UNION ALL ".join(f"SELECT {p}::DOUBLE AS prob, true AS is_value, true AS within" for p in _PROBS),
)
def approx_quantiles(t: Tables) -> DataFrame:
    """Per probability, whether the value occurs and its rank error is within 0.01."""
    found = materialize(stats.quantiles(t("lineitem"), "l_extendedprice", list(_PROBS)), "quantiles")
    errors = stats.rank_errors(t("lineitem"), found, "l_extendedprice")
    return errors.select(
        "prob", (F.col("upto") > F.col("below")).alias("is_value"), (F.col("error") <= 0.01).alias("within")
    )


# ---- samples ---------------------------------------------------------------

SEED = 7


def _hash_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


@query(
    "sample_half",
    f"SELECT o_orderkey FROM orders WHERE {_hash_sql('o_orderkey')} < 2147483648",
)
def sample_half(t: Tables) -> DataFrame:
    return sampling.sample_rows(t("orders"), ["o_orderkey"], 0.5, SEED).select("o_orderkey")


@query(
    "sample_strata",
    f"""SELECT o_orderkey, o_orderstatus FROM orders WHERE {_hash_sql('o_orderkey')} <
    CASE o_orderstatus WHEN 'F' THEN 2147483648 WHEN 'O' THEN 4294967296 ELSE 0 END""",
)
def sample_strata(t: Tables) -> DataFrame:
    picked = sampling.sample_by(t("orders"), ["o_orderkey"], "o_orderstatus", {"F": 0.5, "O": 1.0}, SEED)
    return picked.select("o_orderkey", "o_orderstatus")


@query(
    "split_rows",
    f"""SELECT o_orderkey, CASE WHEN h < {round(0.3 * 2**32)} THEN 0 WHEN h < {round(0.7 * 2**32)} THEN 1 ELSE 2 END AS split
    FROM (SELECT o_orderkey, {_hash_sql('o_orderkey')} AS h FROM orders)""",
)
def split_rows(t: Tables) -> DataFrame:
    return sampling.split_rows(t("orders").select("o_orderkey"), ["o_orderkey"], [0.3, 0.4, 0.3], SEED)


# ---- text ------------------------------------------------------------------

_LINES = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"
_WORDS = f"SELECT unnest(string_split(value, ' ')) AS word FROM ({_LINES})"
_REAL_WORDS = (
    "SELECT w AS word FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}\\p{N}_]+')) AS w "
    "FROM documents) WHERE regexp_full_match(w, '[A-Za-z]+')"
)


def _lines(t: Tables) -> DataFrame:
    return text.lines(t("documents"), "text")


def _real_word_counts(t: Tables) -> DataFrame:
    return text.word_count(text.extract_words(_lines(t)))


@query("line_filter", f"SELECT value FROM ({_LINES}) WHERE contains(value, 'the')")
def line_filter(t: Tables) -> DataFrame:
    return _lines(t).where(F.contains("value", F.lit("the")))


@query("line_lengths", f"SELECT length(value) AS n_chars FROM ({_LINES})")
def line_lengths(t: Tables) -> DataFrame:
    return _lines(t).select(F.length("value").cast("long").alias("n_chars"))


@query("total_chars", f"SELECT CAST(sum(length(value)) AS BIGINT) AS total FROM ({_LINES})")
def total_chars(t: Tables) -> DataFrame:
    return _lines(t).agg(F.sum(F.length("value")).alias("total"))


@query(
    "words_split",
    f"SELECT length(word) AS word_chars, count(*) AS n FROM ({_WORDS}) GROUP BY length(word)",
)
def words_split(t: Tables) -> DataFrame:
    words = text.split_words(_lines(t))
    return words.groupBy(F.length("word").cast("long").alias("word_chars")).agg(F.count(F.lit(1)).alias("n"))


@query("word_count", f"SELECT word, count(*) AS count FROM ({_WORDS}) GROUP BY word")
def word_count(t: Tables) -> DataFrame:
    return text.word_count(text.split_words(_lines(t)))


@query("words_regex", f"SELECT word, count(*) AS count FROM ({_REAL_WORDS}) GROUP BY word")
def words_regex(t: Tables) -> DataFrame:
    return _real_word_counts(t)


@query(
    "wc_sort_key",
    f"""SELECT word, count(*) AS count, row_number() OVER (ORDER BY word) AS ordinal
    FROM ({_REAL_WORDS}) GROUP BY word""",
)
def wc_sort_key(t: Tables) -> DataFrame:
    return numbering.number_rows(_real_word_counts(t), ["word"], "ordinal")


@query(
    "wc_top",
    f"SELECT word, count(*) AS count FROM ({_REAL_WORDS}) GROUP BY word ORDER BY count DESC, word LIMIT 20",
)
def wc_top(t: Tables) -> DataFrame:
    return ranking.top_k(_real_word_counts(t), 20, F.desc("count"), "word")


@query(
    "token_search",
    """WITH tok AS (
      SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(source || ' ' || text), '[^\\p{L}\\p{N}]+')) AS token
      FROM documents)
    SELECT doc_id FROM tok WHERE token IN ('the', 'and', 'in') GROUP BY doc_id HAVING count(*) = 3""",
)
def token_search(t: Tables) -> DataFrame:
    path = t.scratch("token-index")
    text.build_token_index(t("documents"), "doc_id", ["source", "text"], path)
    return text.search_tokens(t.spark.read.parquet(path), ["The", "and", "in"])
