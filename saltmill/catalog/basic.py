"""Projections, filters, joins, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import month_start_back, real_date, valid_date, whole_days_over
from ..functions.strings import capitalize, pg_concat
from ..operators import joins, numbering, ranking, sets
from .registry import Tables, query

# ---- projections -----------------------------------------------------------


@query("proj_select", "SELECT c_custkey, c_name FROM customer")
def proj_select(t: Tables) -> DataFrame:
    return t("customer")[["c_custkey", "c_name", "c_nationkey"]].select("c_custkey", "c_name")


@query("proj_alias", "SELECT c_name AS full_name, c_acctbal FROM customer")
def proj_alias(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(c["c_name"].alias("full_name"), "c_acctbal")


@query("proj_expr", "SELECT p_name AS full_name, p_size + 5 AS size_5 FROM part")
def proj_expr(t: Tables) -> DataFrame:
    return t("part").selectExpr("p_name AS full_name", "p_size + 5 AS size_5")


@query("with_column", "SELECT p_partkey, p_size, p_size + 10 AS size_10 FROM part")
def with_column(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_size").withColumn("size_10", F.col("p_size") + 10)


@query("rename", "SELECT s_suppkey, s_name AS full_name, s_nationkey, s_acctbal FROM supplier")
def rename(t: Tables) -> DataFrame:
    return t("supplier").withColumnRenamed("s_name", "full_name")


@query("drop_col", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_col(t: Tables) -> DataFrame:
    return t("supplier").drop("s_acctbal")


@query("transform_pipe", "SELECT p_partkey, p_size + 5 AS size_plus_5 FROM part")
def transform_pipe(t: Tables) -> DataFrame:
    def add_five(df: DataFrame) -> DataFrame:
        return df.withColumn("size_plus_5", F.col("p_size") + 5)

    return t("part").transform(add_five).select("p_partkey", "size_plus_5")


@query(
    "case_when",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'active' ELSE '' END AS notes FROM customer",
)
def case_when(t: Tables) -> DataFrame:
    notes = F.when(F.col("c_acctbal") > 0, F.lit("active")).otherwise(F.lit(""))
    return t("customer").select("c_custkey", notes.alias("notes"))


@query("sql_view", "SELECT * FROM supplier WHERE s_acctbal > 25")
def sql_view(t: Tables) -> DataFrame:
    t("supplier").createOrReplaceTempView("saltmill_supplier")
    return t.spark.sql("SELECT * FROM saltmill_supplier WHERE s_acctbal > 25")


@query("parquet_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def parquet_scan(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


# ---- filters ---------------------------------------------------------------


@query("filter_gt", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_gt(t: Tables) -> DataFrame:
    c = t("customer").select("c_custkey", "c_acctbal")
    return c.filter(c["c_acctbal"] > 5000)


@query(
    "filter_and",
    "SELECT p_partkey, p_size FROM part WHERE p_size > 25 AND p_size < 30",
)
def filter_and(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_size").filter((F.col("p_size") > 25) & (F.col("p_size") < 30))


_WITH_NULLS = "SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS nation FROM customer"


def _with_nulls(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(0)).alias("nation"))


@query(
    "filter_null",
    f"""SELECT 'missing' AS state, count(*) AS n FROM ({_WITH_NULLS}) WHERE nation IS NULL
    UNION ALL SELECT 'present', count(*) FROM ({_WITH_NULLS}) WHERE nation IS NOT NULL""",
)
def filter_null(t: Tables) -> DataFrame:
    def tally(df: DataFrame, state: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(state).alias("state"), "n")

    rows = _with_nulls(t)
    missing = tally(rows.filter(F.col("nation").isNull()), "missing")
    return missing.unionAll(tally(rows.filter(F.col("nation").isNotNull()), "present"))


@query(
    "like_patterns",
    """SELECT p_partkey, p_name LIKE '%in%' AS has, p_name LIKE 'small%' AS head, p_name LIKE '%widget' AS tail
    FROM part WHERE p_name LIKE '%in%' OR p_name LIKE 'small%' OR p_name LIKE '%widget'""",
)
def like_patterns(t: Tables) -> DataFrame:
    name = F.col("p_name")
    has, head, tail = name.like("%in%"), name.like("small%"), name.like("%widget")
    return t("part").filter(has | head | tail).select(
        "p_partkey", has.alias("has"), head.alias("head"), tail.alias("tail")
    )


@query(
    "str_prefix_suffix",
    "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red') OR ends_with(p_name, 'ring')",
)
def str_prefix_suffix(t: Tables) -> DataFrame:
    return t("part").filter(F.col("p_name").startswith("red") | F.col("p_name").endswith("ring")).select(
        "p_partkey", "p_name"
    )


@query(
    "filter_isin",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_isin(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_orderpriority").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    )


@query("filter_eq", "SELECT p_partkey, p_type FROM part WHERE p_type = 'PROMO'")
def filter_eq(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_type").filter(F.col("p_type") == "PROMO")


@query(
    "filter_between",
    """SELECT o_orderkey FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'""",
)
def filter_between(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t("orders").filter(day.between(dt.date(1996, 2, 1), dt.date(1996, 2, 29))).select("o_orderkey")


@query("fillna", f"SELECT c_custkey, coalesce(nation, 99) AS nation FROM ({_WITH_NULLS})")
def fillna(t: Tables) -> DataFrame:
    return _with_nulls(t).fillna({"nation": 99}).select("c_custkey", "nation")


@query("dropna", f"SELECT * FROM ({_WITH_NULLS}) WHERE nation IS NOT NULL")
def dropna(t: Tables) -> DataFrame:
    return _with_nulls(t).dropna()


@query(
    "replace_values",
    "SELECT p_partkey, CASE p_size WHEN 3 THEN 30 WHEN 1 THEN 10 ELSE p_size END AS p_size FROM part",
)
def replace_values(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_size").replace({3: 30, 1: 10}, subset="p_size")


_TYPED_DAY = "strftime(o_orderdate, '%Y-%m') || '-' || CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR)"


@query(
    "date_shape",
    f"""SELECT o_orderkey, regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AS shape,
      regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND try_cast(d AS DATE) IS NOT NULL AS is_day
    FROM (SELECT o_orderkey, {_TYPED_DAY} AS d FROM orders)""",
)
def date_shape(t: Tables) -> DataFrame:
    """Prices as day numbers after the order month: some have the shape, some are days."""
    typed = F.concat(
        F.date_format("o_orderdate", "yyyy-MM"), F.lit("-"), F.floor(F.col("o_totalprice") / 10000).cast("string")
    )
    return t("orders").select("o_orderkey", typed.alias("d")).select(
        "o_orderkey", valid_date("d").alias("shape"), real_date("d").alias("is_day")
    )


# ---- scalar functions ------------------------------------------------------


@query(
    "str_concat",
    f"""SELECT c_custkey, coalesce(c_name, '') || ' ' || coalesce(CAST(nation AS VARCHAR), '') AS label
    FROM ({_WITH_NULLS})""",
)
def str_concat(t: Tables) -> DataFrame:
    return _with_nulls(t).select("c_custkey", pg_concat("c_name", F.lit(" "), "nation").alias("label"))


@query(
    "str_pipe",
    f"SELECT c_custkey, c_name || ' ' || CAST(nation AS VARCHAR) AS label FROM ({_WITH_NULLS})",
)
def str_pipe(t: Tables) -> DataFrame:
    label = F.concat("c_name", F.lit(" "), F.col("nation").cast("string"))
    return _with_nulls(t).select("c_custkey", label.alias("label"))


@query(
    "str_capitalize",
    "SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS label FROM part",
)
def str_capitalize(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", capitalize("p_name").alias("label"))


@query(
    "last_day",
    "SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end FROM orders",
)
def last_day(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", F.last_day("o_orderdate").cast("string").alias("month_end"))


@query(
    "month_back",
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate - INTERVAL 3 MONTH), '%Y-%m-%d') AS start
    FROM orders""",
)
def month_back(t: Tables) -> DataFrame:
    start = month_start_back("o_orderdate", 3).cast("string")
    return t("orders").select("o_orderkey", start.alias("start"))


@query(
    "extract_parts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, count(*) AS n
    FROM orders GROUP BY ALL""",
)
def extract_parts(t: Tables) -> DataFrame:
    return t("orders").groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "overdue_days",
    """SELECT days, count(*) AS n FROM (
      SELECT greatest(0, CAST(floor((epoch(l_shipdate) - epoch(o_orderdate) - p_size * 86400) / 86400) AS BIGINT)) AS days
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    ) GROUP BY days""",
)
def overdue_days(t: Tables) -> DataFrame:
    rented = joins.small_join(
        t.star.rented_lines(), t.star.items(), "inventory_id", hot_from=t.star.returns()
    )
    days = whole_days_over(F.col("rental_date"), F.col("return_date"), F.col("rental_duration"))
    return rented.groupBy(days.alias("days")).agg(F.count(F.lit(1)).alias("n"))


# ---- joins -----------------------------------------------------------------


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    names = t("customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.hot_join(orders, names, "custkey").select("o_orderkey", "c_name", "o_totalprice")


@query(
    "join_pairs",
    """SELECT o_custkey AS k, o_orderkey AS v, c_acctbal AS w
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_pairs(t: Tables) -> DataFrame:
    a = t("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    b = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("w"))
    pairs = joins.hot_join(a, b, "k").select("k", F.struct("v", "w").alias("pair"))
    return pairs.select("k", "pair.v", "pair.w")


@query(
    "join_chain",
    """SELECT r_name, n_name, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
)
def join_chain(t: Tables) -> DataFrame:
    """Orders are summed per customer, then per nation, before the next join."""
    per_customer = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    per_nation = (
        per_customer.join(t("customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.sum("orders").alias("orders"), F.sum("total").alias("total"))
    )
    return (
        per_nation.join(t("nation"), "n_nationkey")
        .join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .groupBy("r_name", "n_name")
        .agg(F.sum("orders").alias("orders"), F.sum("total").alias("total"))
    )


@query(
    "join_broadcast",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_broadcast(t: Tables) -> DataFrame:
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.small_join(t("customer").select("c_custkey", "c_nationkey"), nation, "c_nationkey").select(
        "c_custkey", "n_name"
    )


@query(
    "anti_via_left",
    "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL",
)
def anti_via_left(t: Tables) -> DataFrame:
    return joins.unmatched(t("documents").select("doc_id"), t("labels"), "doc_id")


@query(
    "anti_join",
    """SELECT o_orderkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def anti_join(t: Tables) -> DataFrame:
    returned = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.unmatched(t("orders").select("o_orderkey"), returned, "o_orderkey")


@query(
    "left_chain",
    """SELECT c_custkey, n_name, r_name FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_name <> 'NATION_7') n ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name <> 'AFRICA') r ON n_regionkey = r_regionkey""",
)
def left_chain(t: Tables) -> DataFrame:
    nation = t("nation").where("n_name <> 'NATION_7'").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    region = t("region").where("r_name <> 'AFRICA'").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    placed = joins.small_join(t("customer").select("c_custkey", "c_nationkey"), nation, "c_nationkey", "left")
    return joins.small_join(placed, region, "n_regionkey", "left").select("c_custkey", "n_name", "r_name")


@query(
    "outer_elim",
    """SELECT c_custkey, r_name FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_name <> 'NATION_7') n ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
)
def outer_elim(t: Tables) -> DataFrame:
    """The inner join on the null side lets Catalyst turn the left join into an inner one."""
    nation = t("nation").where("n_name <> 'NATION_7'")
    return (
        t("customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )


@query(
    "join_using",
    """SELECT p_partkey, n FROM part LEFT JOIN (
      SELECT l_partkey AS p_partkey, count(*) FILTER (l_quantity > 45) AS n FROM lineitem GROUP BY 1) q
    USING (p_partkey)""",
)
def join_using(t: Tables) -> DataFrame:
    sold = t("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count_if(F.col("l_quantity") > 45).alias("n")
    )
    return t("part").select("p_partkey").join(sold, on=["p_partkey"], how="left")


@query(
    "comma_join",
    """SELECT c_custkey, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
    FROM customer, orders WHERE c_custkey = o_custkey AND o_orderdate <= TIMESTAMP '1998-06-15' GROUP BY c_custkey""",
)
def comma_join(t: Tables) -> DataFrame:
    until = F.lit("1998-06-15").cast("timestamp_ntz")
    totals = t("orders").where(F.col("o_orderdate") <= until).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.coalesce(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), F.lit(0)).alias("total")
    )
    return t("customer").select("c_custkey").join(totals, "c_custkey")


@query(
    "cte_join",
    """WITH promo AS (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
    SELECT l_suppkey, count(*) AS n FROM lineitem JOIN promo ON l_partkey = p_partkey GROUP BY l_suppkey""",
)
def cte_join(t: Tables) -> DataFrame:
    """Lines of the chosen parts first, then one aggregation."""
    promo = t("part").where("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    sold = joins.small_join(t("lineitem").select("l_partkey", "l_suppkey"), promo, "l_partkey")
    return sold.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rewards",
    """SELECT c.* FROM customer c JOIN (
      SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12) k ON c_custkey = o_custkey""",
)
def rewards(t: Tables) -> DataFrame:
    """A table of keys joined back to the full rows."""
    keys = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t("customer").join(keys.where("n > 12"), "c_custkey", "left_semi")


@query(
    "corr_subquery",
    """SELECT c_custkey, (SELECT CAST(max(o_totalprice) AS DOUBLE) FROM orders WHERE o_custkey = c_custkey) AS best
    FROM customer""",
)
def corr_subquery(t: Tables) -> DataFrame:
    best = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("best"))
    return t("customer").select("c_custkey").join(best, "c_custkey", "left")


# ---- windows, sorts --------------------------------------------------------


@query(
    "win_row_number",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) = 1""",
)
def win_row_number(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.first_per_key(orders, ["o_orderpriority"], "o_totalprice", "o_orderkey")


@query(
    "win_rank",
    """SELECT l_returnflag, l_linenumber, l_orderkey, l_partkey, 1 AS rank FROM lineitem
    QUALIFY rank() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber) = 1""",
)
def win_rank(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_returnflag", "l_linenumber", "l_orderkey", "l_partkey")
    return ranking.rank_first(lines, ["l_returnflag"], "l_linenumber")


@query(
    "win_running_sum",
    """SELECT o_orderstatus, o_orderkey, row_number() OVER w AS row_number,
      rank() OVER (PARTITION BY o_orderstatus ORDER BY date_trunc('month', o_orderdate)) AS rank,
      dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY date_trunc('month', o_orderdate)) AS dense_rank,
      CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sum
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY date_trunc('month', o_orderdate), o_orderkey)""",
)
def win_running_sum(t: Tables) -> DataFrame:
    """All orders numbered, ranked by month and added up within their status."""
    orders = t("orders").select(
        "o_orderstatus",
        F.date_trunc("month", "o_orderdate").alias("month"),
        "o_orderkey",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    return ranking.running(orders, ["o_orderstatus"], ["month"], ["o_orderkey"], "cents").drop("month", "cents")


@query(
    "win_dense_rank",
    """SELECT o_orderpriority, o_orderstatus, o_orderkey, CAST(r AS INTEGER) AS dense_rank FROM (
      SELECT *, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus) AS r FROM orders)
    WHERE r IN (1, 2)""",
)
def win_dense_rank(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return ranking.dense_rank_upto(orders, ["o_orderpriority"], "o_orderstatus", 2)


@query(
    "sort_cols",
    """SELECT c_custkey, nation, row_number() OVER (ORDER BY nation DESC NULLS FIRST, c_custkey) AS ordinal
    FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS nation FROM customer)""",
)
def sort_cols(t: Tables) -> DataFrame:
    rows = _with_nulls(t).select("c_custkey", "nation")
    return numbering.number_rows(rows, [F.desc_nulls_first("nation"), F.asc("c_custkey")], "ordinal")


@query("limit_n", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 2")
def limit_n(t: Tables) -> DataFrame:
    return ranking.top_k(t("customer").select("c_custkey", "c_acctbal"), 2, F.desc("c_acctbal"), "c_custkey")


# ---- set operations --------------------------------------------------------


@query("union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t: Tables) -> DataFrame:
    return t("customer").select(F.col("c_nationkey").alias("k")).union(t("supplier").select("s_nationkey"))


_FLAG_ROWS = "SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag"


def _flag_rows(t: Tables, returned: bool) -> DataFrame:
    rows = t("lineitem").where((F.col("l_returnflag") == "R") == F.lit(returned))
    return rows.select("l_suppkey", "l_linenumber")


@query("intersect", f"{_FLAG_ROWS} = 'R' INTERSECT {_FLAG_ROWS} <> 'R'")
def intersect(t: Tables) -> DataFrame:
    return sets.intersect_rows(_flag_rows(t, True), _flag_rows(t, False))


@query("except_all", f"{_FLAG_ROWS} = 'R' EXCEPT ALL {_FLAG_ROWS} <> 'R'")
def except_all(t: Tables) -> DataFrame:
    return sets.except_all(_flag_rows(t, True), _flag_rows(t, False))


@query("distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct_rows(t: Tables) -> DataFrame:
    return sets.distinct_texts(t("documents").select("text", "lang"), "text")


@query(
    "dedup_subset",
    """SELECT text, doc_id, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def dedup_subset(t: Tables) -> DataFrame:
    keyed = t("documents").select("text", "doc_id", "source", sets.text_key("text").alias("_text"))
    return ranking.first_per_key(keyed, ["_text"], "doc_id").drop("_text")


@query(
    "union_recast",
    """SELECT CAST(c_custkey AS VARCHAR) AS user_uuid, c_name AS name, c_mktsegment AS surname, false AS is_driver
    FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, 'supplier', true FROM supplier""",
)
def union_recast(t: Tables) -> DataFrame:
    riders = t("customer").select(
        F.col("c_custkey").cast("string").alias("user_uuid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.lit(False).alias("is_driver"),
    )
    drivers = t("supplier").select(
        F.col("s_suppkey").cast("string").alias("driver_uuid"),
        F.col("s_name").alias("name"),
        F.lit("supplier").alias("surname"),
    )
    return sets.all_users(riders, drivers)
