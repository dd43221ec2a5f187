"""Rental reports on the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans import maintained, rental
from ..plans.star import MONEY
from .registry import Tables, query

_BRIDGE = "(SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)"
_ACTOR = "(SELECT s_suppkey, s_name || ' ' || n_name AS full_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
_CENTS = "CAST(l_extendedprice AS DECIMAL(18,2))"
MONEY_SUM = "decimal(28,2)"
_OPEN = "(l_returnflag = 'N' AND l_shipdate >= TIMESTAMP '2001-01-01')"


@query("r_count_by_category", "SELECT p_type AS category_id, p_type AS name, count(*) AS film_count FROM part GROUP BY p_type")
def r_count_by_category(t: Tables) -> DataFrame:
    return rental.films_per_category(t.star.film_category(), t.star.category()).select(
        "category_id", "name", "film_count"
    )


@query(
    "topk_actors",
    f"""SELECT b.l_suppkey AS actor_id, full_name, count(*) AS films_count
    FROM lineitem l JOIN {_BRIDGE} b ON l.l_partkey = b.l_partkey JOIN {_ACTOR} ON b.l_suppkey = s_suppkey
    GROUP BY 1, 2 ORDER BY films_count DESC, actor_id LIMIT 10""",
)
def topk_actors(t: Tables) -> DataFrame:
    s = t.star
    return rental.top_actors(s.film_rentals(), s.film_actor(), s.actor(), 10, s.film_actor_lines())


@query(
    "topk_category_revenue",
    f"""SELECT p_type AS category, CAST(round_even(sum({_CENTS}), 2) AS DOUBLE) AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY sum({_CENTS}) DESC, category LIMIT 1""",
)
def topk_category_revenue(t: Tables) -> DataFrame:
    return rental.top_category(t.star.film_sales(), t.star.film_category(), t.star.category(), 1)


@query(
    "r_unmatched",
    "SELECT CAST(o_orderkey AS VARCHAR) AS title FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def r_unmatched(t: Tables) -> DataFrame:
    film = t("orders").select(
        F.col("o_orderkey").alias("film_id"), F.col("o_orderkey").cast("string").alias("title")
    )
    return rental.films_without_items(film, t("lineitem").select(F.col("l_orderkey").alias("film_id")))


@query(
    "topk_actors_in_category",
    f"""SELECT b.l_suppkey AS actor_id, full_name, count(*) AS films_count
    FROM {_BRIDGE} b JOIN part ON b.l_partkey = p_partkey JOIN {_ACTOR} ON b.l_suppkey = s_suppkey
    WHERE p_type = 'PROMO' GROUP BY 1, 2 ORDER BY films_count DESC, actor_id LIMIT 3""",
)
def topk_actors_in_category(t: Tables) -> DataFrame:
    s = t.star
    return rental.top_actors_in_category(
        s.film_actor(), s.film_category(), s.category(), s.actor(), "PROMO", 3, s.film_actor_lines()
    )


@query(
    "r_actor_info",
    f"""WITH titles AS (
      SELECT l_suppkey, p_type, string_agg(p_name, ', ' ORDER BY p_name) AS names
      FROM {_BRIDGE} JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_type),
    info AS (
      SELECT l_suppkey, string_agg(p_type || ': ' || names, ', ' ORDER BY p_type || ': ' || names) AS film_info
      FROM titles GROUP BY l_suppkey)
    SELECT s_suppkey AS actor_id, s_name AS first_name, n_name AS last_name, film_info
    FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN info ON l_suppkey = s_suppkey""",
)
def r_actor_info(t: Tables) -> DataFrame:
    s = t.star
    return rental.actor_info(
        s.actor(), s.film_actor(), s.film_category(), s.category(), s.film(), s.film_actor_lines()
    )


@query(
    "r_actor_info_rows",
    f"""SELECT l_suppkey AS actor_id, p_type AS name, p_name AS title
    FROM {_BRIDGE} JOIN part ON l_partkey = p_partkey""",
)
def r_actor_info_rows(t: Tables) -> DataFrame:
    """The titles of every actor as rows, of which the report makes lists."""
    s = t.star
    cast = rental.actor_titles(
        s.film_actor(), s.film_category(), s.category(), s.film(), s.film_actor_lines()
    )
    return cast.select("actor_id", "name", "title")


def _places(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nations as addresses and cities, regions as countries."""
    n = t("nation")
    address = n.select(
        F.col("n_nationkey").alias("address_id"),
        F.lit("-").alias("address"),
        F.lit(None).cast("string").alias("postal_code"),
        F.lit("-").alias("phone"),
        F.col("n_nationkey").alias("city_id"),
    )
    city = n.select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
    )
    country = t("region").select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"))
    return address, city, country


@query(
    "r_customer_list",
    """SELECT c_custkey AS id, c_name || ' ' || c_mktsegment AS name, n_name AS city, r_name AS country,
      CASE WHEN c_acctbal > 0 THEN 'active' ELSE '' END AS notes, c_nationkey AS sid
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def r_customer_list(t: Tables) -> DataFrame:
    customer = t("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_nationkey").alias("address_id"),
        (F.col("c_acctbal") > 0).alias("activebool"),
        F.col("c_nationkey").alias("store_id"),
    )
    return rental.customer_list(customer, *_places(t)).drop("address", "zip code", "phone")


def _staff(t: Tables) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.col("s_name").alias("first_name"),
        F.lit("Manager").alias("last_name"),
        F.col("s_nationkey").alias("address_id"),
        F.col("s_suppkey").alias("store_id"),
    )


@query(
    "r_staff_list",
    """SELECT s_suppkey AS id, s_name || ' Manager' AS name, n_name AS city, r_name AS country, s_suppkey AS sid
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def r_staff_list(t: Tables) -> DataFrame:
    return rental.staff_list(_staff(t), *_places(t)).drop("address", "zip code", "phone")


def _film_list_sql(name: str) -> str:
    return f"""WITH cast_list AS (
      SELECT l_partkey, string_agg({name}, ', ' ORDER BY {name}) AS actors
      FROM {_BRIDGE} JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      GROUP BY l_partkey)
    SELECT p_partkey AS fid, p_name AS title, p_brand AS description, p_type AS category,
      CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price, p_size AS length, p_type AS rating, actors
    FROM part JOIN cast_list ON l_partkey = p_partkey"""


def _film_list(t: Tables, nice: bool) -> DataFrame:
    s = t.star
    return rental.film_list(
        s.film(), s.film_category(), s.category(), s.film_actor(), s.actor(), nice, s.film_actor_lines()
    )


@query("r_film_list", _film_list_sql("s_name || ' ' || n_name"))
def r_film_list(t: Tables) -> DataFrame:
    return _film_list(t, False)


_NICE = " || ".join(f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))" for c in ("s_name", "n_name"))


@query("r_film_list_nice", _film_list_sql(_NICE))
def r_film_list_nice(t: Tables) -> DataFrame:
    return _film_list(t, True)


@query(
    "r_film_list_rows",
    f"""SELECT l_partkey AS film_id, s_name || ' ' || n_name AS actor
    FROM {_BRIDGE} JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def r_film_list_rows(t: Tables) -> DataFrame:
    """The cast of every film as rows, of which the report makes lists."""
    s = t.star
    return rental.film_cast(s.film_actor(), s.actor(), hot_from=s.film_actor_lines())


# ---- stock -----------------------------------------------------------------


@query(
    "r_in_stock",
    f"""SELECT p_partkey AS inventory_id,
      p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE {_OPEN}) AS in_stock FROM part""",
)
def r_in_stock(t: Tables) -> DataFrame:
    return rental.in_stock(t.star.inventory(), t.star.returns(only_open=True)).select("inventory_id", "in_stock")


def _store_sql(available: str) -> str:
    return f"""SELECT l_partkey AS inventory_id FROM {_BRIDGE} WHERE l_suppkey = 1
    AND l_partkey {available} (SELECT l_partkey FROM lineitem WHERE {_OPEN})"""


@query("r_film_in_stock", _store_sql("NOT IN"))
def r_film_in_stock(t: Tables) -> DataFrame:
    return rental.film_in_stock(t.star.store_inventory(), t.star.returns(only_open=True), store_id=1)


@query("r_film_not_in_stock", _store_sql("IN"))
def r_film_not_in_stock(t: Tables) -> DataFrame:
    return rental.film_in_stock(t.star.store_inventory(), t.star.returns(only_open=True), store_id=1, available=False)


@query(
    "r_held_by",
    f"""SELECT l_partkey AS inventory_id, o_custkey AS customer_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {_OPEN}
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def r_held_by(t: Tables) -> DataFrame:
    return rental.held_by(t.star.rental(only_open=True))


# ---- customers -------------------------------------------------------------


@query(
    "r_rewards",
    """SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey IN (
      SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
      GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 100000 AND count(*) > 1)""",
)
def r_rewards(t: Tables) -> DataFrame:
    as_of = F.lit("1998-06-15").cast("date")
    return rental.rewards(t.star.payment(), t.star.customer(), as_of, 1, 100000)


@query(
    "r_balance",
    """WITH paid AS (
      SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS paid
      FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-15' GROUP BY o_custkey),
    fees AS (
      SELECT o_custkey, sum(CAST(p_retailprice AS DECIMAL(18,2))) + sum(greatest(0,
        CAST(floor((epoch(l_shipdate) - epoch(o_orderdate) - p_size * 86400) / 86400) AS BIGINT))) AS fees
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      WHERE o_orderdate <= TIMESTAMP '1998-06-15' GROUP BY o_custkey)
    SELECT c_custkey AS customer_id, CAST(coalesce(fees, 0) - coalesce(paid, 0) AS DOUBLE) AS balance
    FROM customer LEFT JOIN paid ON c_custkey = paid.o_custkey LEFT JOIN fees ON c_custkey = fees.o_custkey""",
)
def r_balance(t: Tables) -> DataFrame:
    s = t.star
    as_of = F.lit("1998-06-15").cast("timestamp_ntz")
    return rental.balance(
        s.customer(), s.rented_lines(), s.items(), s.payment(), as_of, hot_from=s.returns()
    )


# ---- sales -----------------------------------------------------------------

_BY_TYPE = f"""SELECT p_type AS category, CAST(sum({_CENTS}) AS DOUBLE) AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type"""


def _by_category(t: Tables) -> DataFrame:
    return rental.sales_by_category(t.star.film_sales(), t.star.film_category(), t.star.category())


@query("r_sales_by_category", _BY_TYPE)
def r_sales_by_category(t: Tables) -> DataFrame:
    return _by_category(t)


@query("r_refresh", _BY_TYPE)
def r_refresh(t: Tables) -> DataFrame:
    root = t.scratch("sales-by-category")
    report = _by_category(t)
    rental.refresh_sales(report, root, 1)
    total = report.schema["total_sales"].dataType.simpleString()
    return rental.read_sales(t.spark, root, f"category STRING, total_sales {total}")


@query("r_refresh_delta", _BY_TYPE)
def r_refresh_delta(t: Tables) -> DataFrame:
    """The view from sums per film kept up by batches: lines, more lines, corrections, one batch twice.

    Returned lines come with double their price first and are corrected by the third batch.
    """
    root, schema = t.scratch("film-sums"), f"film_id BIGINT, amount {MONEY_SUM}"
    lines = t("lineitem").select(
        F.col("l_partkey").alias("film_id"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    came, went = F.lit(1).alias("sign"), F.lit(-1).alias("sign")
    wrong = lines.where("returned").select("film_id", (F.col("amount") * 2).alias("amount"))
    right = lines.where("returned").select("film_id", "amount")
    batches = [
        wrong.select("*", came),
        lines.where("NOT returned").select("film_id", "amount", came),
        wrong.select("*", went).unionAll(right.select("*", came)),
    ]
    for number in (1, 2, 2, 3):
        maintained.apply_changes(batches[number - 1], root, number, schema, "amount")
    sums = maintained.read_sums(t.spark, root, schema)
    return rental.sales_by_category(sums, t.star.film_category(), t.star.category())


@query(
    "r_sales_by_store",
    f"""SELECT s_suppkey AS store_id, n_name || ',' || r_name AS store, s_name || ' Manager' AS manager,
      CAST(sum({_CENTS}) AS DOUBLE) AS total_sales
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
)
def r_sales_by_store(t: Tables) -> DataFrame:
    address, city, country = _places(t)
    store = t("supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_nationkey").alias("address_id"),
        F.col("s_suppkey").alias("manager_staff_id"),
    )
    return rental.sales_by_store(t.star.store_sales(), store, address, city, country, _staff(t))


# ---- payments through rentals and items ------------------------------------


def _order_chain(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders as rentals of an item, customers as items, their nations as films and stores."""
    rentals = t("orders").select(
        F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("inventory_id")
    )
    items = t("customer").select(
        F.col("c_custkey").alias("inventory_id"),
        F.col("c_nationkey").alias("film_id"),
        F.col("c_nationkey").alias("store_id"),
    )
    return rentals, items


@query(
    "r_rentals_per_film",
    """SELECT c_nationkey AS film_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_nationkey""",
)
def r_rentals_per_film(t: Tables) -> DataFrame:
    return rental.rentals_per_film(*_order_chain(t))


@query(
    "r_sales_by_item",
    """SELECT c_nationkey AS store_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
)
def r_sales_by_item(t: Tables) -> DataFrame:
    payments = t.star.payment().withColumnRenamed("payment_id", "rental_id")
    return rental.sales_by_item(payments, *_order_chain(t), by="store_id")
