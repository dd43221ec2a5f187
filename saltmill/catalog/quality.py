"""Constraint checks on the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators import numbering, quality
from .registry import Tables, query

_DIRTY = """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority
    FROM orders"""


def _dirty(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )


@query(
    "dq_not_null",
    f"""SELECT 'orders' AS "table", 'not_null' AS rule, 'status' AS "key", count(*) AS n FROM ({_DIRTY}) WHERE status IS NULL
    UNION ALL SELECT 'orders', 'not_null', 'priority', count(*) FROM ({_DIRTY}) WHERE priority IS NULL""",
)
def dq_not_null(t: Tables) -> DataFrame:
    return quality.check_not_null(_dirty(t), "orders", ["o_orderkey", "status", "priority"])


@query(
    "dq_unique",
    """SELECT 'lineitem' AS "table", 'unique(l_orderkey, l_linenumber)' AS rule,
      l_orderkey || '|' || l_linenumber AS "key", count(*) AS n
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique(t: Tables) -> DataFrame:
    return quality.check_unique(t("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query(
    "dq_fk",
    """SELECT 'documents' AS "table", 'foreign_key(doc_id)' AS rule, CAST(doc_id AS VARCHAR) AS "key", count(*) AS n
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
    UNION ALL SELECT 'lineitem', 'foreign_key(l_orderkey)', CAST(l_orderkey AS VARCHAR), count(*)
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
)
def dq_fk(t: Tables) -> DataFrame:
    docs = quality.check_fk(t("documents"), "documents", "doc_id", t("labels"), "doc_id")
    return docs.unionAll(quality.check_fk(t("lineitem"), "lineitem", "l_orderkey", t("orders"), "o_orderkey"))


@query(
    "dq_delete_restrict",
    """SELECT o_orderkey, o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AS allowed
    FROM orders WHERE o_orderstatus = 'F'""",
)
def dq_delete_restrict(t: Tables) -> DataFrame:
    doomed = t("orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return quality.plan_delete(doomed, "o_orderkey", [(t("lineitem"), "l_orderkey")])


_MOVED = "CASE WHEN n_name = 'NATION_7' THEN {c} ELSE {c} + 100 END"


@query(
    "dq_update_cascade",
    f"""SELECT 'customer' AS child, c_custkey AS id, {_MOVED.format(c='c_nationkey')} AS nation
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'supplier', s_suppkey, {_MOVED.format(c='s_nationkey')}
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def dq_update_cascade(t: Tables) -> DataFrame:
    renamed = t("nation").where("n_name <> 'NATION_7'").select(
        F.col("n_nationkey").alias("old"), (F.col("n_nationkey") + 100).alias("new")
    )
    customers = quality.cascade_key(t("customer"), "c_nationkey", renamed)
    suppliers = quality.cascade_key(t("supplier"), "s_nationkey", renamed)
    return customers.select(
        F.lit("customer").alias("child"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")
    ).unionAll(suppliers.select(F.lit("supplier"), "s_suppkey", "s_nationkey"))


@query(
    "dq_range",
    """SELECT 'customer' AS "table", 'range(c_nationkey)' AS rule, CAST(c_nationkey AS VARCHAR) AS "key", count(*) AS n
    FROM customer WHERE NOT c_nationkey BETWEEN 2 AND 20 GROUP BY c_nationkey""",
)
def dq_range(t: Tables) -> DataFrame:
    return quality.check_range(t("customer"), "customer", "c_nationkey", 2, 20)


@query(
    "dq_enum",
    """SELECT 'orders' AS "table", 'enum(o_orderstatus)' AS rule, o_orderstatus AS "key", count(*) AS n
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""",
)
def dq_enum(t: Tables) -> DataFrame:
    return quality.check_enum(t("orders"), "orders", "o_orderstatus", ["F", "O"])


_TYPES = ["PROMO", "STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY"]


@query(
    "dq_enum_rank",
    "SELECT p_partkey, CAST(list_position(" + str(_TYPES) + ", p_type) AS BIGINT) AS rank FROM part",
)
def dq_enum_rank(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", quality.enum_rank("p_type", _TYPES).alias("rank"))


@query(
    "dq_summary",
    """SELECT 'lineitem' AS "table", 'unique(l_orderkey, l_linenumber)' AS rule, count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def dq_summary(t: Tables) -> DataFrame:
    return quality.summarize(dq_unique(t))


_RATINGS = ", ".join(f"'{r}'" for r in schemas.RATINGS)


@query(
    "dq_rental",
    f"""SELECT 'film' AS "table", 'enum(rating)' AS rule, p_type AS "key", count(*) AS n
    FROM part WHERE p_type NOT IN ({_RATINGS}) GROUP BY p_type
    UNION ALL SELECT 'film_actor', 'unique(actor_id, film_id)', l_suppkey || '|' || l_partkey, count(*)
    FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1
    UNION ALL SELECT 'film_category', 'foreign_key(category_id)', p_type, count(*)
    FROM part WHERE p_type = 'PROMO' GROUP BY p_type""",
)
def dq_rental(t: Tables) -> DataFrame:
    """The declared rules on the star tables; one category is left out of its table."""
    s = t.star
    return schemas.check_rental(
        {
            "film": s.film(),
            "film_actor": s.film_actor_lines(),
            "film_category": s.film_category(),
            "actor": s.actor(),
            "category": s.category().where("category_id <> 'PROMO'"),
        }
    )


@query(
    "dq_defaults",
    f"""SELECT o_orderkey, coalesce(status, 'open') AS status, coalesce(priority, 'none') AS priority FROM ({_DIRTY})""",
)
def dq_defaults(t: Tables) -> DataFrame:
    return quality.apply_defaults(_dirty(t), {"status": "open", "priority": "none"})


@query(
    "dq_assign_ids",
    """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS id FROM orders)
    SELECT o_orderkey, coalesce(id, (SELECT max(id) FROM d) + row_number() OVER (
      PARTITION BY id IS NULL ORDER BY o_orderkey)) AS id FROM d""",
)
def dq_assign_ids(t: Tables) -> DataFrame:
    rows = t("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id")
    )
    return numbering.assign_ids(rows, "id", ["o_orderkey"])
