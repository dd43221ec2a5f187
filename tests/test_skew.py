"""The row-level and grouped queries on tables where single keys hold a third of the rows.

Copies of the test tables in which a third of the line items share one order, a third
one part and a third one supplier, customers and orders crowd on one nation and one
customer, and many rows are exact copies.
"""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from saltmill.session import STAR_TABLES

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()

CROWDED = {
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END::INT AS c_nationkey) FROM customer",
    "supplier": "SELECT * REPLACE (CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE s_nationkey END::INT AS s_nationkey) FROM supplier",
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1995-03-01' ELSE o_orderdate END AS o_orderdate) FROM orders""",
    "lineitem": """SELECT * EXCLUDE (i) REPLACE (CASE WHEN i % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN i % 3 = 1 THEN 13 ELSE l_partkey END AS l_partkey,
        CASE WHEN i % 3 = 2 THEN 1 ELSE l_suppkey END AS l_suppkey)
        FROM (SELECT *, row_number() OVER () AS i FROM lineitem)
        UNION ALL SELECT l.* FROM (SELECT * FROM lineitem LIMIT 1) l, range(3000)""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id,
        CASE WHEN event_id % 5 < 3 THEN 'view' ELSE event_type END AS event_type) FROM events""",
    "documents": """SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM documents WHERE doc_id = 1)
        ELSE text END AS text) FROM documents""",
}
NAMES = sorted(
    n
    for n in ORACLES
    if n.startswith(("join_", "r_", "topk_", "win_", "dq_", "group_", "stream_"))
    or n in ("overdue_days", "except_all", "intersect", "dedup_subset", "latest_per_key", "upsert_touch",
             "token_search", "monthly_partitions", "anti_join", "corr_subquery", "sort_cols", "rollup_sum")
)


@pytest.fixture(scope="module")
def crowded(sf_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("crowded")
    con = connect(sf_dir)
    for name in STAR_TABLES:
        con.execute(f"COPY ({CROWDED.get(name, f'SELECT * FROM {name}')}) TO '{out}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
    con.close()
    return str(out)


@pytest.fixture(scope="module")
def duck(crowded) -> duckdb.DuckDBPyConnection:
    return connect(crowded)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_crowded_keys(spark, conf, crowded, duck, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert compare(QUERIES[name](spark, crowded), duck, ORACLES[name]) is None
