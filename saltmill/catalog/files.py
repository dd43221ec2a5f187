"""File formats, the raw-to-staged jobs, the paged feed and the monthly store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from ..schemas import SALES_DDL, sales_schema
from ..sources import files, paged, paths, sinks
from ..streaming import ingest
from .registry import Tables, query

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customer_csv(t: Tables) -> str:
    path = t.scratch("customer-csv")
    t("customer").write.csv(path, header=True)
    return path


@query("csv_infer", f"SELECT CAST(c_custkey AS INTEGER) AS c_custkey, * EXCLUDE (c_custkey) FROM ({_CUSTOMER})")
def csv_infer(t: Tables) -> DataFrame:
    return t.spark.read.csv(_customer_csv(t), header=True, inferSchema=True)


@query(
    "csv_schema_positional",
    "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS year, c_nationkey AS age FROM customer",
)
def csv_schema_positional(t: Tables) -> DataFrame:
    """Three declared columns over a five-column file: bound by position."""
    return files.read_csv(t.spark, _customer_csv(t), "id INT, year STRING, age INT")


@query(
    "csv_rejects",
    """SELECT c_custkey, CASE WHEN c_nationkey > 9 OR c_custkey % 7 < 2 THEN 'rejected' ELSE 'read' END AS state
    FROM customer""",
)
def csv_rejects(t: Tables) -> DataFrame:
    """Nations of two digits do not fit the type, and some lines are short or long: set apart."""
    path = t.scratch("customer-typed-csv")
    nation = F.when(F.col("c_nationkey") > 9, F.lit("many")).otherwise(F.col("c_nationkey").cast("string"))
    short, long = F.col("c_custkey") % 7 == 0, F.col("c_custkey") % 7 == 1
    rest = F.when(short, "").when(long, F.concat(F.lit(","), nation, F.lit(",x"))).otherwise(F.concat(F.lit(","), nation))
    t("customer").select(F.concat(F.col("c_custkey").cast("string"), rest)).write.text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("nation", T.IntegerType())])
    rows, rejects = files.read_csv_typed(t.spark, path, schema, header="false")
    return rows.select("c_custkey", F.lit("read").alias("state")).unionAll(
        rejects.select(F.col("c_custkey").cast("long"), F.lit("rejected"))
    )


@query(
    "csv_options",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
      'a;b "' || o_orderpriority || '" \\' AS note FROM orders""",
)
def csv_options(t: Tables) -> DataFrame:
    """Delimiter, quote, escape and date format, with all of them inside a value."""
    path = t.scratch("orders-csv")
    opts = {"delimiter": ";", "quote": '"', "escape": "\\", "dateFormat": "yyyy-MM-dd", "header": "true"}
    note = F.concat(F.lit('a;b "'), "o_orderpriority", F.lit('" \\'))
    rows = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), note.alias("note"))
    rows.write.options(**opts).csv(path)
    read = t.spark.read.options(inferSchema="true", **opts).csv(path)
    return read.select(F.col("o_orderkey").cast("long"), F.col("day").cast("string"), "note")


@query("json_multiline", _CUSTOMER)
def json_multiline(t: Tables) -> DataFrame:
    path = t.scratch("customer-json")
    sinks.write_json_arrays(t("customer"), path)
    read = files.read_json(t.spark, path)
    return read.select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment"
    )


_PERSON = """id BIGINT, name STRING,
    details STRUCT<age: INT, address: STRUCT<city: STRING, state: STRING>>"""


@query(
    "json_nested",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS age, c_mktsegment AS city FROM customer""",
)
def json_nested(t: Tables) -> DataFrame:
    path = t.scratch("person-json")
    address = F.struct(F.col("c_mktsegment").alias("city"), F.lit("x").alias("state"))
    details = F.struct(F.col("c_nationkey").alias("age"), address.alias("address"))
    people = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), details.alias("details")
    )
    sinks.write_json_arrays(people, path)
    read = files.read_json(t.spark, f"{path}/part-*", _PERSON)
    return read.select("id", "name", "details.age", "details.address.city")


@query("parquet_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = t.scratch("orders-parquet")
    t("orders").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("text_scan", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def text_scan(t: Tables) -> DataFrame:
    path = t.scratch("documents-text")
    t("documents").select("text").write.text(path)
    return t.spark.read.text(path)


# ---- raw and staged --------------------------------------------------------

_SALES = """SELECT CAST(o_custkey AS VARCHAR) AS client, strftime(o_orderdate, '%Y-%m-%d') AS purchase_date,
    o_orderpriority AS product, CAST(floor(o_totalprice) AS INTEGER) AS price FROM orders"""


def _sales(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_custkey").cast("string").alias("client"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("purchase_date"),
        F.col("o_orderpriority").alias("product"),
        F.floor("o_totalprice").cast("int").alias("price"),
    )


@query("land_raw", _SALES)
def land_raw(t: Tables) -> DataFrame:
    target = sinks.land(_sales(t), t.scratch("raw"), "/sales/all")
    return t.spark.read.schema(SALES_DDL).json(target)


@query(
    "raw_read",
    f"SELECT *, 'lines' AS layout FROM ({_SALES}) UNION ALL SELECT *, 'indented' FROM ({_SALES})",
)
def raw_read(t: Tables) -> DataFrame:
    """The same sales as JSON lines and as indented arrays."""
    target = sinks.land(_sales(t), t.scratch("raw"), "sales")
    arrays = t.scratch("raw-arrays")
    sinks.write_json_arrays(_sales(t), arrays)
    lines = files.read_raw(t.spark, target, SALES_DDL)
    indented = files.read_raw(t.spark, arrays, SALES_DDL, indented=True, pattern="part-*")
    return lines.withColumn("layout", F.lit("lines")).unionAll(indented.withColumn("layout", F.lit("indented")))


@query("stage_sales", _SALES)
def stage_sales(t: Tables) -> DataFrame:
    base = t.scratch("jobs")
    sinks.land(_sales(t), base, "raw/sales")
    target = sinks.stage(t.spark, base, "raw/sales", "stg/sales/", sales_schema())
    return t.spark.read.parquet(target)


_PAGE_ROWS = 2000


_ORDER_PAGES = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS month, o_totalprice FROM orders"
_ORDER_PAGE = "o_orderkey BIGINT, month STRING, o_totalprice DOUBLE"


def _order_feed(t: Tables) -> tuple[str, list[str]]:
    """Orders written as JSON pages per month; the folder and its months."""
    root = t.scratch("feed")
    month = F.date_format("o_orderdate", "yyyy-MM-01")
    (
        t("orders")
        .select("o_orderkey", month.alias("month"), "o_totalprice", month.alias("date"))
        .write.option("maxRecordsPerFile", _PAGE_ROWS)
        .partitionBy("date")
        .json(root)
    )
    span = t("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    months = [
        f"{y}-{m:02d}-01"
        for y in range(span.a.year, span.b.year + 1)
        for m in range(1, 13)
        if (span.a.year, span.a.month) <= (y, m) <= (span.b.year, span.b.month)
    ]
    return paths.qualified(t.spark, root), months


@query("paged_source", _ORDER_PAGES)
def paged_source(t: Tables) -> DataFrame:
    """Orders as a feed of JSON pages per month, read back page by page."""
    root, months = _order_feed(t)
    return paged.read_paged(
        t.spark, paged.FolderPages(), months, _ORDER_PAGE, root=root,
        lanes=4, tasks=4 * t.spark.sparkContext.defaultParallelism,
    )


@query("stream_paged", _ORDER_PAGES)
def stream_paged(t: Tables) -> DataFrame:
    """The same feed as a stream that stops after half of the months and goes on from its checkpoint."""
    root, months = _order_feed(t)
    out, state = t.scratch("paged-stream"), t.scratch("paged-stream-state")
    for known in (months[: len(months) // 2], months):
        stream = paged.stream_paged(t.spark, paged.FolderPages(), known, _ORDER_PAGE, root)
        ingest.land_batches(stream, out, state).awaitTermination()
    return t.spark.read.schema(_ORDER_PAGE).parquet(out).drop("batch_id")


# ---- monthly store ---------------------------------------------------------

_FIRST, _LAST = "1995-01", "1995-07"


def _payments(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "monthly_partitions",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-02-10' AND o_orderdate < TIMESTAMP '1995-05-01'""",
)
def monthly_partitions(t: Tables) -> DataFrame:
    path = t.scratch("monthly")
    rows = _payments(t)
    sinks.write_monthly(rows, "o_orderdate", path, _FIRST, _LAST)
    found = sinks.read_monthly(
        t.spark, path, rows.schema, "o_orderdate", dt.date(1995, 2, 10), dt.date(1995, 5, 1)
    )
    return found.select("o_orderkey", "o_totalprice")


@query(
    "partition_rejects",
    "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') NOT BETWEEN '1995-01' AND '1995-07'",
)
def partition_rejects(t: Tables) -> DataFrame:
    _, rejected = sinks.split_months(_payments(t), "o_orderdate", _FIRST, _LAST)
    return rejected.select("o_orderkey")
