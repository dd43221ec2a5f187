"""The star-schema tables under the column names of the rental schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import hot_join
from ..session import materialize, table

MONEY = "decimal(18,2)"
# A line counts as not returned yet if it has this flag and ships from this day on.
OPEN_FLAG, OPEN_FROM = "N", "2001-01-01"


def _open() -> Column:
    return (F.col("l_returnflag") == OPEN_FLAG) & (
        F.col("l_shipdate") >= F.lit(OPEN_FROM).cast("timestamp_ntz")
    )


def _returned() -> Column:
    return F.when(~_open(), F.col("l_shipdate")).alias("return_date")


class Star:
    """One rental table per method; unused columns are pruned at the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def film(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("description"),
            F.col("p_retailprice").cast(MONEY).alias("rental_rate"),
            F.col("p_size").alias("rental_duration"),
            F.col("p_size").alias("length"),
            F.col("p_type").alias("rating"),
        )

    def category(self) -> DataFrame:
        """Distinct part types, written once so that their size is known."""
        types = self.raw("part").select(F.col("p_type").alias("category_id")).distinct()
        return materialize(types, "category").withColumn("name", F.col("category_id"))

    def film_category(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id")
        )

    def actor(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.raw("supplier").join(nation, "s_nationkey").select(
            F.col("s_suppkey").alias("actor_id"),
            F.col("s_name").alias("first_name"),
            F.col("n_name").alias("last_name"),
        )

    def film_actor_lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")
        )

    def film_actor(self) -> DataFrame:
        return self.film_actor_lines().distinct()

    def film_rentals(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("film_id"))
            .agg(F.count(F.lit(1)).alias("n"))
        )

    def film_sales(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("film_id"))
            .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"))
        )

    def store_sales(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_suppkey").alias("store_id"))
            .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"))
        )

    def inventory(self) -> DataFrame:
        """One item per part."""
        return self.raw("part").select(
            F.col("p_partkey").alias("inventory_id"),
            F.col("p_partkey").alias("film_id"),
            F.lit(None).cast("long").alias("store_id"),
        )

    def store_inventory(self) -> DataFrame:
        """One item per part and supplier that sold it."""
        return (
            self.raw("lineitem")
            .select(
                F.col("l_partkey").alias("inventory_id"),
                F.col("l_partkey").alias("film_id"),
                F.col("l_suppkey").alias("store_id"),
            )
            .distinct()
        )

    def returns(self, only_open: bool = False) -> DataFrame:
        """Rentals without customer and start."""
        lines = self.raw("lineitem")
        if only_open:
            lines = lines.where(_open())
        return lines.select(F.col("l_partkey").alias("inventory_id"), _returned())

    def rental(self, only_open: bool = False) -> DataFrame:
        lines = self.raw("lineitem")
        if only_open:
            lines = lines.where(_open())
        return self._with_order(lines, _returned())

    def rented_lines(self) -> DataFrame:
        """All lines as rentals that ended at their ship date."""
        return self._with_order(self.raw("lineitem"), F.col("l_shipdate").alias("return_date"))

    def _with_order(self, lines: DataFrame, returned: Column) -> DataFrame:
        lines = lines.select(
            F.col("l_orderkey").alias("rental_id"), F.col("l_partkey").alias("inventory_id"), returned
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("rental_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"),
        )
        return hot_join(lines, orders, "rental_id")

    def items(self) -> DataFrame:
        return self.film().select(
            F.col("film_id").alias("inventory_id"), "rental_rate", "rental_duration"
        )

    def payment(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.col("o_orderdate").alias("payment_date"),
        )

    def customer(self) -> DataFrame:
        return self.raw("customer").withColumnRenamed("c_custkey", "customer_id")
