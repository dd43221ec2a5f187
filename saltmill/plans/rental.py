"""Rental reports. Inputs are DataFrames with the column names of the rental schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import month_start_back, whole_days_over
from ..functions.strings import capitalize, group_concat, pg_concat
from ..operators.joins import hot_join, small_join, unmatched
from ..operators.ranking import first_per_key, top_k
from ..session import materialize
from ..sources.paths import children, exists

# ---- facts, combined per item before any join ------------------------------


def rentals_per_film(rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """(film_id, n) number of rentals."""
    per_item = rental.groupBy("inventory_id").agg(F.count(F.lit(1)).alias("n"))
    return per_item.join(inventory.select("inventory_id", "film_id"), "inventory_id").groupBy(
        "film_id"
    ).agg(F.sum("n").alias("n"))


def sales_by_item(payment: DataFrame, rental: DataFrame, inventory: DataFrame, by: str) -> DataFrame:
    """(by, amount) payments summed per film_id or store_id of the rented item."""
    per_rental = payment.groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    per_item = (
        per_rental.join(rental.select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_item.join(inventory.select("inventory_id", by), "inventory_id")
        .groupBy(by)
        .agg(F.sum("amount").alias("amount"))
    )


# ---- categories ------------------------------------------------------------


def films_per_category(film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Films per category; categories without films are left out."""
    per_id = film_category.groupBy("category_id").agg(F.count("film_id").alias("film_count"))
    return per_id.join(category.select("category_id", "name"), "category_id")


def sales_by_category(film_sales: DataFrame, film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Revenue per category name; a film in two categories counts in both."""
    per_id = (
        film_sales.join(film_category.select("film_id", "category_id"), "film_id")
        .groupBy("category_id")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_id.join(category.select("category_id", "name"), "category_id")
        .groupBy(F.col("name").alias("category"))
        .agg(F.sum("amount").alias("total_sales"))
    )


def top_category(film_sales: DataFrame, film_category: DataFrame, category: DataFrame, k: int = 1) -> DataFrame:
    """Categories with the largest revenue, rounded half-even to cents."""
    totals = sales_by_category(film_sales, film_category, category)
    rounded = totals.select("category", F.bround("total_sales", 2).alias("total_sales"))
    return top_k(rounded, k, F.desc("total_sales"), "category")


def refresh_sales(report: DataFrame, root: str, version: int) -> str:
    """Write the category report as a new snapshot, after a check that categories are unique."""
    once = report.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy("category")))
    broken = F.raise_error(F.concat(F.lit("category is not unique: "), F.col("category")))
    checked = once.select(
        F.when(F.col("_copies") == 1, F.col("category")).otherwise(broken.cast("string")).alias("category"),
        "total_sales",
    )
    path = f"{root}/version={version}"
    checked.write.mode("overwrite").parquet(path)
    return path


def read_sales(spark, root: str, schema: str) -> DataFrame:
    """Newest complete snapshot of the category report; no rows before the first refresh."""
    done = [
        int(d.removeprefix("version="))
        for d in children(spark, root)
        if d.startswith("version=") and exists(spark, f"{root}/{d}/_SUCCESS")
    ]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/version={max(done)}")


# ---- actors and films ------------------------------------------------------
# ``hot_from`` is a cheaper table with the keys of film_actor, see ``hot_join``.


def _named(actor: DataFrame) -> DataFrame:
    return actor.select("actor_id", pg_concat("first_name", F.lit(" "), "last_name").alias("full_name"))


def top_actors(
    film_rentals: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    k: int = 10,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Actors whose films were rented most; homonyms are kept apart by id."""
    uses = hot_join(film_actor.select("film_id", "actor_id"), film_rentals, "film_id", hot_from=hot_from)
    per_actor = uses.groupBy("actor_id").agg(F.sum("n").alias("films_count"))
    named = per_actor.join(_named(actor), "actor_id").select("actor_id", "full_name", "films_count")
    return top_k(named, k, F.desc("films_count"), "actor_id")


def top_actors_in_category(
    film_actor: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    actor: DataFrame,
    name: str,
    k: int = 3,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Actors with most films in one category."""
    wanted = category.where(F.col("name") == name).select("category_id")
    films = film_category.join(wanted, "category_id", "left_semi").groupBy("film_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_actors(films, film_actor, actor, k, hot_from)


def films_without_items(film: DataFrame, inventory: DataFrame) -> DataFrame:
    return unmatched(film.select("film_id", "title"), inventory, "film_id").select("title")


def actor_titles(
    film_actor: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    film: DataFrame,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """The rows under ``actor_info``: (film_id, actor_id, title, category_id, name)."""
    films = film.select("film_id", "title").join(film_category.select("film_id", "category_id"), "film_id")
    # Written once: the size check and the join read the result.
    films = materialize(small_join(films, category.select("category_id", "name"), "category_id"), "films")
    return small_join(film_actor.select("actor_id", "film_id"), films, "film_id", hot_from=hot_from)


def actor_info(
    actor: DataFrame,
    film_actor: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    film: DataFrame,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``category: title, title`` pieces per actor; NULL for an actor without films."""
    cast = actor_titles(film_actor, film_category, category, film, hot_from)
    titles = group_concat(cast, ["actor_id", "category_id", "name"], "title", "titles", count_copies=False)
    pieces = titles.select("actor_id", F.concat("name", F.lit(": "), "titles").alias("piece"))
    info = group_concat(pieces, ["actor_id"], "piece", "film_info", distinct=True, count_copies=False)
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def film_cast(
    film_actor: DataFrame, actor: DataFrame, nice: bool = False, hot_from: DataFrame | None = None
) -> DataFrame:
    """The rows under ``film_list``: (film_id, actor), a row per actor of a film."""
    if nice:
        name = F.concat(capitalize("first_name"), capitalize("last_name"))
    else:
        name = F.concat("first_name", F.lit(" "), "last_name")
    # Written once: the size check and the join read the result.
    names = materialize(actor.select("actor_id", name.alias("actor")), "cast-names")
    cast = small_join(film_actor.select("film_id", "actor_id"), names, "actor_id", hot_from=hot_from)
    return cast.select("film_id", "actor")


def film_list(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    nice: bool = False,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Films with category and the list of their actors; films without actors are left out.

    ``nice`` writes names with a capital and no blank between first and last name.
    """
    cast = film_cast(film_actor, actor, nice, hot_from)
    actors = group_concat(cast, ["film_id"], "actor", "actors", count_copies=False)
    films = film.select(
        "film_id", "title", "description", F.col("rental_rate").alias("price"), "length", "rating"
    )
    labels = category.select("category_id", F.col("name").alias("category"))
    placed = films.join(film_category.select("film_id", "category_id"), "film_id")
    return (
        small_join(placed, labels, "category_id")
        .join(actors, "film_id")
        .select(
            F.col("film_id").alias("fid"), "title", "description", "category", "price", "length", "rating", "actors"
        )
    )


# ---- people and stores -----------------------------------------------------


def _located(people: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    towns = small_join(
        city.select("city_id", "city", "country_id"), country.select("country_id", "country"), "country_id"
    ).drop("country_id")
    places = small_join(
        address.select("address_id", "address", F.col("postal_code").alias("zip code"), "phone", "city_id"),
        towns,
        "city_id",
        rows_of=city,
    ).drop("city_id")
    return small_join(people, places, "address_id", rows_of=address)


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    notes = F.when(F.col("activebool"), F.lit("active")).otherwise(F.lit(""))
    return _located(customer.drop("last_update"), address, city, country).select(
        F.col("customer_id").alias("id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("name"),
        "address",
        "zip code",
        "phone",
        "city",
        "country",
        notes.alias("notes"),
        F.col("store_id").alias("sid"),
    )


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return _located(staff.drop("last_update"), address, city, country).select(
        F.col("staff_id").alias("id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("name"),
        "address",
        "zip code",
        "phone",
        "city",
        "country",
        F.col("store_id").alias("sid"),
    )


def sales_by_store(
    store_sales: DataFrame,
    store: DataFrame,
    address: DataFrame,
    city: DataFrame,
    country: DataFrame,
    staff: DataFrame,
) -> DataFrame:
    """Revenue per store with its ``city,country`` label and manager."""
    managers = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("manager"),
    )
    labels = (
        store.select("store_id", "address_id", "manager_staff_id")
        .join(address.select("address_id", "city_id"), "address_id")
        .join(city.select("city_id", "city", "country_id"), "city_id")
        .join(country.select("country_id", "country"), "country_id")
        .join(managers, "manager_staff_id")
        .select("store_id", F.concat("city", F.lit(","), "country").alias("store"), "manager")
    )
    return store_sales.join(labels, "store_id").select(
        "store_id", "store", "manager", F.col("amount").alias("total_sales")
    )


# ---- stock -----------------------------------------------------------------


def in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """(inventory_id, film_id, store_id, in_stock): no rentals, or all of them returned."""
    out = (
        rental.where(F.col("return_date").isNull())
        .select("inventory_id")
        .distinct()
        .withColumn("_out", F.lit(True))
    )
    return inventory.select("inventory_id", "film_id", "store_id").join(
        out, "inventory_id", "left"
    ).select("inventory_id", "film_id", "store_id", F.col("_out").isNull().alias("in_stock"))


def film_in_stock(
    inventory: DataFrame,
    rental: DataFrame,
    film_id: int | None = None,
    store_id: int | None = None,
    available: bool = True,
) -> DataFrame:
    """Inventory ids of a film and store (None: any) that are in stock, or are not."""
    asked = inventory
    if film_id is not None:
        asked = asked.where(F.col("film_id") == film_id)
    if store_id is not None:
        asked = asked.where(F.col("store_id") == store_id)
    found = in_stock(asked, rental)
    return found.where(F.col("in_stock") == F.lit(available)).select("inventory_id")


def held_by(rental: DataFrame) -> DataFrame:
    """(inventory_id, customer_id) of open rentals; of several the latest counts."""
    opened = rental.where(F.col("return_date").isNull()).select(
        "inventory_id", "customer_id", "rental_date", "rental_id"
    )
    return first_per_key(
        opened, ["inventory_id"], F.desc("rental_date"), F.desc("rental_id"), F.desc("customer_id")
    ).select("inventory_id", "customer_id")


# ---- customers -------------------------------------------------------------


def rewards(
    payment: DataFrame,
    customer: DataFrame,
    as_of: Column,
    min_purchases: int,
    min_amount: float,
) -> DataFrame:
    """Customers above both thresholds in the calendar month three months before ``as_of``."""
    if min_purchases == 0:
        raise ValueError("minimum monthly purchases must be > 0")
    if min_amount == 0:
        raise ValueError("minimum monthly amount must be > 0")
    first = month_start_back(as_of, 3)
    # Compared as times, so the bounds reach the scan.
    in_month = payment.where(
        (F.col("payment_date") >= first) & (F.col("payment_date") < F.add_months(first, 1))
    )
    winners = (
        in_month.groupBy("customer_id")
        .agg(F.sum("amount").alias("_sum"), F.count("customer_id").alias("_n"))
        .where((F.col("_sum") > min_amount) & (F.col("_n") > min_purchases))
    )
    return customer.join(winners.select("customer_id"), "customer_id", "left_semi")


def balance(
    customer: DataFrame,
    rental: DataFrame,
    items: DataFrame,
    payment: DataFrame,
    as_of: Column,
    charge_replacement: bool = False,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """(customer_id, balance) at ``as_of``: rental fees + a dollar per overdue day - payments.

    ``items`` has inventory_id, rental_rate, rental_duration (and replacement_cost,
    charged on top for items overdue by more than twice the allowed days, if asked for).
    Fees and payments go through one aggregation instead of three joined ones. Items that
    fit are broadcast, so the rentals are not shuffled for them; ``hot_from`` is a cheaper
    table with the inventory ids for the other case, see ``hot_join``.
    """
    rented = small_join(
        rental.where(F.col("rental_date") <= as_of).select(
            "customer_id", "inventory_id", "rental_date", "return_date"
        ),
        items,
        "inventory_id",
        hot_from=hot_from,
    )
    start, end, allowed = F.col("rental_date"), F.col("return_date"), F.col("rental_duration")
    money = "decimal(18,2)"
    fee = F.col("rental_rate").cast(money) + whole_days_over(start, end, allowed).cast(money)
    if charge_replacement:
        lost = F.timestamp_diff("SECOND", start, end) > allowed.cast("long") * 3 * 86400
        fee = fee + F.when(lost, F.col("replacement_cost")).otherwise(F.lit(0)).cast(money)
    fees = rented.select("customer_id", fee.cast(money).alias("amount"))
    paid = payment.where(F.col("payment_date") <= as_of).select(
        "customer_id", (-F.col("amount").cast(money)).cast(money).alias("amount")
    )
    none = customer.select("customer_id", F.lit(0).cast(money).alias("amount"), F.lit(1).alias("_known"))
    moves = none.unionAll(fees.withColumn("_known", F.lit(0))).unionAll(paid.withColumn("_known", F.lit(0)))
    return (
        moves.groupBy("customer_id")
        .agg(F.sum("amount").alias("balance"), F.max("_known").alias("_known"))
        .where("_known = 1")
        .select("customer_id", "balance")
    )


def rental_items(inventory: DataFrame, film: DataFrame) -> DataFrame:
    """Inventory with the price columns that ``balance`` needs."""
    return inventory.select("inventory_id", "film_id").join(
        film.select("film_id", "rental_rate", "rental_duration", "replacement_cost"), "film_id"
    ).drop("film_id")
