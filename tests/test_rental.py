"""Reports on the hand-made rental database; the answers are worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from rows import rows
from pyspark.sql import functions as F
from rental_fixture import rental_tables

from saltmill import schemas
from saltmill.plans import rental
from saltmill.sources import sinks


@pytest.fixture(scope="module")
def db(spark):
    return rental_tables(spark)


@pytest.fixture(scope="module")
def film_rentals(db):
    return rental.rentals_per_film(db["rental"], db["inventory"])


@pytest.fixture(scope="module")
def film_sales(db):
    return rental.sales_by_item(db["payment"], db["rental"], db["inventory"], "film_id")


def test_declared_rules_hold(db):
    assert schemas.check_rental(db).collect() == []


def test_broken_rules_are_found(db, spark):
    bad = dict(db)
    bad["film_actor"] = db["film_actor"].unionAll(db["film_actor"].limit(1)).unionAll(
        db["film_actor"].limit(1).withColumn("film_id", F.lit(99))
    )
    bad["film"] = db["film"].withColumn("release_year", F.lit(1900)).withColumn("rating", F.lit("X"))
    found = {(r["table"], r["rule"], r["key"], r["n"]) for r in schemas.check_rental(bad).collect()}
    assert ("film_actor", "foreign_key(film_id)", "99", 1) in found
    assert ("film", "range(release_year)", "1900", 4) in found
    assert ("film", "enum(rating)", "X", 4) in found
    assert any(f[:2] == ("film_actor", "unique(actor_id, film_id)") for f in found)


def test_films_per_category(db):
    got = rental.films_per_category(db["film_category"], db["category"])
    assert rows(got) == [(1, 3, "Children"), (2, 2, "Drama")]


def test_rentals_and_sales_per_film(film_rentals, film_sales):
    assert rows(film_rentals) == [(1, 3), (2, 1), (4, 2)]
    assert rows(film_sales) == [(1, D("7.00")), (2, D("11.00")), (4, D("4.00"))]


def test_top_actors_keeps_homonyms_apart(db, film_rentals):
    got = rental.top_actors(film_rentals, db["film_actor"], db["actor"], 10)
    assert [tuple(r) for r in got.collect()] == [(1, "SUSAN DAVIS", 5), (2, "SUSAN DAVIS", 4), (3, "TOM FOX", 1)]


def test_top_actors_in_category_tie_goes_to_the_smaller_id(db):
    got = rental.top_actors_in_category(
        db["film_actor"], db["film_category"], db["category"], db["actor"], "Children", 2
    )
    assert [tuple(r) for r in got.collect()] == [(1, "SUSAN DAVIS", 2), (2, "SUSAN DAVIS", 1)]


def test_sales_by_category_and_top(db, film_sales):
    got = rental.sales_by_category(film_sales, db["film_category"], db["category"])
    assert rows(got) == [("Children", D("11.00")), ("Drama", D("15.00"))]
    assert rows(rental.top_category(film_sales, db["film_category"], db["category"])) == [("Drama", D("15.00"))]


def test_refresh_reads_the_newest_snapshot(spark, db, film_sales, tmp_path):
    root, schema = str(tmp_path / "mv"), "category STRING, total_sales DECIMAL(35,2)"
    assert rental.read_sales(spark, root, schema).collect() == []
    report = rental.sales_by_category(film_sales, db["film_category"], db["category"]).withColumn(
        "total_sales", F.col("total_sales").cast("decimal(35,2)")
    )
    rental.refresh_sales(report, root, 1)
    rental.refresh_sales(report.where("category = 'Drama'"), root, 2)
    assert rows(rental.read_sales(spark, root, schema)) == [("Drama", D("15.00"))]
    with pytest.raises(Exception, match="not unique"):
        rental.refresh_sales(report.unionAll(report), root, 3)
    assert rental.read_sales(spark, root, schema).count() == 1


def test_films_without_items(db):
    assert rows(rental.films_without_items(db["film"], db["inventory"])) == [("GAMMA",)]


def test_actor_info(db):
    got = rental.actor_info(db["actor"], db["film_actor"], db["film_category"], db["category"], db["film"])
    assert {r["actor_id"]: r["film_info"] for r in got.collect()} == {
        1: "Children: ALPHA, DELTA, Drama: DELTA",
        2: "Children: ALPHA, Drama: BETA",
        3: "Children: GAMMA, Drama: BETA",
        4: None,
    }


def test_customer_and_staff_lists(db):
    places = (db["address"], db["city"], db["country"])
    assert rows(rental.customer_list(db["customer"], *places)) == [
        (1, "Mary Ash", "3 Fir", "K1B", "333", "Ottawa", "Canada", "active", 1),
        (2, "John Bay", "2 Oak", None, "222", "Kyoto", "Japan", "", 2),
        (3, "Zoe Cox", "3 Fir", "K1B", "333", "Ottawa", "Canada", "active", 2),
    ]
    got = rental.staff_list(db["staff"], *places)
    assert got.columns == ["id", "name", "address", "zip code", "phone", "city", "country", "sid"]
    assert rows(got.select("id", "name", "sid")) == [(1, "Ann Lee", 1), (2, "Bob Ray", 2)]


@pytest.mark.parametrize(
    "nice, names",
    [
        (False, {1: "SUSAN DAVIS, SUSAN DAVIS", 2: "SUSAN DAVIS, TOM FOX", 3: "TOM FOX", 4: "SUSAN DAVIS"}),
        (True, {1: "SusanDavis, SusanDavis", 2: "SusanDavis, TomFox", 3: "TomFox", 4: "SusanDavis"}),
    ],
)
def test_film_list(db, nice, names):
    got = rental.film_list(
        db["film"], db["film_category"], db["category"], db["film_actor"], db["actor"], nice
    ).collect()
    assert sorted((r["fid"], r["category"]) for r in got) == [
        (1, "Children"), (2, "Drama"), (3, "Children"), (4, "Children"), (4, "Drama")
    ]
    assert {r["fid"]: r["actors"] for r in got} == names


def test_stock(db):
    got = rental.in_stock(db["inventory"], db["rental"]).select("inventory_id", "in_stock")
    assert rows(got) == [(1, True), (2, False), (3, True), (4, False), (5, True)]

    def ids(film, store, available=True):
        return rows(rental.film_in_stock(db["inventory"], db["rental"], film, store, available))

    assert ids(1, 1) == [(1,)] and ids(1, 2) == [] and ids(4, 2) == [(5,)]
    assert ids(1, 2, False) == [(2,)] and ids(4, 1, False) == [(4,)] and ids(4, 2, False) == []


def test_held_by_latest_open_rental(db):
    assert rows(rental.held_by(db["rental"])) == [(2, 2), (4, 2)]


@pytest.mark.parametrize(
    "purchases, amount, want", [(1, 9.99, [1]), (1, 10.00, []), (2, 1, []), (0.5, 2.99, [1, 2])]
)
def test_rewards_thresholds_are_strict(db, purchases, amount, want):
    as_of = F.lit(dt.date(2022, 5, 20))
    got = rental.rewards(db["payment"], db["customer"], as_of, purchases, amount)
    assert got.columns == db["customer"].columns
    assert [r["customer_id"] for r in got.orderBy("customer_id").collect()] == want


def test_rewards_refuses_zero(db):
    for args in ((0, 1.0), (1, 0.0)):
        with pytest.raises(ValueError):
            rental.rewards(db["payment"], db["customer"], F.lit(dt.date(2022, 5, 20)), *args)


def test_balance(db):
    items = rental.rental_items(db["inventory"], db["film"])

    def at(day, **options):
        got = rental.balance(
            db["customer"], db["rental"], items, db["payment"], F.lit(day).cast("timestamp"), **options
        )
        return {r["customer_id"]: r["balance"] for r in got.collect()}

    assert at("2022-03-31") == {1: D("4.50"), 2: D("4.00"), 3: D("0.00")}
    assert at("2022-03-31", charge_replacement=True) == {1: D("19.50"), 2: D("4.00"), 3: D("0.00")}
    assert at("2022-01-10 09:59:59") == {1: D("0.00"), 2: D("0.00"), 3: D("0.00")}
    assert at("2022-01-10 10:00:00") == {1: D("0.00"), 2: D("0.00"), 3: D("0.00")}
    assert at("2022-02-01 00:00:00") == {1: D("0.00"), 2: D("0.00"), 3: D("0.00")}
    assert at("2022-02-02 00:00:00") == {1: D("14.50"), 2: D("0.00"), 3: D("0.00")}


def test_sales_by_store(db):
    sales = rental.sales_by_item(db["payment"], db["rental"], db["inventory"], "store_id")
    got = rental.sales_by_store(sales, db["store"], db["address"], db["city"], db["country"], db["staff"])
    assert rows(got) == [
        (1, "Ottawa,Canada", "Ann Lee", D("20.00")),
        (2, "Kyoto,Japan", "Bob Ray", D("2.00")),
    ]


def test_payments_outside_the_store(db):
    stored, rejected = sinks.split_months(db["payment"], "payment_date", *schemas.PAYMENT_MONTHS)
    assert rows(rejected.select("payment_id")) == [(6,)]
    assert stored.count() == 6
