"""Declared schemas, keys and rules of the rental, sales and ride tables.

Fixed values: column names, types, keys and bounds that stored data must match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .operators import quality

_STAMP = "last_update TIMESTAMP NOT NULL"

RENTAL_DDL = {
    "actor": f"actor_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, {_STAMP}",
    "address": "address_id INT NOT NULL, address STRING NOT NULL, address2 STRING, district STRING NOT NULL, "
    f"city_id INT NOT NULL, postal_code STRING, phone STRING NOT NULL, {_STAMP}",
    "category": f"category_id INT NOT NULL, name STRING NOT NULL, {_STAMP}",
    "city": f"city_id INT NOT NULL, city STRING NOT NULL, country_id INT NOT NULL, {_STAMP}",
    "country": f"country_id INT NOT NULL, country STRING NOT NULL, {_STAMP}",
    "customer": "customer_id INT NOT NULL, store_id INT NOT NULL, first_name STRING NOT NULL, "
    "last_name STRING NOT NULL, email STRING, address_id INT NOT NULL, activebool BOOLEAN NOT NULL, "
    "create_date DATE NOT NULL, last_update TIMESTAMP, active INT",
    "film": "film_id INT NOT NULL, title STRING NOT NULL, description STRING, release_year INT, "
    "language_id INT NOT NULL, original_language_id INT, rental_duration SMALLINT NOT NULL, "
    "rental_rate DECIMAL(4,2) NOT NULL, length SMALLINT, replacement_cost DECIMAL(5,2) NOT NULL, "
    f"rating STRING, {_STAMP}, special_features ARRAY<STRING>, fulltext ARRAY<STRING> NOT NULL",
    "film_actor": f"actor_id INT NOT NULL, film_id INT NOT NULL, {_STAMP}",
    "film_category": f"film_id INT NOT NULL, category_id INT NOT NULL, {_STAMP}",
    "inventory": f"inventory_id INT NOT NULL, film_id INT NOT NULL, store_id INT NOT NULL, {_STAMP}",
    "language": f"language_id INT NOT NULL, name STRING NOT NULL, {_STAMP}",
    "payment": "payment_id INT NOT NULL, customer_id INT NOT NULL, staff_id INT NOT NULL, "
    "rental_id INT NOT NULL, amount DECIMAL(5,2) NOT NULL, payment_date TIMESTAMP NOT NULL",
    "rental": "rental_id INT NOT NULL, rental_date TIMESTAMP NOT NULL, inventory_id INT NOT NULL, "
    f"customer_id INT NOT NULL, return_date TIMESTAMP, staff_id INT NOT NULL, {_STAMP}",
    "staff": "staff_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
    "address_id INT NOT NULL, email STRING, store_id INT NOT NULL, active BOOLEAN NOT NULL, "
    f"username STRING NOT NULL, password STRING, {_STAMP}, picture BINARY",
    "store": f"store_id INT NOT NULL, manager_staff_id INT NOT NULL, address_id INT NOT NULL, {_STAMP}",
}

SALES_DDL = (
    "client STRING NOT NULL, purchase_date STRING NOT NULL, product STRING NOT NULL, price INT NOT NULL"
)

RIDE_DDL = {
    "ride": "ride_uuid STRING, user_uuid STRING, driver_uuid STRING, distance DOUBLE, price DOUBLE",
    "driver": "driver_uuid STRING, name STRING, surname STRING, car_uuid STRING, "
    "effective_from STRING, expiry_date STRING",
    "user": "user_uuid STRING, name STRING, surname STRING, is_driver BOOLEAN",
}
RIDE_KEYS = {"ride": "ride_uuid", "driver": "driver_uuid", "user": "user_uuid"}

# Primary keys first, then other unique column sets.
UNIQUE = {
    "actor": [["actor_id"]],
    "address": [["address_id"]],
    "category": [["category_id"]],
    "city": [["city_id"]],
    "country": [["country_id"]],
    "customer": [["customer_id"]],
    "film": [["film_id"]],
    "film_actor": [["actor_id", "film_id"]],
    "film_category": [["film_id", "category_id"]],
    "inventory": [["inventory_id"]],
    "language": [["language_id"]],
    "payment": [["payment_date", "payment_id"]],
    "rental": [["rental_id"], ["rental_date", "inventory_id", "customer_id"]],
    "staff": [["staff_id"]],
    "store": [["store_id"], ["manager_staff_id"]],
}

# (child, column, parent, parent column)
FOREIGN_KEYS = [
    ("address", "city_id", "city", "city_id"),
    ("city", "country_id", "country", "country_id"),
    ("customer", "address_id", "address", "address_id"),
    ("customer", "store_id", "store", "store_id"),
    ("film", "language_id", "language", "language_id"),
    ("film", "original_language_id", "language", "language_id"),
    ("film_actor", "actor_id", "actor", "actor_id"),
    ("film_actor", "film_id", "film", "film_id"),
    ("film_category", "category_id", "category", "category_id"),
    ("film_category", "film_id", "film", "film_id"),
    ("inventory", "film_id", "film", "film_id"),
    ("inventory", "store_id", "store", "store_id"),
    ("payment", "customer_id", "customer", "customer_id"),
    ("payment", "rental_id", "rental", "rental_id"),
    ("payment", "staff_id", "staff", "staff_id"),
    ("rental", "customer_id", "customer", "customer_id"),
    ("rental", "inventory_id", "inventory", "inventory_id"),
    ("rental", "staff_id", "staff", "staff_id"),
    ("staff", "address_id", "address", "address_id"),
    ("staff", "store_id", "store", "store_id"),
    ("store", "address_id", "address", "address_id"),
]

# Fixed-width text columns.
PADDED = {"language": ["name"]}

RATINGS = ["G", "PG", "PG-13", "R", "NC-17"]
YEARS = (1901, 2155)
PAYMENT_MONTHS = ("2022-01", "2022-07")

DEFAULTS = {
    "customer": {"activebool": True},
    "film": {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99", "rating": "G"},
    "staff": {"active": True},
}
# Columns that default to the day of the write.
TODAY = {"customer": ["create_date"]}
RANGES = {"film": {"release_year": YEARS}}
ENUMS = {"film": {"rating": RATINGS}}


def rental_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RENTAL_DDL[table])


def sales_schema() -> T.StructType:
    return T.StructType.fromDDL(SALES_DDL)


def payload_schema() -> T.StructType:
    """Ride, driver and user, all required, and the arrival number."""
    parts = [T.StructField(p, T.StructType.fromDDL(ddl), False) for p, ddl in RIDE_DDL.items()]
    return T.StructType([*parts, T.StructField("seq", T.LongType(), False)])


def typed_defaults(table: str, as_of: Column | None = None) -> dict[str, Column]:
    """Defaults of a table in its column types.

    The time of the write is a default too (``last_update``, and today for CURRENT_DATE);
    it is ``as_of``, so that a run can be repeated. Without it those columns have none.
    """
    schema = rental_schema(table)
    given = {c: F.lit(v) for c, v in DEFAULTS.get(table, {}).items()}
    if as_of is not None:
        given |= {c: as_of for c in ["last_update", *TODAY.get(table, [])] if c in schema.names}
    return {c: v.cast(schema[c].dataType) for c, v in given.items()}


def check_rental(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared rules over the given rental tables, as violation rows.

    Rules on values are checked in one scan per table; columns a table does not have are
    left out.
    """
    found = []
    for name, df in tables.items():
        required = [f.name for f in rental_schema(name) if not f.nullable and f.name in df.columns]
        ranges = {c: r for c, r in RANGES.get(name, {}).items() if c in df.columns}
        enums = {c: v for c, v in ENUMS.get(name, {}).items() if c in df.columns}
        found.append(quality.check_values(df, name, required, ranges, enums))
        found += [
            quality.check_unique(df, name, keys) for keys in UNIQUE[name] if set(keys) <= set(df.columns)
        ]
    for child, col, parent, parent_col in FOREIGN_KEYS:
        if child in tables and parent in tables and col in tables[child].columns:
            found.append(quality.check_fk(tables[child], child, col, tables[parent], parent_col))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out
