"""A small rental database worked out by hand.

Two actors share a name; actor 4 has no film; film 3 has no item; category 3 has no
film; film 4 is in two categories. Item 5 was never rented, 1 and 3 came back, 2 has
one open rental and 4 has two. Rental 1 came back exactly on time, 2 a day and a half
late, 3 eleven days late (more than twice its five days). Payment 6 is outside the
stored months, 2 and 4 are at midnight on the first of a month.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from saltmill.schemas import rental_schema


def _t(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


NOW = _t("2022-01-01")

ROWS = {
    "language": [(1, "English             ", NOW)],
    "country": [(1, "Canada", NOW), (2, "Japan", NOW)],
    "city": [(1, "Ottawa", 1, NOW), (2, "Kyoto", 2, NOW)],
    "address": [
        (1, "1 Elm", None, "North", 1, "K1A", "111", NOW),
        (2, "2 Oak", None, "South", 2, None, "222", NOW),
        (3, "3 Fir", None, "East", 1, "K1B", "333", NOW),
    ],
    "store": [(1, 1, 1, NOW), (2, 2, 2, NOW)],
    "staff": [
        (1, "Ann", "Lee", 1, None, 1, True, "ann", None, NOW, None),
        (2, "Bob", "Ray", 2, None, 2, True, "bob", None, NOW, None),
    ],
    "customer": [
        (1, 1, "Mary", "Ash", "m@x", 3, True, dt.date(2022, 1, 1), NOW, 1),
        (2, 2, "John", "Bay", None, 2, False, dt.date(2022, 1, 1), NOW, 0),
        (3, 2, "Zoe", "Cox", None, 3, True, dt.date(2022, 1, 1), NOW, 1),
    ],
    "category": [(1, "Children", NOW), (2, "Drama", NOW), (3, "Horror", NOW)],
    "film": [
        (i, title, None, 2006, 1, None, days, Decimal(rate), 90, Decimal(cost), rating, NOW, ["Trailers"], [title.lower()])
        for i, title, days, rate, cost, rating in [
            (1, "ALPHA", 3, "2.00", "20.00", "G"),
            (2, "BETA", 5, "3.50", "15.00", "PG-13"),
            (3, "GAMMA", 1, "1.00", "10.00", "R"),
            (4, "DELTA", 2, "4.00", "12.00", None),
        ]
    ],
    "film_category": [(f, c, NOW) for f, c in [(1, 1), (2, 2), (3, 1), (4, 1), (4, 2)]],
    "actor": [(1, "SUSAN", "DAVIS", NOW), (2, "SUSAN", "DAVIS", NOW), (3, "TOM", "FOX", NOW), (4, "NO", "FILMS", NOW)],
    "film_actor": [(a, f, NOW) for a, f in [(1, 1), (1, 4), (2, 1), (2, 2), (3, 2), (3, 3)]],
    "inventory": [(i, f, s, NOW) for i, f, s in [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 4, 1), (5, 4, 2)]],
    "rental": [
        (i, _t(start), item, customer, _t(end), 1, NOW)
        for i, start, item, customer, end in [
            (1, "2022-01-10 10:00", 1, 1, "2022-01-13 10:00"),
            (2, "2022-02-01 00:00", 1, 2, "2022-02-05 12:00"),
            (3, "2022-02-02 00:00", 3, 1, "2022-02-18 00:00"),
            (4, "2022-03-01 00:00", 2, 2, None),
            (5, "2022-03-02 00:00", 4, 1, None),
            (6, "2022-03-05 00:00", 4, 2, None),
        ]
    ],
    "payment": [
        (i, customer, 1, rental, Decimal(amount), _t(at))
        for i, customer, rental, amount, at in [
            (1, 1, 1, "2.00", "2022-01-10 10:00"),
            (2, 2, 2, "3.00", "2022-02-01 00:00"),
            (3, 1, 3, "9.50", "2022-02-13 00:00"),
            (4, 2, 4, "2.00", "2022-03-01 00:00"),
            (5, 1, 5, "4.00", "2022-03-02 00:00"),
            (6, 1, 3, "1.00", "2022-09-01 00:00"),
            (7, 1, 3, "0.50", "2022-02-28 23:59:59"),
        ]
    ],
}


def rental_tables(spark) -> dict:
    return {name: spark.createDataFrame(data, rental_schema(name)) for name, data in ROWS.items()}
