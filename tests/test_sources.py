"""Files, the raw-to-staged jobs, the paged feed and the monthly store."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal
from types import SimpleNamespace

import feeds
import pytest
from rows import rows
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F, types as T

from saltmill import schemas
from saltmill.schemas import SALES_DDL, sales_schema
from saltmill.sources import files, paged, paths, sinks

# The workers have no copy of the test folder.
register_pickle_by_value(feeds)

SALE = {"client": "A", "purchase_date": "2022-08-09", "product": "tv", "price": 10}


@pytest.fixture
def base(tmp_path) -> str:
    return str(tmp_path)


def _write(path, content) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=4))


# ---- files -----------------------------------------------------------------


def test_csv_binds_by_position(spark, base):
    _write(f"{base}/o.csv", 'no,yr,award,movie\n1,1928,best,"A, B"\nx,1929,best,C\n')
    got = files.read_csv(spark, base, "id INT, year STRING, age INT")
    assert rows(got) == sorted([(1, "1928", None), (None, "1929", None)], key=repr)


def test_csv_strict_compares_the_header(spark, base):
    _write(f"{base}/o.csv", "no,yr\n1,1928\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, base, "id INT, year STRING", strict=True).collect()
    assert rows(files.read_csv(spark, base, "no INT, yr STRING", strict=True)) == [(1, "1928")]


def test_csv_typed_sets_bad_rows_apart(spark, base):
    _write(f"{base}/o.csv", "id,age\n1,20\n2,old\n3,\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("age", T.IntegerType())])
    good, bad = files.read_csv_typed(spark, base, schema)
    assert rows(good) == [(1, 20), (3, None)]
    assert rows(bad) == [("2", "old", None)]


def test_csv_typed_rejects_short_and_long_lines(spark, base):
    _write(f"{base}/o.csv", 'id,age\n3\n4,5,6\n7,8\n"9","1,0"\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("age", T.IntegerType())])
    good, bad = files.read_csv_typed(spark, base, schema)
    assert rows(good) == [(7, 8)]
    assert {r["_record"] for r in bad.collect()} == {"3", "4,5,6", None}


def test_lists_of_a_dump(spark, base):
    head = "film_id,title,special_features"
    lists = ["{}", '"{""x, y"",z}"', '"{a,b c}"', '"{""say \\""hi\\""""}"', ""]
    _write(f"{base}/film.csv", "\n".join([head, *[f"{i},t,{x}" for i, x in enumerate(lists)]]) + "\n")
    read = files.read_csv(spark, base, "film_id INT, title STRING, special_features STRING", escape='"')
    got = read.select("film_id", files.list_items(F.col("special_features")).alias("x")).collect()
    assert {r["film_id"]: r["x"] for r in got} == {
        0: [], 1: ["x, y", "z"], 2: ["a", "b c"], 3: ['say "hi"'], 4: None,
    }


def test_raw_read_sees_what_is_no_record(spark, base):
    _write(f"{base}/raw/1.json", [SALE, SALE])
    with pytest.raises(Exception, match="not a JSON record"):
        files.read_raw(spark, f"{base}/raw", SALES_DDL).collect()
    _, rejects = files.read_raw_checked(spark, f"{base}/raw", SALES_DDL)
    assert rejects.count() > 2
    assert files.read_raw(spark, f"{base}/raw", SALES_DDL, indented=True).count() == 2
    with open(f"{base}/raw/1.json", "w") as f:
        f.write(json.dumps(SALE) + "\n" + json.dumps([SALE, SALE]) + '\n{"client": 1, "pri\n')
    good, bad = files.read_raw_checked(spark, f"{base}/raw", SALES_DDL)
    assert good.count() == 3 and [r["_record"] for r in bad.collect()] == ['{"client": 1, "pri']


def test_csv_quoted_comma_and_inference(spark, base):
    _write(f"{base}/o.csv", 'movie,at\n"Lost, Found",2022-02-15 09:34:33.000000 +00:00\n')
    df = spark.read.csv(base, header=True, inferSchema=True)
    assert df.schema["at"].dataType == T.TimestampType()
    assert df.first()["movie"] == "Lost, Found"


def test_rental_dumps_in_declared_types(spark, base):
    at = "2022-02-15 10:02:19.000000 +00:00"
    _write(f"{base}/language.csv", f"language_id,name,last_update\n1,English             ,{at}\n")
    language = files.read_rental_csv(spark, f"{base}/language.csv", "language").first()
    assert tuple(language) == (1, "English", dt.datetime(2022, 2, 15, 10, 2, 19))
    head = "staff_id,first_name,last_name,address_id,email,store_id,active,username,password,last_update,picture"
    _write(f"{base}/staff.csv", f"{head}\n1,A,B,3,,1,true,a,,{at},0x8950\n2,C,D,4,,2,false,c,,{at},\n")
    staff = files.read_rental_csv(spark, f"{base}/staff.csv", "staff").orderBy("staff_id").collect()
    assert [(r["active"], r["email"], r["picture"]) for r in staff] == [
        (True, None, bytearray(b"\x89P")), (False, None, None)
    ]
    head = ",".join(schemas.rental_schema("film").fieldNames())
    row = f'1,T,D,2006,1,,6,0.99,86,20.99,PG,{at},"{{Trailers,""Deleted Scenes""}}","\'cat\':1 \'dog\':2,4"'
    _write(f"{base}/film.csv", f"{head}\n{row}\n")
    film = files.read_rental_csv(spark, f"{base}/film.csv", "film").first()
    assert film["special_features"] == ["Trailers", "Deleted Scenes"] and film["fulltext"] == ["cat", "dog"]
    assert film["rental_rate"] == Decimal("0.99") and film["original_language_id"] is None


def test_jdbc_passes_the_strides_on():
    calls = {}
    fake = SimpleNamespace(read=SimpleNamespace(jdbc=lambda **kw: calls.update(kw)))
    files.read_jdbc(fake, "jdbc:x", "t", "id", 1, 100_000, 10, {"user": "u"})
    assert calls == {
        "url": "jdbc:x", "table": "t", "column": "id", "lowerBound": 1, "upperBound": 100_000,
        "numPartitions": 10, "properties": {"user": "u"},
    }


def test_nested_json_files(spark, base):
    for i, city in ((1, "Kyiv"), (2, "Lviv")):
        _write(f"{base}/{i}.json", [{"id": i, "name": "n", "details": {"age": 3, "address": {"city": city, "state": "s"}}}])
    schema = "id INT, name STRING, details STRUCT<age: INT, address: STRUCT<city: STRING, state: STRING>>"
    got = files.read_json(spark, f"{base}/*.json", schema)
    assert rows(got.select("id", "details.address.city")) == [(1, "Kyiv"), (2, "Lviv")]


def test_json_arrays_are_bounded_and_whole(spark, base):
    df = spark.range(0, 1000, 1, 3).withColumn("t", F.lit("é"))
    sinks.write_json_arrays(df, f"{base}/a", per_file=100)
    assert rows(files.read_json(spark, f"{base}/a", df.schema).select("id", "t")) == rows(df)
    sizes = files.read_json(spark, f"{base}/a", df.schema).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100


# ---- raw folder ------------------------------------------------------------


def test_land_makes_nested_folders(spark, base):
    df = spark.createDataFrame([(1, "tv", 5)], "id int, product string, amount int")
    target = sinks.land(df, base, "raw/sales/2022-08-09")
    assert target == f"{base}/raw/sales/2022-08-09"
    assert rows(spark.read.schema(df.schema).json(target)) == [(1, "tv", 5)]


def test_land_replaces_the_folder(spark, base):
    for n in (3, 1):
        sinks.land(spark.range(n), base, "raw/x")
    assert spark.read.json(f"{base}/raw/x").count() == 1
    assert os.listdir(f"{base}/raw") == ["x"]


def test_land_strips_slashes_and_refuses_parent(spark, base):
    assert sinks.land(spark.range(1), base, "/raw/x/") == f"{base}/raw/x"
    for path in ("../x", "a/../../x", "", "/"):
        with pytest.raises(ValueError):
            sinks.land(spark.range(1), base, path)


def test_land_keeps_unicode(spark, base):
    df = spark.createDataFrame([(1, "Тест")], "id int, unicode string")
    target = sinks.land(df, base, "raw/u")
    text = "".join(r["value"] for r in spark.read.text(target).collect())
    assert "Тест" in text


def test_land_without_rows_keeps_the_old_folder(spark, base):
    sinks.land(spark.range(2), base, "raw/x")
    with pytest.raises(ValueError):
        sinks.land(spark.range(0), base, "raw/x")
    assert spark.read.json(f"{base}/raw/x").count() == 2
    sinks.land(spark.range(0), base, "raw/x", allow_empty=True)
    assert spark.read.schema("id long").json(f"{base}/raw/x").count() == 0


def test_land_reads_its_input_once(spark, base):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        seen.add(1)
        yield from batches

    sinks.land(spark.range(0, 5, 1, 1).mapInArrow(watched, "id long"), base, "raw/x")
    assert seen.value == 1


def test_a_stop_between_the_renames_is_repaired(spark, base):
    sinks.land(spark.range(2), base, "raw/x")
    os.rename(f"{base}/raw/x", f"{base}/raw/x__old-1")
    os.makedirs(f"{base}/raw/x__new-1")
    paths.repair_dir(spark, f"{base}/raw/x")
    assert os.listdir(f"{base}/raw") == ["x"] and spark.read.json(f"{base}/raw/x").count() == 2
    os.rename(f"{base}/raw/x", f"{base}/raw/x__old-2")
    with pytest.raises(ValueError, match="no rows"):
        sinks.land(spark.range(0), base, "raw/x")
    assert os.listdir(f"{base}/raw") == ["x"] and spark.read.json(f"{base}/raw/x").count() == 2


# ---- staged folder ---------------------------------------------------------


def _stage(spark, base, indented=True):
    return sinks.stage(spark, base, "raw/s", "stg/s/", sales_schema(), indented=indented)


def test_stage_missing_source(spark, base):
    with pytest.raises(FileNotFoundError):
        _stage(spark, base)


@pytest.mark.parametrize("n_files, per_file", [(1, 1), (2, 1), (3, 1), (3, 2)])
def test_stage_reads_every_file(spark, base, n_files, per_file):
    for i in range(n_files):
        _write(f"{base}/raw/s/{i}.json", [{**SALE, "price": i}] * per_file)
    _write(f"{base}/raw/s/notes.txt", "not json")
    _write(f"{base}/raw/s/below/9.json", [SALE])
    staged = spark.read.parquet(_stage(spark, base))
    assert staged.columns == sales_schema().fieldNames()
    assert staged.schema["price"].dataType == T.IntegerType()
    assert staged.count() == n_files * per_file


def test_stage_sets_rejects_apart(spark, base):
    os.makedirs(f"{base}/raw/s")
    with open(f"{base}/raw/s/1.json", "w") as f:
        f.write(json.dumps(SALE) + '\n{"client": "B"}\n{"client": 1, "pri\n')
    with pytest.raises(Exception):
        _stage(spark, base, indented=False)
    target = sinks.stage(spark, base, "raw/s", "stg/s", sales_schema(), rejects_dir="bad/s")
    assert spark.read.parquet(target).count() == 1
    bad = spark.read.schema("client STRING, _record STRING").json(f"{base}/bad/s")
    assert rows(bad) == sorted([("B", None), (None, '{"client": 1, "pri')], key=repr)


def test_stage_empty_folder_writes_no_rows(spark, base):
    os.makedirs(f"{base}/raw/s")
    assert spark.read.parquet(_stage(spark, base)).count() == 0


def test_stage_replaces_the_target(spark, base):
    _write(f"{base}/raw/s/1.json", [SALE, SALE])
    _stage(spark, base)
    _write(f"{base}/raw/s/1.json", [SALE])
    assert spark.read.parquet(_stage(spark, base)).count() == 1


def test_stage_failure_keeps_the_old_target(spark, base):
    _write(f"{base}/raw/s/1.json", [SALE])
    target = _stage(spark, base)
    _write(f"{base}/raw/s/2.json", [{"client": "B"}])
    with pytest.raises(Exception, match="required field"):
        _stage(spark, base)
    assert spark.read.parquet(target).count() == 1
    assert os.listdir(f"{base}/stg") == ["s"]


def test_land_then_stage(spark, base):
    sinks.land(spark.createDataFrame([SALE]), base, "raw/s")
    assert rows(spark.read.parquet(_stage(spark, base, indented=False))) == [("A", "2022-08-09", "tv", 10)]


def test_stage_avro_if_installed(spark, base):
    _write(f"{base}/raw/s/1.json", [SALE])
    try:
        target = sinks.stage(spark, base, "raw/s", "stg/a", sales_schema(), fmt="avro", indented=True)
    except Exception as e:
        if "avro" in str(e).lower():
            pytest.skip("the avro module is not on the classpath")
        raise
    assert spark.read.format("avro").load(target).count() == 1


def test_under_joins_below_the_base():
    assert paths.under("/b/", "/x//y/") == "/b/x/y"


# ---- paged feed ------------------------------------------------------------


def _rec(i: int) -> dict:
    return {"id": i, "product": "p", "amount": i * 10}


def _feed(spark, fetcher, pages: dict, **options):
    return paged.read_paged(
        spark, fetcher, list(pages), "id INT, product STRING, amount INT", root=json.dumps(pages), **options
    )


@pytest.mark.parametrize("lanes", [1, 2, 5])
@pytest.mark.parametrize("tasks", [0, 1, 3])
def test_pages_are_all_read(spark, lanes, tasks):
    pages = {"2022-08-09": [[_rec(1), _rec(2)], [_rec(3)], [_rec(4)]], "2022-08-10": [[_rec(5)]], "2022-08-11": []}
    got = _feed(spark, feeds.memory, pages, lanes=lanes, tasks=tasks)
    assert rows(got) == [(i, "p", i * 10) for i in range(1, 6)]


def test_feed_to_raw_to_staged(spark, base):
    day = "2022-08-09"
    pages = {day: [[{**SALE, "price": 1}, {**SALE, "price": 2}], [{**SALE, "client": "Ї", "price": 3}]]}
    sales = paged.read_paged(spark, feeds.memory, [day], SALES_DDL.replace(" NOT NULL", ""), root=json.dumps(pages))
    sinks.land(sales, base, f"raw/sales/{day}")
    staged = sinks.stage(spark, base, f"raw/sales/{day}", f"stg/sales/{day}", sales_schema())
    assert rows(spark.read.parquet(staged).select("client", "price")) == [("A", 1), ("A", 2), ("Ї", 3)]


def test_empty_list_ends_a_date(spark):
    assert _feed(spark, feeds.empty_list_at_end, {"2022-08-09": [[_rec(1)]]}).count() == 1
    assert _feed(spark, feeds.empty_list_at_end, {"2022-08-09": [[_rec(1)], [], [_rec(2)]]}).count() == 1


@pytest.mark.parametrize("lanes", [1, 2, 3, 4])
def test_lanes_do_not_change_the_rows(spark, lanes):
    pages = {"2022-08-09": [[_rec(1)], [], [_rec(2)], [_rec(3)]], "2022-08-10": [[_rec(4)], [_rec(5)]]}
    got = _feed(spark, feeds.empty_list_at_end, pages, lanes=lanes)
    assert rows(got) == [(i, "p", i * 10) for i in (1, 4, 5)]


def test_no_dates(spark):
    assert _feed(spark, feeds.memory, {}).count() == 0


def test_page_error_fails_or_stops(spark):
    pages = {"2022-08-09": [[_rec(1)], [_rec(2)]]}
    with pytest.raises(Exception, match="status 500"):
        _feed(spark, feeds.broken_second_page, pages).collect()
    assert rows(_feed(spark, feeds.broken_second_page, pages, on_error="stop")) == [(1, "p", 10)]
    pages["2022-08-09"].append([_rec(3)])
    got = _feed(spark, feeds.broken_second_page, pages, on_error="stop", lanes=2)
    assert rows(got) == [(1, "p", 10)]


# ---- monthly store ---------------------------------------------------------


@pytest.fixture
def payments(spark):
    data = [
        (1, dt.datetime(2022, 1, 1), Decimal("1.00")),
        (2, dt.datetime(2022, 1, 31, 23, 59, 59), Decimal("2.00")),
        (3, dt.datetime(2022, 2, 1), Decimal("3.00")),
        (4, dt.datetime(2022, 7, 31, 23, 59, 59), Decimal("4.00")),
        (5, dt.datetime(2022, 8, 1), Decimal("5.00")),
        (6, dt.datetime(2021, 12, 31), Decimal("6.00")),
        (7, None, Decimal("7.00")),
    ]
    return spark.createDataFrame(data, "payment_id int, payment_date timestamp, amount decimal(5,2)")


def test_months_stored_and_rejected(spark, base, payments):
    rejected = sinks.write_monthly(payments, "payment_date", base, "2022-01", "2022-07")
    assert rows(rejected.select("payment_id")) == [(5,), (6,), (7,)]
    assert sorted(d for d in os.listdir(base) if d.startswith("month")) == [
        "month=2022-01", "month=2022-02", "month=2022-07"
    ]


def test_only_months_present_are_replaced(spark, base, payments):
    sinks.write_monthly(payments, "payment_date", base, "2022-01", "2022-07")
    sinks.write_monthly(payments.where("payment_id = 1"), "payment_date", base, "2022-01", "2022-07")
    assert rows(spark.read.parquet(base).select("payment_id")) == [(1,), (3,), (4,)]


def test_read_monthly_prunes_folders(spark, base, payments):
    sinks.write_monthly(payments, "payment_date", base, "2022-01", "2022-07")
    got = sinks.read_monthly(
        spark, base, payments.schema, "payment_date", dt.date(2022, 1, 31), dt.date(2022, 7, 1)
    )
    assert rows(got.select("payment_id")) == [(2,), (3,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(payment_date)" in plan
