"""Streams over the test tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import RIDE_KEYS, payload_schema
from ..streaming import ingest, upsert
from .registry import Tables, query


@query("stream_kv", "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS value FROM events")
def stream_kv(t: Tables) -> DataFrame:
    """Binary key and value as text, as a message source delivers them."""
    events = ingest.table_stream(t.spark, t.sf_dir, "events")
    messages = events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("event_type").cast("binary").alias("value"),
    )
    out = t.scratch("stream-kv")
    q = (
        ingest.text_pairs(messages)
        .writeStream.format("parquet")
        .option("checkpointLocation", t.scratch("stream-kv-state"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return t.spark.read.schema("key STRING, value STRING").parquet(out)


_BROKEN = "event_type = 'error'"


@query(
    "stream_ingest",
    f"""SELECT 'good' AS state, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k, count(*) AS n
    FROM events WHERE NOT {_BROKEN} GROUP BY 2
    UNION ALL SELECT 'rejected', NULL, count(*) FROM events WHERE {_BROKEN}""",
)
def stream_ingest(t: Tables) -> DataFrame:
    """JSON texts of the events, those of errors with a brace too many: they go to the rejects."""
    events = ingest.table_stream(t.spark, t.sf_dir, "events")
    broken = F.concat(F.lit("{"), "props")
    texts = events.select(F.when(F.expr(_BROKEN), broken).otherwise(F.col("props")).alias("value"))
    out = t.scratch("ingest")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    ingest.ingest_stream(texts, schema, out, t.scratch("ingest-state")).awaitTermination()
    good, bad = ingest.ingested(t.spark, out, schema)
    counted = good.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("state"), "k", "n")
    return counted.unionAll(
        bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected"), F.lit(None).cast("int"), "n")
    )


def _payload(events: DataFrame) -> DataFrame:
    """Events as ride payloads: the type is the driver, so five drivers hold all rides."""

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    return events.select(
        F.struct(
            text("event_id").alias("ride_uuid"),
            text("user_id").alias("user_uuid"),
            F.col("event_type").alias("driver_uuid"),
            F.col("value").alias("distance"),
            (F.col("value") * 2).alias("price"),
        ).alias("ride"),
        F.struct(
            F.col("event_type").alias("driver_uuid"),
            F.concat(F.lit("driver "), text("event_id")).alias("name"),
            F.lit("d").alias("surname"),
            F.col("props").alias("car_uuid"),
            F.date_format("ts", "yyyy-MM-dd").alias("effective_from"),
            F.lit("2099-01-01").alias("expiry_date"),
        ).alias("driver"),
        F.struct(
            text("user_id").alias("user_uuid"),
            F.concat(F.lit("user "), text("event_id")).alias("name"),
            F.lit("u").alias("surname"),
            F.lit(False).alias("is_driver"),
        ).alias("user"),
        F.col("event_id").alias("seq"),
    )


@query(
    "payload_rides",
    """SELECT CAST(event_id AS VARCHAR) AS ride_uuid, CAST(user_id AS VARCHAR) AS user_uuid,
      event_type AS driver_uuid, value AS distance, value * 2 AS price, event_id AS seq FROM events""",
)
def payload_rides(t: Tables) -> DataFrame:
    return upsert.split_payload(_payload(t("events")), ["ride", "driver", "user"], "seq")["ride"]


@query(
    "latest_per_key",
    """SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
)
def latest_per_key(t: Tables) -> DataFrame:
    events = t("events").select("user_id", "event_type", "event_id", "value")
    return upsert.latest(events, ["user_id", "event_type"], "event_id")


@query(
    "stream_upsert",
    """SELECT 'driver' AS part, event_type AS id, 'driver ' || max(event_id) AS name FROM events GROUP BY event_type
    UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), 'user ' || max(event_id) FROM events GROUP BY user_id
    UNION ALL SELECT 'ride', CAST(event_id AS VARCHAR), event_type FROM events""",
)
def stream_upsert(t: Tables) -> DataFrame:
    """Payloads logged by a stream; drivers read after a compaction, users and rides without."""
    root = t.scratch("upsert")
    stream = _payload(ingest.table_stream(t.spark, t.sf_dir, "events"))
    upsert.log_changes(stream, root, t.scratch("upsert-state")).awaitTermination()
    schema = payload_schema()
    upsert.compact(t.spark, root, schema, "driver", [RIDE_KEYS["driver"]], "seq")
    out = []
    for part, name in (("driver", "name"), ("user", "name"), ("ride", "driver_uuid")):
        rows = upsert.current(t.spark, root, schema, part, [RIDE_KEYS[part]], "seq")
        out.append(
            rows.select(F.lit(part).alias("part"), F.col(RIDE_KEYS[part]).alias("id"), F.col(name).alias("name"))
        )
    return out[0].unionAll(out[1]).unionAll(out[2])


@query(
    "upsert_touch",
    """WITH stored AS (SELECT 'c' || c_custkey AS id, c_acctbal AS value FROM customer),
    news AS (
      SELECT 'c' || o_custkey AS id, arg_max(o_totalprice, o_orderkey) AS value, count(*) AS n
      FROM orders GROUP BY 1
      UNION ALL SELECT 's' || s_suppkey, s_acctbal, 1 FROM supplier)
    SELECT coalesce(s.id, w.id) AS id, coalesce(w.value, s.value) AS value,
      CASE WHEN w.id IS NULL THEN '2020-01-01' WHEN s.id IS NOT NULL OR w.n > 1 THEN '2030-01-01'
        ELSE '2025-01-01' END AS last_update
    FROM stored s FULL JOIN news w ON s.id = w.id""",
)
def upsert_touch(t: Tables) -> DataFrame:
    """Customers are stored; orders update them and suppliers come as new keys."""

    def day(text: str) -> Column:
        return F.lit(text).cast("date").alias("last_update")

    stored = t("customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_acctbal").alias("value"), day("2020-01-01")
    )
    orders = t("orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("id"),
        F.col("o_totalprice").alias("value"),
        day("2025-01-01"),
        F.col("o_orderkey").alias("seq"),
    )
    suppliers = t("supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("id"),
        F.col("s_acctbal").alias("value"),
        day("2025-01-01"),
        F.col("s_suppkey").alias("seq"),
    )
    as_of = F.lit("2030-01-01").cast("date")
    merged = upsert.merge_touch(stored, orders.unionAll(suppliers), ["id"], "seq", "last_update", as_of)
    return merged.withColumn("last_update", F.col("last_update").cast("string"))
