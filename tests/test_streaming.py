from __future__ import annotations

import json
import os
from pathlib import Path

import feeds
import pytest
from rows import rows
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F, types as T

from saltmill.schemas import RIDE_KEYS, payload_schema
from saltmill.sources import files, paged
from saltmill.streaming import ingest, upsert

register_pickle_by_value(feeds)

PARTS = ["ride", "driver", "user"]


def log_schema() -> T.StructType:
    return payload_schema()


def _payload(seq: int, ride: str, driver: str, user: str, price: float = 1.0) -> dict:
    return {
        "ride": {"ride_uuid": ride, "user_uuid": user, "driver_uuid": driver, "distance": 2.0, "price": price},
        "driver": {"driver_uuid": driver, "name": f"d{seq}", "surname": "s", "car_uuid": "c",
                   "effective_from": "2022-01-01", "expiry_date": "2023-01-01"},
        "user": {"user_uuid": user, "name": f"u{seq}", "surname": "s", "is_driver": False},
        "seq": seq,
    }


class Feed:
    """A landing folder with one JSON file per poll."""

    def __init__(self, spark, base):
        self.spark, self.base, self.polls = spark, str(base), 0
        os.makedirs(f"{self.base}/in")

    def poll(self, *payloads: dict) -> None:
        self.polls += 1
        with open(f"{self.base}/in/{self.polls}.json", "w") as f:
            f.writelines(json.dumps(p) + "\n" for p in payloads)

    def run(self, checkpoint: str = "state") -> None:
        stream = self.spark.readStream.schema(log_schema()).option("maxFilesPerTrigger", 1).json(f"{self.base}/in")
        upsert.log_changes(stream, f"{self.base}/log", f"{self.base}/{checkpoint}").awaitTermination()

    def now(self, part: str) -> list[tuple]:
        got = upsert.current(self.spark, f"{self.base}/log", log_schema(), part, [RIDE_KEYS[part]], "seq")
        return rows(got.select(RIDE_KEYS[part], "price" if part == "ride" else "name"))

    def compact(self, part: str):
        return upsert.compact(self.spark, f"{self.base}/log", log_schema(), part, [RIDE_KEYS[part]], "seq")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_last_write_wins_within_and_across_batches(feed):
    feed.poll(_payload(1, "r1", "d1", "u1"), _payload(2, "r1", "d2", "u1", price=5.0))
    feed.poll(_payload(3, "r2", "d1", "u1"))
    feed.run()
    assert feed.now("ride") == [("r1", 5.0), ("r2", 1.0)]
    assert feed.now("driver") == [("d1", "d3"), ("d2", "d2")]
    assert feed.now("user") == [("u1", "u3")]


def test_replay_of_all_batches_changes_nothing(feed):
    feed.poll(_payload(1, "r1", "d1", "u1"))
    feed.poll(_payload(2, "r1", "d1", "u2", price=7.0))
    feed.run("state")
    before = {p: feed.now(p) for p in PARTS}
    feed.run("second-state")
    assert {p: feed.now(p) for p in PARTS} == before


def test_late_arrival_of_an_older_write_is_ignored(feed):
    feed.poll(_payload(9, "r1", "d1", "u1", price=9.0))
    feed.poll(_payload(3, "r1", "d1", "u1", price=3.0))
    feed.run()
    assert feed.now("ride") == [("r1", 9.0)]


def test_compaction_keeps_the_view_and_skips_old_batches(feed, spark):
    feed.poll(_payload(1, "r1", "d1", "u1"), _payload(2, "r2", "d1", "u1"))
    feed.run()
    before = feed.now("ride")
    assert feed.compact("ride") == 0
    assert feed.now("ride") == before
    feed.poll(_payload(5, "r1", "d1", "u1", price=8.0))
    feed.run()
    assert feed.now("ride") == [("r1", 8.0), ("r2", 1.0)]
    assert feed.compact("ride") == 1 and feed.compact("ride") == 1
    assert feed.now("ride") == [("r1", 8.0), ("r2", 1.0)]
    assert upsert.newest_snapshot(spark, f"{feed.base}/log", "driver") is None


def test_half_written_snapshot_is_not_used(feed, spark):
    feed.poll(_payload(1, "r1", "d1", "u1"))
    feed.run()
    os.makedirs(f"{feed.base}/log/snapshots/ride/upto=7")
    assert upsert.newest_snapshot(spark, f"{feed.base}/log", "ride") is None
    assert feed.now("ride") == [("r1", 1.0)]


def test_half_written_batch_is_replaced(feed, spark):
    feed.poll(_payload(1, "r1", "d1", "u1"))
    part = f"{feed.base}/log/changes/batch_id=0"
    half = spark.createDataFrame([_payload(1, "r1", "d1", "u1"), _payload(8, "x", "x", "x")], log_schema())
    half.write.parquet(f"{part}/rejected=false")
    os.remove(f"{part}/rejected=false/_SUCCESS")
    feed.run()
    assert feed.now("ride") == [("r1", 1.0)]


def test_unfinished_batch_is_not_read(feed, spark):
    feed.poll(_payload(1, "r1", "d1", "u1"))
    feed.run()
    half = spark.createDataFrame([_payload(8, "x", "x", "x")], log_schema())
    half.write.parquet(f"{feed.base}/log/changes/batch_id=1/rejected=false")
    assert feed.now("ride") == [("r1", 1.0)] and feed.compact("ride") == 0
    assert feed.now("ride") == [("r1", 1.0)]


def test_trim_keeps_what_readers_need(feed, spark):
    log = f"{feed.base}/log"
    for i in range(3):
        feed.poll(_payload(i, f"r{i}", "d1", "u1"))
        feed.run()
        feed.compact("ride")
    before = {p: feed.now(p) for p in PARTS}
    assert upsert.trim(spark, log, ["ride", "driver"], 0) == []
    feed.compact("driver")
    feed.compact("user")
    feed.poll(_payload(9, "r9", "d9", "u9"))
    feed.run()
    assert upsert.trim(spark, log, list(PARTS), 3600) == []
    gone = upsert.trim(spark, log, list(PARTS), -1)
    assert sorted(os.listdir(f"{log}/changes")) == ["batch_id=3"] and len(gone) == 5
    assert os.listdir(f"{log}/snapshots/ride") == ["upto=2"]
    assert {p: [r for r in feed.now(p) if r[0] not in ("r9", "d9", "u9")] for p in PARTS} == before


def test_current_of_an_empty_log(feed):
    assert feed.now("ride") == [] and feed.compact("ride") is None


def test_current_reads_only_its_part(feed, spark):
    feed.poll(_payload(1, "r1", "d1", "u1"))
    feed.run()
    got = upsert.current(spark, f"{feed.base}/log", log_schema(), "user", ["user_uuid"], "seq")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "distance" not in plan and "WindowGroupLimit" in plan


def test_ties_go_to_one_row_for_every_partitioning(spark):
    df = spark.createDataFrame([("k", 1, v) for v in "abcdef"], "id string, seq int, v string")
    got = {upsert.latest(df.repartition(n), ["id"], "seq").first()["v"] for n in (1, 2, 5)}
    assert len(got) == 1


def test_payload_without_a_part_changes_no_table(feed, spark):
    whole, half = _payload(1, "r1", "d1", "u1"), _payload(2, "r2", "d2", "u2")
    del half["driver"]
    feed.poll(whole, half, {**_payload(3, "r3", "d3", "u3"), "user": None})
    texts = spark.readStream.schema("value string").text(f"{feed.base}/in")
    parsed = ingest.parse_values(texts, log_schema())
    upsert.log_changes(parsed, f"{feed.base}/log", f"{feed.base}/state").awaitTermination()
    assert feed.now("ride") == [("r1", 1.0)] and feed.now("user") == [("u1", "u1")]
    _, rejects = ingest.ingested(spark, f"{feed.base}/log/changes", log_schema())
    assert sorted(json.loads(r["value"])["seq"] for r in rejects.collect()) == [2, 3]


@pytest.mark.parametrize(
    "stored, updates, want",
    [
        ([("a", "t0")], [], [("a", "t0")]),
        ([("a", "t0")], [("a", None, 1)], [("a", "now")]),
        ([("a", "t0")], [("a", "t1", 1)], [("a", "now")]),
        ([], [("b", "t1", 1)], [("b", "t1")]),
        ([], [("b", None, 1)], [("b", "now")]),
        ([], [("b", "t1", 1), ("b", "t2", 2)], [("b", "now")]),
        ([(None, "t0")], [("a", "t1", 1)], [("a", "t1"), (None, "t0")]),
    ],
)
def test_merge_touch(spark, stored, updates, want):
    old = spark.createDataFrame(stored, "id string, last_update string")
    new = spark.createDataFrame(updates, "id string, last_update string, seq int")
    got = upsert.merge_touch(old, new, ["id"], "seq", "last_update", F.lit("now"))
    assert got.columns == ["id", "last_update"]
    assert rows(got) == sorted(want, key=repr)


# ---- ingest ----------------------------------------------------------------


def test_bad_records_go_to_the_rejects(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "1.txt").write_text('{"k": 1}\n{"k": \nnot json\n{"other": 2}\n{"k": "x"}\n{"k": 3}\n')
    stream = spark.readStream.schema("value string").text(str(tmp_path / "in"))
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    out = str(tmp_path / "out")
    for state in ("a", "b"):
        ingest.ingest_stream(stream, schema, out, str(tmp_path / state)).awaitTermination()
    good, bad = ingest.ingested(spark, out, schema)
    assert rows(good) == [(1,), (3,)]
    assert sorted(r["value"] for r in bad.collect()) == sorted(["not json", '{"k": ', '{"k": "x"}', '{"other": 2}'])


def test_polling_ingest_picks_up_new_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "1.txt").write_text('{"k": 1}\n')
    stream = spark.readStream.schema("value string").text(str(tmp_path / "in"))
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    q = ingest.ingest_stream(stream, schema, str(tmp_path / "out"), str(tmp_path / "state"), every="1 second")
    try:
        assert q.isActive and stream.isStreaming
        q.processAllAvailable()
        (tmp_path / "in" / "2.txt").write_text('{"k": 2}\n')
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(ingest.ingested(spark, str(tmp_path / "out"), schema)[0]) == [(1,), (2,)]


def test_text_pairs(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray("é".encode())), (None, bytearray(b"v"))], "key binary, value binary")
    assert rows(ingest.text_pairs(df)) == sorted([("k", "é"), (None, "v")], key=repr)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        files.read_kafka(spark, "localhost:9092", "topic")


# ---- paged feed as a stream --------------------------------------------------


def _pages(sizes, date):
    """Pages of the given sizes; a row names its date, page and place."""
    return [[{"name": f"{date}/{p}/{i}"} for i in range(n)] for p, n in enumerate(sizes, 1)]


def _land(spark, fetch, feed, out, state, **settings):
    stream = paged.stream_paged(spark, fetch, sorted(feed), "name STRING", json.dumps(feed), **settings)
    ingest.land_batches(stream, out, state).awaitTermination()
    return sorted(r[0] for r in spark.read.schema("name STRING").parquet(out).collect())


def _names(feed):
    return sorted(r["name"] for pages in feed.values() for page in pages for r in page)


@pytest.mark.parametrize("fetch", [feeds.memory, feeds.empty_list_at_end, feeds.Counted()])
def test_paged_stream_goes_on_where_it_stopped(spark, tmp_path, fetch):
    """Pages and dates added between runs are read once; a run without news adds nothing."""
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    a, b, c = "2024-01-01", "2024-01-02", "2024-01-03"
    feed = {a: _pages([3], a), b: []}
    assert _land(spark, fetch, feed, out, state) == _names(feed)
    feed = {a: _pages([3, 2, 1, 4, 1, 1], a), b: _pages([1], b), c: _pages([2] * 13, c)}
    assert _land(spark, fetch, feed, out, state, pages_per_task=3) == _names(feed)
    assert _land(spark, fetch, feed, out, state) == _names(feed)


def test_paged_stream_replays_a_batch_that_was_not_committed(spark, tmp_path):
    """A stop between the write and the commit: the batch runs again over the same pages."""
    out, state, day = f"{tmp_path}/out", f"{tmp_path}/state", "2024-01-01"
    feed = {day: _pages([2, 2, 3], day)}
    _land(spark, feeds.memory, feed, out, state)
    commits = sorted(Path(f"{state}/commits").glob("[0-9]*"))
    for path in [commits[-1], Path(f"{state}/commits/.{commits[-1].name}.crc")]:
        path.unlink(missing_ok=True)
    grown = {day: _pages([2, 2, 3, 1], day)}
    assert _land(spark, feeds.memory, grown, out, state)[:7] == _names(feed)
    # News that came in between is taken at the latest by the run after the replay.
    assert _land(spark, feeds.memory, grown, out, state) == _names(grown)


def test_paged_stream_fails_at_a_page_that_is_gone(spark, tmp_path):
    day = "2024-01-01"
    feed = {day: _pages([1, 1], day)}
    with pytest.raises(Exception, match="is gone"):
        _land(spark, feeds.gone_page, feed, f"{tmp_path}/out", f"{tmp_path}/state")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100])
@pytest.mark.parametrize("known", [0, 1])
def test_probing_finds_the_last_page(n, known):
    asked = []

    def fetch(root, date, page):
        asked.append(page)
        return [{"name": "x"}] if page <= n else None

    reader = paged.PagedStreamReader(fetch, T.StructType.fromDDL("name STRING"), {"dates": "d"})
    assert reader._count("d", min(known, n)) == n
    assert len(asked) <= 2 * (n + 2).bit_length() + 1
