from __future__ import annotations

from types import SimpleNamespace

import pytest

from saltmill import session


def _session(master: str, folder: str | None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_below_the_shared_folder():
    got = session.scratch(_session("spark://x", "hdfs://n/ck/"), "job")
    assert got.startswith("hdfs://n/ck/job-")
    assert got != session.scratch(_session("spark://x", "hdfs://n/ck/"), "job")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.scratch(_session("spark://x", None), "job")


def test_a_local_session_falls_back_to_a_temporary_folder():
    first, second = (session.scratch(_session("local[2]", None), "job") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_materialize_keeps_rows_and_types(spark):
    df = spark.range(5).selectExpr("id", "struct(id) AS s", "CAST(id AS DECIMAL(5,2)) AS d")
    got = session.materialize(df, "t")
    assert [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in df.schema]
    assert got.exceptAll(df).isEmpty() and got.count() == 5


def test_tuned_session(spark):
    for key, value in session.SETTINGS.items():
        assert spark.conf.get(key) == value
