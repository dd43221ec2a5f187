from __future__ import annotations

import re
from collections import Counter

import pytest
from rows import rows

from saltmill.operators import text


@pytest.fixture(scope="module")
def docs(spark):
    data = [
        (1, "The  cat sat\nnaïve WindowManager: on the mat "),
        (2, "cat_dog x1 42 éa The THE"),
        (3, ""),
    ]
    return spark.createDataFrame(data, "id long, text string")


def _python_lines(docs) -> list[str]:
    return [line for r in docs.collect() for line in r["text"].split("\n")]


def test_split_words_like_python(docs):
    want = Counter(w for line in _python_lines(docs) for w in line.split(" "))
    got = text.word_count(text.split_words(text.lines(docs, "text")))
    assert Counter({r["word"]: r["count"] for r in got.collect()}) == want
    assert want[""] == 3


def test_extract_words_like_python(spark, sf_dir, docs):
    pattern = re.compile(r"\b[A-Za-z]+\b")
    for df in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        want = Counter(w for line in _python_lines(df) for w in pattern.findall(line))
        got = text.word_count(text.extract_words(text.lines(df, "text")))
        assert Counter({r["word"]: r["count"] for r in got.collect()}) == want


def test_token_index_and_search(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    for _ in range(2):
        text.build_token_index(docs, "id", ["text"], path, stop_words=["on"])
    index = spark.read.parquet(path)
    assert index.where("token = 'the'").count() == 2
    assert index.where("token = 'on'").count() == 0
    assert rows(text.search_tokens(index, ["THE", "cat"])) == [(1,), (2,)]
    assert rows(text.search_tokens(index, ["the", "mat", "the"])) == [(1,)]
    assert rows(text.search_tokens(index, ["the", "absent"])) == []


@pytest.mark.parametrize("buckets", [None, 1, 64])
def test_search_takes_the_buckets_and_tokens_of_the_index(spark, tmp_path, buckets):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(1, "a well-known İstanbul"), (2, "known")], "id long, text string")
    text.build_token_index(docs, "id", ["text"], path, buckets=buckets)
    index = spark.read.parquet(path)
    assert rows(text.search_tokens(index, ["Well-Known"])) == [(1,)]
    assert rows(text.search_tokens(index, ["İstanbul", "known"])) == [(1,)]
    for nothing in ([], ["-"], [""]):
        with pytest.raises(ValueError, match="no token"):
            text.search_tokens(index, nothing)
    with pytest.raises(ValueError, match="token_buckets"):
        text.search_tokens(index.drop("token_buckets"), ["known"])


def test_search_reads_only_the_buckets_of_the_query(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    text.build_token_index(docs, "id", ["text"], path)
    found = text.search_tokens(spark.read.parquet(path), ["mat"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*token_bucket", plan)
