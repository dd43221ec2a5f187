"""The positional index against a fresh look at the documents it should hold."""

from __future__ import annotations

import random
import re

import pytest
from rows import rows

from saltmill.operators import fulltext, text

STOPS = ["the", "of"]
WORDS = "the of fox foxes boxes running runner run jumped happily city cities class classes Übung glass x".split()


@pytest.fixture
def path(spark, tmp_path):
    root = str(tmp_path / "index")
    fulltext.create(spark, root, stop_words=STOPS, buckets=4)
    return root


def apply(spark, path, number, docs, gone=()):
    rows_ = [(i, t, False) for i, t in docs.items()] + [(i, None, True) for i in gone]
    df = spark.createDataFrame(rows_, "id long, body string, gone boolean")
    return fulltext.apply_batch(spark, path, number, df, "id", ["body"], gone="gone")


def stemmed(word):
    for pattern, keep in fulltext.STEM_RULES:
        word = re.sub(pattern, r"\1" + (keep if isinstance(keep, str) else ""), word)
    return re.sub(r"([bdfgmnprt])\1$", r"\1", word)


def tokens(body):
    found = [w for w in re.split(r"[^\w]+|_", (body or "").lower()) if w]
    return [(stemmed(w), i) for i, w in enumerate(found, 1) if w not in STOPS]


def state(spark, path):
    index = fulltext.Index(spark, path)
    live = index.live(index.postings()).select("token", "doc_id", "positions")
    return {(r["token"], r["doc_id"]): r["positions"] for r in live.collect()}


def fresh(docs):
    out = {}
    for i, body in docs.items():
        for token, place in tokens(body):
            out.setdefault((token, i), []).append(place)
    return out


def phrase(docs, query):
    asked = tokens(query)
    out = []
    for i, body in docs.items():
        have = set(tokens(body))
        shift = [(t, p - asked[0][1]) for t, p in asked]
        n = sum(all((t, s + p) in have for t, p in shift) for s in range(1 - asked[-1][1], 200))
        out += [(i, n)] if n else []
    return sorted(out)


def test_batches_equal_a_fresh_build(spark, path):
    """Adds, edits, deletes, a deleted document that comes back; merged or not."""
    rng = random.Random(1)

    def body():
        return " ".join(rng.choices(WORDS, k=rng.randrange(12)))

    docs = {}
    for number in range(1, 6):
        news = {rng.randrange(30): body() for _ in range(12)} | {100 + number: None}
        gone = [i for i in list(docs)[:3] if i not in news]
        apply(spark, path, number, news, gone)
        docs = {i: t for i, t in docs.items() if i not in gone} | news
        assert state(spark, path) == fresh(docs)
        if number in (3, 5):
            assert fulltext.merge(spark, path, at_most=2)
            assert state(spark, path) == fresh(docs)
    for query in ("fox running", "the fox", "run the city", "classes of glass", "fox fox"):
        assert sorted(rows(fulltext.phrase_search(spark, path, query))) == phrase(docs, query)
    found = {r[0] for r in fulltext.search(spark, path, "cities of the foxes").collect()}
    assert found == {i for i, b in docs.items() if {"city", "foxe"} <= {t for t, _ in tokens(b)}}


def test_a_repeated_batch_changes_nothing(spark, path):
    assert apply(spark, path, 1, {1: "fox"})
    assert not apply(spark, path, 1, {2: "fox"})
    assert state(spark, path) == fresh({1: "fox"})


def test_a_stop_before_the_manifest_leaves_the_old_state(spark, path, monkeypatch):
    """Segments without a manifest do not count, and the batch can run again."""
    apply(spark, path, 1, {1: "fox"})

    def stopped(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(fulltext, "_publish", stopped)
        with pytest.raises(RuntimeError):
            apply(spark, path, 2, {1: "city", 2: "run"})
        with pytest.raises(RuntimeError):
            fulltext.merge(spark, path, at_most=0)
    assert state(spark, path) == fresh({1: "fox"})
    assert apply(spark, path, 2, {1: "city", 2: "run"})
    assert state(spark, path) == fresh({1: "city", 2: "run"})


def test_a_merge_keeps_old_segments_and_drops_dead_postings(spark, path):
    for number in range(1, 6):
        apply(spark, path, number, {1: "fox " * number, number + 10: "run"})
    assert fulltext.merge(spark, path, at_most=4)
    index = fulltext.Index(spark, path)
    assert index.segments[0] == "batch-1" and len(index.segments) == 2
    merged = index.postings(index.segments[1:])
    assert rows(merged.where("doc_id = 1").select("version")) == [(5,)]
    assert not fulltext.merge(spark, path, at_most=4)


def test_queries_without_a_token_are_refused(spark, path):
    apply(spark, path, 1, {1: "the fox"})
    with pytest.raises(ValueError, match="stop words"):
        fulltext.search(spark, path, "the of")
    with pytest.raises(ValueError, match="no token"):
        fulltext.phrase_search(spark, path, " .,")
    assert rows(fulltext.search(spark, path, "the fox")) == [(1,)]


def test_an_empty_index_and_null_ids(spark, path):
    assert rows(fulltext.search(spark, path, "fox")) == []
    apply(spark, path, 1, {None: "fox", 1: ""})
    assert state(spark, path) == {}


def test_a_search_reads_the_buckets_of_its_tokens(spark, path):
    apply(spark, path, 1, {1: " ".join(WORDS)})
    plan = fulltext.search(spark, path, "fox")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*token_bucket", plan)


def test_a_hot_token_is_split_over_files(spark, path, conf):
    """A token in every document does not end in one file."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    df = spark.range(20_000).selectExpr("id", "concat('fox ', id) AS body")
    fulltext.apply_batch(spark, path, 1, df, "id", ["body"])
    files = fulltext.Index(spark, path).postings().where("token = 'fox'")
    assert files.selectExpr("input_file_name()").distinct().count() > 1
    assert fulltext.search(spark, path, "fox").count() == 20_000


def test_token_search_passes_over_stop_words(spark, tmp_path):
    df = spark.createDataFrame([(1, "the fox"), (2, "a city"), (3, "fox of the city")], "id long, body string")
    text.build_token_index(df, "id", ["body"], str(tmp_path / "t"), stop_words=["The", "of"])
    index = spark.read.parquet(str(tmp_path / "t"))
    assert rows(text.search_tokens(index, ["the fox"])) == [(1,), (3,)]
    assert rows(text.search_tokens(index, ["of", "city"])) == [(2,), (3,)]
    with pytest.raises(ValueError, match="stop words"):
        text.search_tokens(index, ["the"])


def test_stems_by_their_ends(spark):
    """Rules that are not tried would change nothing."""
    words = WORDS + "glasses flies apply only add adds butt bus us ss ly ing ed was this tied being zoo runningly übb".split()
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [(r["a"], r["b"]) for r in df.select(fulltext.stem(df["w"]).alias("a"), fulltext._stem_some(df["w"]).alias("b")).collect()]
    assert got == [(stemmed(w), stemmed(w)) for w in words]


def test_postings_are_made_per_document(spark, path):
    """No row per place is shuffled: a batch without repeated ids is cut into postings where it is read."""
    docs = spark.createDataFrame([(1, 1, "b a b the running runs"), (2, 1, ""), (3, 1, None)], "doc_id long, version long, text string")
    found = fulltext._postings(docs, fulltext.Index(spark, path), twice=False)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["token"], r["doc_id"]): r["positions"] for r in found.collect()}
    assert got == {("b", 1): [1, 3], ("a", 1): [2], ("run", 1): [5, 6]}


def test_a_document_twice_in_a_batch_has_one_posting(spark, path):
    df = spark.createDataFrame([(1, "fox x"), (1, "x fox")], "id long, body string")
    fulltext.apply_batch(spark, path, 1, df, "id", ["body"])
    assert state(spark, path) == {("fox", 1): [1, 2], ("x", 1): [1, 2]}


def test_live_postings_with_many_marks(spark, path, monkeypatch):
    apply(spark, path, 1, {1: "fox", 2: "boxes"})
    apply(spark, path, 2, {2: "x"}, gone=[1])
    monkeypatch.setattr(fulltext, "MANY_MARKS", 0)
    assert state(spark, path) == {("x", 2): [1]}
