"""The filter audit against plain Python."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest

import fixtures
from rows import rows
from saltmill.llm import common, filter_audit

METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: str, doc_id, first) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc_id is not None and first is not None and first < doc_id,
    }
    return {letter for letter, fails in tests.items() if fails}


def brute(docs, labels):
    """(part, order, step) to the numbers of the contract, document by document."""
    first = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    flags = defaultdict(lambda: [False, False])
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            flags[doc_id][0] |= quality == 1
            flags[doc_id][1] |= toxic == 1
    parts = defaultdict(list)
    for doc_id, text, lang, *_ in docs:
        good, toxic = flags[doc_id] if doc_id in flags else (False, False)
        parts[lang or ""].append((failures(text or "", doc_id, first.get(text or "")), good, toxic))
    out = {}
    for part, members in parts.items():
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [m for m in members if letter in m[0] and not m[0] & before]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    sum(not m[0] & (before | {letter}) for m in members),
                    len(gone),
                    sum(letter in m[0] and bool(m[0] & before) for m in members),
                    sum(m[0] == {letter} for m in members),
                    sum(m[1] for m in gone),
                    sum(m[2] for m in gone),
                ]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                out[part, "".join(order), step].append(total[letter])
    return out


def awkward():
    """Texts at the border of each filter beside the usual awkward rows."""
    words = [f"w{i}" for i in range(100)]
    docs = [(d + (None,))[:3] for d in fixtures.awkward()]
    return docs + [
        (20, " ".join(words * 2), "en"),
        (21, " ".join(words * 2 + ["w1"]), "en"),
        (22, " ".join(words + words[:99]), "en"),
        (23, "A" * 3 + "b" * 97, "en"),
        (24, "A" * 4 + "b" * 96, "en"),
        (25, "é" * 97 + "A" * 3, ""),
        (26, "a | b", ""),
        (27, "a\xa0b\x1cc", "en"),
        (-5, "one", "fr"),
        (20, " ".join(words * 2), "de"),
        (None, "ONE", "fr"),
    ]


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (9, None, 1), (20, 1, 1), (None, 1, 1), (99, 1, 1)]


def labels_table(spark, found=LABELS):
    """Labels with columns named as the operator's own."""
    return spark.createDataFrame(
        [(*r, "x", 1) for r in found], "doc_id long, quality int, toxic int, part string, mask int"
    )


def as_dict(df):
    names = ("part", "filter_order", "step", *METRICS, "shapley")
    assert tuple(df.columns) == names
    return {(r[0], r[1], r[2]): list(r[3:]) for r in df.collect()}


def test_audit_equals_plain_python(spark):
    common.prepare(spark)
    docs = awkward()
    table = fixtures.table(spark, [(*d, "s") for d in docs]).withColumnRenamed("words", "mask")
    got = as_dict(filter_audit.audit(table, labels_table(spark)))
    assert got == brute(docs, LABELS)
    assert len(got) == 600 * len({d[2] or "" for d in docs})


def test_audit_of_a_test_table(spark, sf_dir):
    read = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels")}
    docs = [tuple(r) for r in read["documents"].select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in read["labels"].select("doc_id", "quality", "toxic").collect()]
    assert as_dict(filter_audit.audit(read["documents"], read["labels"])) == brute(docs, labels)


def test_audit_without_rows(spark, no_docs):
    assert rows(filter_audit.audit(no_docs, labels_table(spark, []))) == []


def test_audit_of_a_hot_text(spark, monkeypatch):
    """One text in most rows is dealt over salts and loses nothing."""
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    docs = [(i, "the same text" if i % 4 else f"text {i}", "en") for i in range(800)] + [(None, "the same text", "en")] * 40
    got = as_dict(filter_audit.audit(fixtures.table(spark, docs), labels_table(spark)))
    assert got == brute(docs, LABELS)


def test_the_recursion_has_no_row_limit(spark, conf):
    """More parts than Spark's limit for the rows of a recursion allows."""
    conf("spark.sql.cteRecursionRowLimit", "500")
    docs = [(i, f"text {i}", f"part{i}") for i in range(4)]
    assert filter_audit.audit(fixtures.table(spark, docs), labels_table(spark)).count() == 4 * 600
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "500"


@pytest.mark.parametrize("letters", ["AB", "ABC"])
def test_other_numbers_of_filters(spark, letters):
    cells = spark.createDataFrame(
        [("p", [(1, 3, 1, 0), (3, 2, 0, 1), (0, 4, 0, 0)])],
        "part string, cells array<struct<mask:int,n:long,good:long,toxic:long>>",
    )
    got = filter_audit.orders(filter_audit.steps(cells, letters), letters)
    per_order = {r["filter_order"]: r["kept"] for r in got.where(f"step = {len(letters)}").collect()}
    assert set(per_order) == {"".join(p) for p in permutations(letters)}
    assert set(per_order.values()) == {4}
