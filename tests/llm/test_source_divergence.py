"""The source divergence audit against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import fixtures
from rows import rows
from saltmill.llm import common, source_divergence

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, min_docs=10, top=10):
    """Every kept term of every group written out, as the contract has it."""
    spread, used, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        spread[lang].update(set(terms_of(text)))
        used[lang, source].update(terms_of(text))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in spread[lang].items() if n >= min_docs)
        sources = sorted(s for g, s in groups if g == lang)

        def rates(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return [1 + 1_000_000_000 * (counts[t] + 2) // total for t in kept]

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        whole = rates(sum((used[lang, s] for s in sources), Counter()))
        for s in sources:
            mine = rates(used[lang, s])
            pairs = [(sum(map(gap, mine, rates(used[lang, o]))), o) for o in sources if o != s]
            marks = [
                (gap(p, q), t) for t, p, q in zip(kept, mine, whole, strict=True) if used[lang, s][t] and p > q
            ]
            for part, found, most in (("pair", pairs, None), ("term", marks, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked[:most], 1)]
    return sorted(out, key=repr)


def corpus(n, seed=1):
    """Sources with their own words, capitals and other scripts, one language without kept terms."""
    rng = random.Random(seed)
    common_words = ["The", "of", "and", "naïve", "слово", "a", "an", "ant", "anthem", "x" * 300, "x" * 299 + "y"]
    docs = []
    for i in range(n):
        source = f"s{rng.randrange(4)}"
        words = rng.choices(common_words, k=rng.randrange(0, 30)) + [source + "mark"] * rng.randrange(3)
        words += [f"rare{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"]
        docs.append((i, rng.choice([" ", "1", "\n", "_-"]).join(words), rng.choice(["en", "en", "de"]), source))
    docs += [(1000, "only here", "xx", "s1"), (1001, "or here", "xx", "s2"), (1002, None, "en", "silent")]
    docs += [(1003, "123 !?", None, None), (1004, "the the", None, "s1"), (5, "AN ant", "de", None)]
    return docs


def divergence(spark, docs, **settings):
    common.prepare(spark)
    df = source_divergence.audit(fixtures.table(spark, docs), **settings)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return rows(df)


@pytest.mark.parametrize("min_docs, top", [(10, 10), (2, 3)])
def test_audit_equals_plain_python(spark, min_docs, top):
    docs = corpus(120) + [(*d, None, None)[:4] for d in fixtures.awkward()]
    assert divergence(spark, docs, min_docs=min_docs, top=top) == brute(docs, min_docs, top)


def test_audit_of_a_test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
    assert rows(source_divergence.audit(df)) == brute(docs)


def test_audit_without_rows(spark, no_docs):
    assert rows(source_divergence.audit(no_docs)) == []


def test_prefixes_below_the_threshold_are_not_extended(spark):
    """Level two holds only what level one let through, and the count is of documents."""
    common.prepare(spark)
    docs = [(i, "aa ab ab", "en", "s") for i in range(3)] + [(9, "ba bb bc bd", "en", "s")]
    terms = source_divergence.term_table(fixtures.table(spark, docs))
    first = source_divergence.prefix_counts(terms, 1, 0, None)
    assert {(r["prefix"], r["n"]) for r in first.collect()} == {(b"a", 3), (b"b", 1)}
    bits = source_divergence.bitmap(first.where("n >= 2"))
    second = source_divergence.prefix_counts(terms, 3, 1, bits)
    assert {(bytes(r["prefix"]), r["n"]) for r in second.collect()} == {(b"aa ", 3), (b"ab ", 3)}


def test_a_saturated_bitmap_keeps_the_result(spark):
    """With every bit set nothing is pruned early, and the counts are as before."""
    common.prepare(spark)
    terms = source_divergence.term_table(fixtures.table(spark, corpus(60)))
    bits = b"\xff" * (1 << (source_divergence.BITMAP_BITS - 3))
    level = source_divergence.prefix_counts(terms, 64, 32, bits).where("n >= 10")
    assert {len(r["prefix"]) for r in level.collect()} == {64}


def test_rates_are_exact_for_large_counts(spark):
    n, total = 10**17 + 7, 3 * 10**17 + 1
    df = spark.createDataFrame([(n, total)], "n long, total long")
    df = df.select(source_divergence.rate(df.n, df.total).alias("p"))
    assert df.first()["p"] == 1 + 1_000_000_000 * (n + 2) // total
