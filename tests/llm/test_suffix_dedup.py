"""Removal of repeated byte strings against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

import fixtures
from rows import rows
from saltmill.llm import common, suffix_dedup
from saltmill.llm.queries import QUERIES


def brute(docs, length):
    """(doc_id, bytes, removed, spans, digest of the rest) of every row."""
    texts = [(d[0], (d[1] or "").encode()) for d in docs]
    seen = defaultdict(int)
    for _, text in texts:
        for i in range(len(text) - length + 1):
            seen[text[i : i + length]] += 1
    out = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    out = []
    for r in df.collect():
        assert all(a < b for a, b in zip(r["starts"], r["ends"], strict=True))
        removed = sum(b - a for a, b in zip(r["starts"], r["ends"], strict=True))
        assert removed == r["n_bytes"] - len(r["kept"])
        out.append((r["doc_id"], r["n_bytes"], removed, len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n, letters="abé ", passage=60):
    """Texts of few letters that share passages in whole or in part, periodic ones among them."""
    rng = random.Random(seed)

    def text(k):
        return "".join(rng.choices(letters, k=k))

    shared = [text(passage) for _ in range(5)] + ["ab" * passage, "x" * passage]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(shared)
            a, b = sorted(rng.sample(range(len(p) + 1), 2)) if rng.random() < 0.5 else (0, len(p))
            parts += [text(rng.randrange(20)), p[a:b]]
        docs.append((i, "".join(parts), "en", "s"))
    return docs


@pytest.mark.parametrize("length, gram, seed", [(24, 4, 1), (24, 8, 2), (30, 16, 3), (8, 8, 4), (5, 1, 5)])
def test_equals_plain_python(spark, length, gram, seed):
    common.prepare(spark)
    docs = passages(seed, 60) + [(*d, None, None)[:4] for d in fixtures.awkward() if d[0] != 7]
    got = suffix_dedup.cut_repeats(fixtures.table(spark, docs), length, gram)
    assert result(got) == brute(docs, length)


def test_large_groups_are_counted_by_window(spark):
    """With a small bound the exact way around it gives the same rows."""
    common.prepare(spark)
    docs = passages(7, 60)
    for bound in (1, 3):
        got = suffix_dedup.cut_repeats(fixtures.table(spark, docs), 24, 8, max_group=bound)
        assert result(got) == brute(docs, 24)


def test_hot_anchor_pieces_and_repeated_rows(spark, monkeypatch):
    """A row in a third of the table, and a passage in most rows, over salts."""
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    common.prepare(spark)
    docs = passages(8, 30) + [(99, "one line that many rows share " * 3, "en", "s")] * 60
    docs += [(100 + i, f"{i} lead, then the common passage of the table, and {i * i} as tail", "en", "s") for i in range(60)]
    got = suffix_dedup.cut_repeats(fixtures.table(spark, docs), 24, 8)
    assert result(got) == brute(docs, 24)


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    """Pieces are whole windows, wherever a segment ends."""
    monkeypatch.setattr(suffix_dedup, "BUFFER", 64)
    texts = [t[1].encode() for t in passages(9, 20, passage=200)]
    got = set()
    for part in suffix_dedup._segments(texts, 24):
        text, start, windows, _, _ = suffix_dedup.find_pieces([s[2] for s in part], 24, 8)
        for t, s, w in zip(text, start, windows, strict=True):
            row, offset, _ = part[t]
            fresh = {(row, offset + s + i) for i in range(w)}
            assert not fresh & got
            got |= fresh
    assert got == {(r, i) for r, t in enumerate(texts) for i in range(len(t) - 23)}


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(3)
    core = bytes(rng.choices(b"abcd", k=40))
    seen = set()
    for _ in range(50):
        lead, tail = (bytes(rng.choices(b"abcd", k=rng.randrange(40))) for _ in range(2))
        text, start, windows, before, anchor = suffix_dedup.find_pieces([lead + core + tail], 40, 8)
        i = np.flatnonzero((start <= len(lead)) & (len(lead) < start + windows))[0]
        seen.add((int(anchor[i]), int(start[i] + before[i] - len(lead))))
    assert len(seen) == 1


def test_rounds_against_sorted_suffixes():
    """Transform rounds on pieces of unequal length and alignment, each one against all others."""
    rng = random.Random(5)
    for _ in range(300):
        length = 6
        pieces, windows, before = [], [], []
        for _ in range(rng.randrange(1, 12)):
            w, b = rng.randrange(1, 5), rng.randrange(0, 4)
            b = max(b, w - 1)
            pieces.append(bytes(rng.choices(b"ab", k=w + length - 1)))
            windows.append(w)
            before.append(b)
        found = suffix_dedup.repeated(pieces, np.array(windows), np.array(before), length)
        for i, (p, w, b) in enumerate(zip(pieces, windows, before, strict=True)):
            for k in range(w):
                want = any(
                    p[k : k + length] == pieces[j][x : x + length]
                    for j in range(len(pieces)) if j != i
                    for x in [k - b + before[j]] if 0 <= x < windows[j]
                )
                assert found[i, k] == want


def test_empty_tables_and_short_texts(spark, no_docs):
    assert rows(suffix_dedup.cut_repeats(no_docs)) == []
    docs = fixtures.table(spark, [(1, None), (2, ""), (None, "short"), (3, "short")])
    assert result(suffix_dedup.cut_repeats(docs)) == brute([(1, None), (2, ""), (None, "short"), (3, "short")], 200)
    with pytest.raises(ValueError, match="power of two"):
        suffix_dedup.cut_repeats(docs, gram=12)


def test_query_on_a_test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = QUERIES["op11_suffix_dedup"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(got) == brute(docs, 200)
