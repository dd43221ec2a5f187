"""Small tables with the awkward rows every operator must survive."""

from __future__ import annotations

import random

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "key string, row bigint, th string, w string, n bigint, class string, kept boolean, "
    "size string, _salt string, a string, b string, words string, prefix string, failed string, "
    "_id string, _th string, _runs string, dedup_lines string, component_id string"
)
EXTRA = ("k", 1, "t", "w", 2, "c", True, "s", "x", "a", "b", "w", "p", "f", "i", "h", "r", "l", "d")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}{chr(97 + rng.randrange(26))}" for _ in range(n)]


def table(spark, docs):
    """Documents of (doc_id, text[, lang[, source]]) beside columns with clashing names."""
    rows = [
        (d[0], d[1], d[2] if len(d) > 2 else None, d[3] if len(d) > 3 else None,
         None if d[1] is None else len(d[1]), *EXTRA)
        for d in docs
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def awkward():
    """NULL ids and texts, empty and blank texts, ties, repeated rows, a long text, odd letters."""
    base = prose(1, 120)
    long = " ".join(prose(2, 30_000))
    return [
        (1, " ".join(base), "en", "a"),
        (2, " ".join(base), "en", "a"),
        (2, " ".join(base), "en", "a"),
        (3, " ".join(base[:118] + ["Other", "WORDS"]), "en", None),
        (4, None, None, "a"),
        (5, "", "en", "b"),
        (6, " \n\t\x0b ", None, "b"),
        (None, " ".join(base[60:] + prose(3, 80)), "de", "b"),
        (None, None, None, None),
        (7, long, "de", "c"),
        (8, "É Öl İstanbul K á ÀB cc BY x\x85y  ", "fr", "c"),
        (9, "one", "fr", "a"),
        (10, "ONE", "fr", "a"),
        (11, "same line of words\n" * 30, "en", "b"),
        (11, "another text under the same id", "en", "b"),
    ]
