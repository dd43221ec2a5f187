"""Fuzzy search for short licence notices.

Texts are cut into lower-case words joined by single blanks. A notice may differ by ``k``
edits, so of its k + 1 equal pieces one must occur exactly: an automaton of all pieces finds
these seeds, and around each seed the regex library matches the notice with at most k errors.
The name that tells a notice from those of other licences ("mit", "lesser", "nc") may differ by at
most half of its characters, and must not be the name of another licence; a label with a version
needs its numbers. A stretch that lacks more letters of the notice than edits are allowed is passed over.
Finds carry their label, word span and number of edits.

NULL text has no words. Every row is judged by itself: repeated rows get equal results. An
empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, pick
from .registry import query

# Phrases and labels of the base.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices searched with errors, and their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("dedicated to the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
    ("licensed under the bsd license", "bsd"),
    ("released under the bsd license", "bsd"),
    ("licensed under the isc license", "isc"),
    ("licensed under the gpl license", "gpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
)
# Words that tell a notice from those of other licences, and further names that are none of ours.
NAMES = frozenset("affero apache bsd gpl isc lesser mit mozilla nc nd sa".split())
OTHER_NAMES = NAMES | frozenset(
    "afl agpl apsl bsl cddl cpl eclipse ecl epl eupl lgpl library lppl mpl ncsa nokia npl ofl osl upl wtfpl zlib".split()
)
CHARS_PER_EDIT = 10
CELL = 64

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def edits_allowed(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def pieces(notice: str) -> list[tuple[int, str]]:
    """(offset, text) of the k + 1 pieces."""
    n = edits_allowed(notice) + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def name_of(notice: str) -> str | None:
    return next((w for w in notice.split() if w in NAMES), None)


def _pattern(notice: str) -> str:
    """The notice with its name as the group ``name``, if it has one."""
    name = name_of(notice)
    return " ".join(f"(?P<name>{w})" if w == name else regex.escape(w) for w in notice.split())


def edits_between(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _named(notice: str, text: str, m) -> bool:
    """The match holds the notice's own name, with edits, and no other licence's."""
    name = name_of(notice)
    if name is None:
        return True
    s, e = m.span("name")
    # Blanks do not count: "M.I.T." has the words "m i t".
    if edits_between(name, text[s:e].replace(" ", "")) > max(1, len(name) // 2):
        return False
    # Edits beside the name can hide a part of the word ("lgpl" for "gpl"): whole words are looked up.
    first, end = text.rfind(" ", 0, s + 1) + 1, text.find(" ", e)
    words = text[first : end if end >= 0 else len(text)].split()
    return not any(w != name and w in OTHER_NAMES for w in words)


def _letters_lacking(letters: tuple, stretch: str) -> int:
    """Letters of a notice that a stretch does not hold; every one of them costs an edit."""
    return sum(max(0, n - stretch.count(c)) for c, n in letters)


def _version_fits(label: str, match: str) -> bool:
    """A label that names a version is not given to a match with other numbers."""
    numbers = {c for c in label if c.isdigit()}
    return not numbers or all(w in numbers for w in match.split() if w.isdigit())


@cache
def _tools(notices: tuple):
    seeds: dict[str, list] = {}
    for i, (notice, _) in enumerate(notices):
        for offset, piece in pieces(notice):
            seeds.setdefault(piece, []).append((i, offset))
    automaton = ahocorasick.Automaton()
    for piece, places in seeds.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    patterns = [
        regex.compile(f"(?be)(?:{_pattern(n)}){{e<={edits_allowed(n)}}}") for n, _ in notices
    ]
    return automaton, patterns, [tuple(Counter(n).items()) for n, _ in notices]


def fuzzy_finds(text: str, notices: tuple = NOTICES) -> list[tuple[int, int, int, int]]:
    """(notice number, start, end, edits) in a normal text, one per place, best first."""
    automaton, patterns, letters = _tools(notices)
    found, searched = {}, set()
    for end, (length, places) in automaton.iter(text):
        for i, offset in places:
            notice, label = notices[i]
            k = edits_allowed(notice)
            first = max(0, end + 1 - length - offset - k)
            # The pieces of one notice point to the same stretch.
            if (i, first) in searched:
                continue
            searched.add((i, first))
            stop = min(len(text), first + len(notice) + 3 * k)
            if _letters_lacking(letters[i], text[first:stop]) > k:
                continue
            m = patterns[i].search(text, first, stop)
            if m and _named(notice, text, m) and _version_fits(label, m.group()):
                found[i, m.start(), m.end()] = sum(m.fuzzy_counts)
    # Of overlapping finds those with the fewest edits stay, one per notice. Kept finds are
    # looked up by place, so a text full of notices costs no more per find.
    best, near = [], defaultdict(list)
    for (i, s, e), edits in sorted(found.items(), key=lambda x: (x[1], x[0])):
        others = [b for cell in range(s // CELL, e // CELL + 1) for b in near[cell]]
        if not any(s < y and x < e and (j == i or least < edits) for j, x, y, least in others):
            best.append((i, s, e, edits))
            for cell in range(s // CELL, e // CELL + 1):
                near[cell].append(best[-1])
    return sorted(best)


def _phrase_starts(text: str) -> list[tuple[int, str]]:
    """(place, label) of every place of a base phrase."""
    padded, out = f" {text} ", []
    for phrase, label in PHRASES.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            out.append((at, label))
            at = padded.find(f" {phrase} ", at + 1)
    return out


def _word_numbers(text: str, places: list[int]) -> list[int]:
    """The blanks before each place of a normal text: the number of the word there."""
    if not places:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.searchsorted(np.flatnonzero(codes == 32), places).tolist()


def _scan_row(doc_id, text):
    words = normal_words(text)
    normal = b" ".join(words).decode("utf-8", "surrogatepass")
    starts = _phrase_starts(normal)
    at = _word_numbers(normal, [place for place, _ in starts])
    finds = fuzzy_finds(normal)
    base = {label for _, label in starts}
    return (
        doc_id,
        len(words),
        len(starts),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {NOTICES[i][1] for i, *_ in finds})),
        max([1.0] * bool(starts) + [1 - e / len(NOTICES[i][0]) for i, _, _, e in finds], default=0.0),
        [NOTICES[i][1] for i, *_ in finds],
        _word_numbers(normal, [s for _, s, _, _ in finds]),
        _word_numbers(normal, [e for _, _, e, _ in finds]),
        [edits for *_, edits in finds],
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: base counts and labels, all labels, score, and the finds.

    ``score`` is 1 for a base phrase, else 1 minus the share of edited characters of the best
    find, 0 without any. ``finds`` has label, first and last word (from 0) and edits.
    """
    rows = pick(docs, doc_id=id_column, text=text_column)
    kind = dict(rows.dtypes)["doc_id"]
    scanned = map_rows(
        rows.select(F.col("doc_id").cast("string"), "text"),
        _scan_row,
        "doc_id string, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, label array<string>, "
        "first array<bigint>, last array<bigint>, edits array<bigint>",
    )
    return scanned.withColumn("doc_id", F.col("doc_id").cast(kind)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.arrays_zip("label", "first", "last", "edits").alias("finds"),
    )


@query("op5_license_scan")
def op5_license_scan(load) -> DataFrame:
    """Every document; finds counted beside the digest."""
    found = scan(load("documents"))
    return found.withColumn("n_fuzzy", F.size("finds").cast("long")).drop("finds")
