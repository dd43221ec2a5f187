"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall(text or "")


def plain(text):
    return PLAIN.findall((text or "").translate(AZ))


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def base_secrets(text):
    """Base spans (start, kind, end), from the plain patterns and a length test."""
    text, found = text or "", []
    assign = r"""([A-Za-z_]+)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    key = "password|passwd|secret|token|api_?key"
    assign = assign.replace("([A-Za-z_]+)", "(" + "".join(
        f"[{c}{c.upper()}]" if c.isalpha() else c for c in key) + ")")
    kinds = (
        (0, assign, lambda m: len(m[2]) >= 8),
        (1, r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (2, r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    )
    for kind, pattern, good in kinds:
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return sorted(found)


def phrase_places(text):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    words, out = plain(text), []
    for phrase, label in phrases.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return words, out


def cut_lines(docs, min_words=50):
    """{(id, text): (text after the cut, lines cut, words cut)} by comparing all runs."""
    places = {}
    kept = {}
    order = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    lines = {}
    for d in order:
        rows = [(n, x) for n, x in enumerate(d[1].split("\n")) if SPACED.search(x)]
        lines[d] = rows
        for i in range(len(rows)):
            words = 0
            for j in range(i, len(rows)):
                words += len(spaced(rows[j][1]))
                if words >= min_words:
                    places.setdefault(tuple(x for _, x in rows[i : j + 1]), []).append((d, i, j))
                if words >= 4 * min_words:
                    break
    gone = {d: set() for d in order}
    for found in places.values():
        for d, i, j in found[1:]:
            gone[d] |= set(range(i, j + 1))
    for d in order:
        numbers = {lines[d][k][0] for k in gone[d]}
        left = [x for n, x in enumerate(d[1].split("\n")) if n not in numbers]
        kept[d] = "\n".join(left), len(numbers), sum(len(spaced(lines[d][k][1])) for k in gone[d])
    return kept


def hits(text, items, window=10):
    """(words, words hit, item ids found) of a text."""
    words, covered, found = plain(text), set(), set()
    for item_id, item in items:
        w = plain(item)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == w[k : k + size]:
                    covered |= set(range(i, i + size))
                    found.add(item_id)
    return len(words), len(covered), found


def shingles(text, words=5):
    w = spaced((text or "").translate(AZ))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def near_groups(texts, percent=75):
    """Component number (least row) of every text, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]
