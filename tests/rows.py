"""Rows of a result in a settled order."""

from __future__ import annotations


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
