"""Page fetchers for the paged source; ``root`` is a JSON text of date -> pages."""

from __future__ import annotations

import json

from pyspark import TaskContext

from saltmill.sources.paged import PageError


def memory(root: str, date: str, page: int):
    pages = json.loads(root).get(date, [])
    return pages[page - 1] if page <= len(pages) else None


def empty_list_at_end(root: str, date: str, page: int):
    return memory(root, date, page) or []


def broken_second_page(root: str, date: str, page: int):
    if page == 2:
        raise PageError("status 500")
    return memory(root, date, page)


def gone_page(root: str, date: str, page: int):
    """Two pages when asked on the driver, one when read."""
    return None if page > 1 and TaskContext.get() else memory(root, date, page)


class Counted:
    """A feed that tells its number of pages and cannot be probed."""

    def pages(self, root: str, date: str) -> int:
        return len(json.loads(root).get(date, []))

    def __call__(self, root: str, date: str, page: int):
        found = memory(root, date, page)
        if found is None:
            raise PageError("asked past the end")
        return found
