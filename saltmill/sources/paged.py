"""Paged feed as a Spark data source.

A feed is a function ``fetch(root, date, page)`` that returns the records of one
page, or None or an empty list past the last page. Pages count from 1.

The source class travels to the workers by value, so they need not have this
package installed.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.joins import small_join
from ..session import materialize

Fetch = Callable[[str, str, int], "list[dict] | None"]

register_pickle_by_value(sys.modules[__name__])


class PageError(RuntimeError):
    """A page that could not be read, as opposed to a page past the end."""


# Columns beside the declared ones: where a row comes from, and the end of a lane.
PLACE = "_paged_date STRING, _paged_page INT, _paged_end INT"


class PagePartition(InputPartition):
    """(date, first page) pairs; each is read in steps of the lane count."""

    def __init__(self, starts: list[tuple[str, int]]):
        self.starts = starts


class PagedReader(DataSourceReader):
    def __init__(self, fetch: Fetch, schema: T.StructType, options: dict[str, str]):
        self.fetch = fetch
        self.columns = to_arrow_schema(schema)
        self.dates = [d for d in options["dates"].split(",") if d]
        self.lanes = int(options.get("lanes", "1"))
        self.tasks = int(options.get("tasks", "0"))
        self.root = options.get("root", "")
        self.stop_on_error = options.get("on_error", "raise") == "stop"

    def partitions(self) -> list[InputPartition]:
        starts = [(date, lane + 1) for lane in range(self.lanes) for date in self.dates]
        tasks = max(1, min(self.tasks or len(starts), len(starts)))
        return [PagePartition(starts[i::tasks]) for i in range(tasks)]

    def read(self, partition: PagePartition) -> Iterator[pa.RecordBatch]:
        for date, page in partition.starts:
            while records := self._page(date, page):
                place = {"_paged_date": date, "_paged_page": page}
                yield pa.RecordBatch.from_pylist([r | place for r in records], schema=self.columns)
                page += self.lanes
            # The first page that this lane found empty.
            end = [{"_paged_date": date, "_paged_end": page}]
            yield pa.RecordBatch.from_pylist(end, schema=self.columns)

    def _page(self, date: str, page: int) -> list[dict] | None:
        try:
            return self.fetch(self.root, date, page)
        except PageError:
            if self.stop_on_error:
                return None
            raise


class PageRange(InputPartition):
    """Pages first..last of a date."""

    def __init__(self, date: str, first: int, last: int):
        self.date, self.first, self.last = date, first, last


class PagedStreamReader(DataSourceStreamReader):
    """A feed that grows; an offset is the number of pages taken of each date.

    The offsets of a batch are in the stream's checkpoint before it is read, so a batch that
    runs again after a stop reads the same pages. Pages must not change once they are there.
    """

    def __init__(self, fetch: Fetch, schema: T.StructType, options: dict[str, str]):
        self.fetch = fetch
        self.columns = to_arrow_schema(schema)
        self.dates = [d for d in options["dates"].split(",") if d]
        self.pages_per_task = int(options.get("pages_per_task", "8"))
        self.root = options.get("root", "")
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.known = {date: self._count(date, self.known.get(date, 0)) for date in self.dates}
        return self.known

    def _count(self, date: str, known: int) -> int:
        """Pages of a date. A feed that cannot tell is probed: a logarithmic number of fetches."""
        if hasattr(self.fetch, "pages"):
            return self.fetch.pages(self.root, date)
        step = 1
        while self.fetch(self.root, date, known + step):
            known, step = known + step, 2 * step
        # ``known`` is there and ``known + step`` is not.
        while step > 1:
            step //= 2
            if self.fetch(self.root, date, known + step):
                known += step
        return known

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [
            PageRange(date, first + 1, min(first + self.pages_per_task, last))
            for date, last in end.items()
            for first in range(start.get(date, 0), last, self.pages_per_task)
        ]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        for page in range(partition.first, partition.last + 1):
            records = self.fetch(self.root, partition.date, page)
            if not records:
                raise PageError(f"page {page} of {partition.date} is gone")
            yield pa.RecordBatch.from_pylist(records, schema=self.columns)


def _source(fetch: Fetch) -> type[DataSource]:
    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged"

        def schema(self) -> T.StructType:
            raise NotImplementedError("a paged feed is read with a declared schema")

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return PagedReader(fetch, schema, dict(self.options))

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return PagedStreamReader(fetch, schema, dict(self.options))

    return PagedSource


def stream_paged(
    spark: SparkSession, fetch: Fetch, dates: list[str], schema: str, root: str = "", pages_per_task: int = 8
) -> DataFrame:
    """The feed as a stream: each batch holds the pages that came since the last one.

    Where a stream stopped is in its checkpoint. Dates may be added on a restart; one that is
    left out is not read further. A feed may offer ``pages(root, date)``, the number of pages
    there are; else it is probed page by page with growing steps. A page that cannot be read,
    or is gone, fails its task and is tried again.
    """
    spark.dataSource.register(_source(fetch))
    return (
        spark.readStream.format("paged")
        .schema(schema)
        .option("dates", ",".join(dates))
        .option("pages_per_task", str(pages_per_task))
        .option("root", root)
        .load()
    )


def read_paged(
    spark: SparkSession,
    fetch: Fetch,
    dates: list[str],
    schema: str,
    root: str = "",
    lanes: int = 1,
    tasks: int = 0,
    on_error: str = "raise",
) -> DataFrame:
    """All pages of all dates, each date up to its first empty page.

    A date has ``lanes`` readers, each taking every lanes-th page up to the first
    empty one, so a date with very many pages is not one task. The readers of all
    dates are dealt to ``tasks`` tasks (0: one task each). A page error fails the
    read; with ``on_error="stop"`` it ends the date instead, as if it were empty.

    With several lanes, a lane may read past the page at which another one stopped. So
    the feed is read once into the scratch folder, and pages beyond the smallest empty
    one of their date are left out: the number of lanes does not change the rows.
    """
    spark.dataSource.register(_source(fetch))
    read = (
        spark.read.format("paged")
        .schema(f"{schema}, {PLACE}")
        .option("dates", ",".join(dates))
        .option("lanes", str(lanes))
        .option("tasks", str(tasks))
        .option("root", root)
        .option("on_error", on_error)
        .load()
    )
    columns = [c for c in read.columns if not c.startswith("_paged_")]
    if lanes == 1:
        return read.where("_paged_end is null").select(*columns)
    read = materialize(read, "paged")
    # One row per date and lane.
    ends = read.where("_paged_end is not null").groupBy("_paged_date").agg(F.min("_paged_end").alias("_stop"))
    kept = small_join(read.where("_paged_end is null").drop("_paged_end"), ends, "_paged_date")
    return kept.where("_paged_page < _stop").select(*columns)


class FolderPages:
    """Feed kept as JSON-lines files: page n is the n-th file of ``root/date=.../``."""

    def __init__(self) -> None:
        self.files: dict[str, list[str]] = {}

    def pages(self, root: str, date: str) -> int:
        """Number of pages now; files that come later must sort behind those that are there."""
        self.files.clear()
        return len(self._pages(root, date)[1])

    def _list(self, store: fs.FileSystem, folder: str) -> list[str]:
        if folder not in self.files:
            found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            self.files[folder] = sorted(f.path for f in found if f.base_name.endswith(".json"))
        return self.files[folder]

    def _pages(self, root: str, date: str) -> tuple[fs.FileSystem, list[str]]:
        url = urlparse(root)
        if url.scheme in ("", "file"):
            store, base = fs.LocalFileSystem(), url.path
        else:
            store, base = fs.FileSystem.from_uri(root)
        return store, self._list(store, f"{base.rstrip('/')}/date={date}")

    def __call__(self, root: str, date: str, page: int) -> list[dict] | None:
        store, files = self._pages(root, date)
        if page > len(files):
            return None
        try:
            with store.open_input_stream(files[page - 1]) as f:
                lines = [line for line in f.read().splitlines() if line]
            # A whole page is parsed at once.
            return json.loads(b"[" + b",".join(lines) + b"]")
        except OSError as e:
            raise PageError(str(e)) from e
