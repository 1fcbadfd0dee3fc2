"""A paged comment list as a Spark data source, for batches and streams.

The list's length is found on the driver with a few requests, as many as its
number of pages has bits (doubling, then halving); the pages themselves are read
by executors, a run of pages a partition, so the list never passes through the
driver.  A stream's offset is the number of rows listed so far: a restarted query
goes on behind the last committed row, also in the middle of a page, and a batch
that is run again reads the same rows.

The list is taken to grow at its end only.  Rows are (``id``, ``ord`` from 1,
``row_json``).  An empty list gives no rows; a request that fails, fails the task,
which Spark runs again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from dockmill.sources.api import PAGE, Fetch

ROW = "id string, ord long, row_json string"
PAGES = 8  # of a partition


def page_url(base: str, object_id: str, page: int, size: int = PAGE) -> str:
    return f"{base}/comments?filter[commentOnId]={object_id}&page[size]={size}&page[number]={page}"


class FolderReplay:
    """Answers from a folder that driver and executors share (any URI that Arrow's file systems know): a file for each URL."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")

    def _open(self, url: str):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.uri)
        return system, f"{path}/{hashlib.sha256(url.encode()).hexdigest()}"

    def download(self, url: str) -> bytes:
        system, path = self._open(url)
        with system.open_input_stream(path) as f:
            return f.read()

    def __call__(self, url: str) -> dict:
        return json.loads(self.download(url))

    def keep(self, url: str, answer: dict | bytes) -> None:
        system, path = self._open(url)
        with system.open_output_stream(path) as f:
            f.write(answer if isinstance(answer, bytes) else json.dumps(answer).encode())


class _Pages:
    """One list: which rows it has, and their pages."""

    def __init__(self, fetch: Fetch, base: str, object_id: str, size: int):
        self.fetch, self.base, self.object_id, self.size = fetch, base, object_id, size

    def rows(self, page: int) -> list[dict]:
        return self.fetch(page_url(self.base, self.object_id, page, self.size))["data"]

    def full(self, page: int) -> bool:
        return len(self.rows(page)) == self.size

    def length(self, known: int = 0) -> int:
        """Rows of the list, of which ``known`` are known to be there.  No page is asked for that may not exist: page p + 1 only where p is full."""
        low = known // self.size  # this many pages are full
        step = 1
        while self._reachable(low, low + step):
            low, step = low + step, step * 2
        while step > 1:
            step //= 2
            if self._reachable(low, low + step):
                low += step
        return low * self.size + len(self.rows(low + 1))

    def _reachable(self, low: int, page: int) -> bool:
        """Whether ``page`` is full; ``low`` is.  A service may refuse pages behind its last, which then is not full."""
        try:
            return self.full(page)
        except (KeyError, OSError):
            if page == low + 1:
                raise
            return False


class Run(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last  # rows, from 1


class _Reader:
    """What the readers of batches and streams share."""

    def __init__(self, pages: _Pages, pages_a_task: int):
        self.pages, self.per_task = pages, pages_a_task

    def runs(self, first: int, last: int) -> list[Run]:
        """Rows ``first`` to ``last`` in runs that begin with pages where they can."""
        out, width = [], self.per_task * self.pages.size
        while first <= last:
            end = min(last, (first - 1) // width * width + width)
            out.append(Run(first, end))
            first = end + 1
        return out

    def read(self, partition: Run) -> Iterator[tuple]:
        size = self.pages.size
        for page in range((partition.first - 1) // size + 1, (partition.last - 1) // size + 2):
            for ord_, row in enumerate(self.pages.rows(page), (page - 1) * size + 1):
                if partition.first <= ord_ <= partition.last:
                    yield row.get("id"), ord_, json.dumps(row)


class _Batch(_Reader, DataSourceReader):
    def partitions(self) -> list[Run]:
        return self.runs(1, self.pages.length()) or [Run(1, 0)]


class _Stream(_Reader, DataSourceStreamReader):
    known = 0

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        self.known = self.pages.length(self.known)
        return {"rows": self.known}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        self.known = max(self.known, end["rows"])
        return self.runs(start["rows"] + 1, end["rows"])

    def commit(self, end: dict) -> None:
        pass


def paged_source(fetch: Fetch, name: str = "paged_comments") -> type[DataSource]:
    """A data source class to register; its options: ``base``, ``object_id``, ``page_size``, ``pages`` (of a partition)."""

    class PagedComments(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ROW

        def _pages(self) -> tuple[_Pages, int]:
            o = self.options
            return _Pages(fetch, o["base"], o["object_id"], int(o.get("page_size", PAGE))), int(o.get("pages", PAGES))

        def reader(self, schema) -> DataSourceReader:
            return _Batch(*self._pages())

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Stream(*self._pages())

    return PagedComments


def listed(spark: SparkSession, base: str, object_id: str, fetch: Fetch, *, page_size: int = PAGE, pages: int = PAGES, stream: bool = False) -> DataFrame:
    """The list as a DataFrame, or as one that streams."""
    spark.dataSource.register(paged_source(fetch))
    reader = (spark.readStream if stream else spark.read).format("paged_comments")
    return reader.options(base=base, object_id=object_id, page_size=page_size, pages=pages).load()
