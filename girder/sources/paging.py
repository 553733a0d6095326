"""A paged REST source as a Python data source: pages are partitions, not turns of a loop.

``fetch(offset, limit)`` stands for the network; it is given as ``module:function`` so that executors
import it themselves. With the options ``cursorcolumn`` and ``cursor`` it is called with ``where`` and
``order`` too: the service leaves out what hasn't changed since, so a delta costs its own pages only.
A page that fails for the server's reasons is tried again after 5, 10, 20 and 40 seconds, any other
failure ends the task.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

WAITS = (5, 10, 20, 40)


class ServerError(Exception):
    """The server's fault: worth another try."""


def changed_since(column: str | None, cursor: str | None) -> dict[str, str]:
    """What a service is asked besides the page: rows after the cursor, in the order of its row ids."""
    if not column or not cursor:
        return {}
    quoted = cursor.replace("'", "''")
    return {"where": f"{column} > '{quoted}'", "order": ":id"}


def tried(fetch: Callable, offset: int, limit: int, waits=WAITS, sleep=time.sleep) -> list[dict]:
    for wait in (*waits, None):
        try:
            return fetch(offset, limit)
        except ServerError:
            if wait is None:
                raise
            sleep(wait)
    return []


class Page(InputPartition):
    def __init__(self, first: int, stride: int, limit: int) -> None:
        self.first, self.stride, self.limit = first, stride, limit


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = schema.fieldNames()
        self.fetch = options["fetch"]
        self.size = int(options.get("pagesize", 1000))
        self.readers = int(options.get("readers", 4))
        self.asked = changed_since(options.get("cursorcolumn"), options.get("cursor"))
        self.start = int(options.get("startoffset", 0))
        self.most = int(options["maxpages"]) if "maxpages" in options else None

    def partitions(self) -> list[Page]:
        return [Page(k, self.readers, self.size) for k in range(self.readers)]

    def read(self, partition: Page) -> Iterator[tuple]:
        """Every ``readers``-th page until a short one."""
        module, _, name = self.fetch.partition(":")
        fetch = partial(getattr(importlib.import_module(module), name), **self.asked)
        page = partition.first
        while self.most is None or page < self.most:
            rows = tried(fetch, self.start + page * partition.limit, partition.limit)
            for r in rows:
                yield tuple(r.get(n) for n in self.names)
            if len(rows) < partition.limit:
                return
            page += partition.stride


class PagedSource(DataSource):
    """``spark.dataSource.register(PagedSource)``, then ``spark.read.format("paged")``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("state the schema: nothing is inferred")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, self.options)
