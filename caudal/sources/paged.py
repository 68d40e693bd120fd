"""A data source over paged services: each page is a partition, fetched by a task.

Use: spark.dataSource.register(PagedSource); spark.read.format("paged").schema(...)
.options(fetcher="module:function", total=..., page=1000, where=...).load(), or
spark.readStream with latest="module:function" for the rows that come.

The fetcher is called as fetcher(offset, limit, filters) and gives rows (dicts).
Equality and LIKE-prefix filters are passed on to it; Spark checks them again.
There is no network here, so no service is bound; SECOP-like, feature-server and
document-store scans (SRC8 to SRC12, SRC19, SRC23) differ in the fetcher only.
"""

from __future__ import annotations

import base64
import importlib
import time
from collections.abc import Callable, Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition, StringStartsWith


def as_option(function: Callable) -> str:
    """A function as an option's text, for those that no module of the workers has."""
    return "pickle:" + base64.b64encode(cloudpickle.dumps(function)).decode()


def _function(option: str) -> Callable:
    """What an option names: module:function, or what as_option() made."""
    kind, _, name = option.partition(":")
    return cloudpickle.loads(base64.b64decode(name)) if kind == "pickle" else getattr(importlib.import_module(kind), name)


class Page(InputPartition):
    def __init__(self, offset: int, limit: int) -> None:
        super().__init__(offset)
        self.offset, self.limit = offset, limit


class PagedReader(DataSourceReader):
    def __init__(self, schema, options) -> None:
        self.schema, self.options, self.filters = schema, dict(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo):
                self.filters.append((".".join(f.attribute), "=", f.value))
            elif isinstance(f, StringStartsWith):
                self.filters.append((".".join(f.attribute), "like", f"{f.value}%"))
            yield f

    def partitions(self) -> list[InputPartition]:
        total, page = int(self.options["total"]), int(self.options.get("page", 1000))
        return [Page(i, min(page, total - i)) for i in range(0, total, page)] or [Page(0, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch = _function(self.options["fetcher"])
        names = self.schema.fieldNames()
        for row in with_retry(lambda: fetch(partition.offset, partition.limit, self.filters), int(self.options.get("retries", 3)), float(self.options.get("wait", 0.5))):
            yield tuple(row.get(n) for n in names)


def with_retry(call, retries: int, wait: float):
    """Calls again after an error, with doubled waits."""
    for i in range(retries + 1):
        try:
            return call()
        except (OSError, TimeoutError):
            if i == retries:
                raise
            time.sleep(wait * 2**i)


class PagedStream(DataSourceStreamReader):
    """New rows of a service whose rows keep their places: `latest` (module:function) gives their number so far, and each batch reads from where the last one ended.

    The place is the stream's offset, so a query that starts again from its
    checkpoint goes on without loss or repeats. A batch's pages are its partitions.
    """

    def __init__(self, schema, options) -> None:
        self.schema, self.options = schema, dict(options)

    def _call(self, name: str):
        return with_retry(_function(self.options[name]), int(self.options.get("retries", 3)), float(self.options.get("wait", 0.5)))

    def initialOffset(self) -> dict:
        return {"at": int(self.options.get("start", 0))}

    def latestOffset(self) -> dict:
        return {"at": int(self._call("latest"))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        page = int(self.options.get("page", 1000))
        return [Page(i, min(page, end["at"] - i)) for i in range(start["at"], end["at"], page)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return PagedReader(self.schema, self.options).read(partition)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        raise ValueError("give the schema with .schema(...)")

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStream(schema, self.options)
