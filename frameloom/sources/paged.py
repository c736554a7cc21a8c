"""A source that pages: spark.read.format("paged") reads numbered pages of JSON, by HTTP or from a folder, each range of pages in a task.

    register(spark)
    spark.read.format("paged").option("page", "https://host/list?pn={page}&ps=20").load()
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "id bigint, title string"


def _of_file(address: str) -> str:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(address)
    with store.open_input_stream(path) as stream:
        return stream.read().decode("utf-8")


class PageRange(InputPartition):
    def __init__(self, first: int, stop: int):
        self.first, self.stop = first, stop


class PagedReader(DataSourceReader):
    """Options: page (an address with {page}), first (1), partitions (8: ranges of pages, at most), items (data.medias: where a page has its items), tries (3) and
    wait (1.0: seconds before the second try, doubled for each further one), headers (a JSON object)."""

    def __init__(self, schema: StructType, options: dict):
        if "{page}" not in options.get("page", ""):
            raise ValueError("option page needs {page} where the page's number goes")
        self.names, self.address = schema.fieldNames(), options["page"]
        self.first, self.ranges, self.tries = int(options.get("first", 1)), int(options.get("partitions", 8)), int(options.get("tries", 3))
        self.items, self.wait, self.headers = options.get("items", "data.medias").split("."), float(options.get("wait", 1.0)), json.loads(options.get("headers", "{}"))

    def _body(self, page: int) -> dict | None:
        """A page's JSON; None if it isn't there. Other faults of the connection are tried again, the last one is raised."""
        address = self.address.replace("{page}", str(page))
        for k in range(max(1, self.tries)):
            try:
                return json.loads(self._over_http(address) if address.startswith(("http://", "https://")) else _of_file(address))
            except FileNotFoundError:
                return None
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                if getattr(e, "code", None) == 404:
                    return None
                if k >= self.tries - 1:
                    raise
                time.sleep(self.wait * 2**k)
        return None

    def _over_http(self, address: str) -> str:
        with urllib.request.urlopen(urllib.request.Request(address, headers=self.headers), timeout=60) as got:
            return got.read().decode("utf-8")

    def fetch(self, page: int) -> list[dict]:
        """A page's items; a code other than 0 is an error with the page's message."""
        body = self._body(page)
        if body is None:
            return []
        if body.get("code", 0) != 0:
            raise RuntimeError(f"page {page}: code {body['code']}: {body.get('message', '')}")
        for name in self.items:
            body = (body or {}).get(name)
        return body or []

    def partitions(self) -> list[PageRange]:
        """Ranges of the pages before the first empty one. It is found by doubling and then halving, so that of n pages the driver reads about twice log2(n)."""
        reach = 1
        while self.fetch(self.first + reach - 1):
            reach *= 2
        low, high = reach // 2, reach - 1  # so many pages have items; at most so many do
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.fetch(self.first + middle - 1) else (low, middle - 1)
        size = max(1, -(-low // self.ranges))
        return [PageRange(self.first + k, self.first + min(low, k + size)) for k in range(0, low, size)] or [PageRange(self.first, self.first)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        """Items of a range in order, until a page is empty: a list that has shrunk ends earlier."""
        for page in range(partition.first, partition.stop):
            if not (found := self.fetch(page)):
                return
            for item in found:
                yield tuple(item.get(n) for n in self.names)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)
