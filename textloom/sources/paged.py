"""A data source of paged rows: ``format("paged_rows")`` reads pages of ``length`` rows from ``offset`` on through a fetcher."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers that are worth another try.
RETRIED = (429, 500, 502, 503, 504)


class PageError(Exception):
    def __init__(self, status: int) -> None:
        super().__init__(f"status {status}")
        self.status = status


def with_retries(fetch: Callable[[], dict], attempts: int = 5, backoff: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The answer of ``fetch``; after a passing failure it is called again, each time after twice the wait."""
    for n in range(attempts):
        try:
            return fetch()
        except PageError as e:
            if e.status not in RETRIED or n == attempts - 1:
                raise
            sleep(backoff * 2**n)
    raise ValueError("attempts must be positive")


class _Range(InputPartition):
    def __init__(self, start: int, stop: int) -> None:
        self.start, self.stop = start, stop


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.o = options

    def partitions(self) -> list[InputPartition]:
        start, rows = int(self.o.get("offset", 0)), int(self.o["rows"])
        part = max(int(self.o.get("page", 100)), int(self.o.get("part", 10_000)))
        return [_Range(a, min(a + part, start + rows)) for a in range(start, start + rows, part)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        module, _, name = self.o["fetcher"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        page, field, at = int(self.o.get("page", 100)), self.o.get("field", "text"), partition.start
        while at < partition.stop:
            n = min(page, partition.stop - at)
            rows = with_retries(lambda at=at, n=n: fetch(at, n), int(self.o.get("attempts", 5)), float(self.o.get("backoff", 1.0))).get("rows", [])
            if not rows:
                return
            for i, r in enumerate(rows):
                value = r.get("row", {}).get(field)
                yield at + i, "" if value is None else str(value)
            at += len(rows)


class PagedRows(DataSource):
    """Options: ``fetcher`` (``module:function`` of offset and length, giving ``{"rows": [{"row": {...}}]}``), ``rows``, ``offset``,
    ``page``, ``part`` (rows a task), ``field``, ``attempts``, ``backoff``. A missing field is an empty text."""

    @classmethod
    def name(cls) -> str:
        return "paged_rows"

    def schema(self) -> str:
        return "offset long, text string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))
