"""A data source for paged services: ``spark.read.format("paged")``, one partition a query, pages read until the last.

Options: ``queries`` (a JSON list of texts), ``fetcher`` (module:function called as f(query, page) and returning
(status, body, last)), ``max_pages``, ``attempts`` and ``wait`` (seconds, doubled each time) for busy services (429, 5xx).
A query whose service stays busy gives one row with the last status and no body, so it can be asked again; it fails no
other query. Registered by ``register(spark)``. Without a network the default fetcher reads ``<root>/<query>/<page>.json``.
"""

from __future__ import annotations

import importlib
import json
import os
import time
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from phyllo.session import ship


def from_folder(root: str):
    """A fetcher over recorded pages."""

    def fetch(query: str, page: int) -> tuple[int, str | None, bool]:
        here, following = (os.path.join(root, query, f"{p}.json") for p in (page, page + 1))
        if not os.path.exists(here):
            return 200, None, True
        with open(here, encoding="utf-8") as f:
            return 200, f.read(), not os.path.exists(following)

    return fetch


class Query(InputPartition):
    def __init__(self, text: str) -> None:
        self.text = text


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[Query]:
        return [Query(q) for q in json.loads(self.options.get("queries", "[]"))]

    def read(self, partition: Query) -> Iterator[tuple]:
        o = self.options
        if "fetcher" in o:
            module, _, name = o["fetcher"].partition(":")
            fetch = getattr(importlib.import_module(module), name)
        else:
            fetch = from_folder(o["root"])
        for page in range(int(o.get("max_pages", 1_000_000))):
            wait = float(o.get("wait", 1))
            for attempt in range(int(o.get("attempts", 5))):
                status, body, last = fetch(partition.text, page)
                if status != 429 and status < 500:
                    break
                if attempt + 1 < int(o.get("attempts", 5)):
                    time.sleep(wait)
                    wait *= 2
            if body is None and status == 200:
                return
            yield partition.text, page, status, body if status < 400 else None
            if last or status >= 400:
                return


class Paged(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "query string, page int, http_status int, body string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Paged)
