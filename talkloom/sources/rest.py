"""Schedules from an HTTP API as a Spark data source, and fetching of pages with spacing and retries."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader

from talkloom.schemas import ddl

#: Production parameters: seconds before an API call is given up, between two page requests of a worker, before each retry.
TIMEOUT = 30
SPACING = 0.4
BACKOFF = (2, 4, 8, 10, 10, 10)
WORKERS = 3


class ScheduleApi(DataSource):
    """``spark.read.format("schedule_api").option("url", ...).option("api_key", ...)``: raw sessions of an event's API."""

    @classmethod
    def name(cls) -> str:
        return "schedule_api"

    def schema(self) -> str:
        return ddl("raw_session")

    def reader(self, schema):
        return _Reader(self.options, schema.fieldNames())


class _Reader(DataSourceReader):
    def __init__(self, options, fields: list[str]):
        self.url, self.key, self.fields = options.get("url", ""), options.get("api_key", ""), fields

    def read(self, partition) -> Iterator[tuple]:
        address = f"{self.url.rstrip('/')}/api/session/list?api_key={self.key}&format=json"
        with urllib.request.urlopen(address, timeout=TIMEOUT) as answer:
            rows = json.load(answer)
        for r in rows:
            yield tuple(json.dumps(r[f]) if f == "speakers" and r.get(f) is not None and not isinstance(r[f], str) else r.get(f) for f in self.fields)


def get(url: str) -> str:
    with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:
        return answer.read().decode("utf-8", "replace")


def patient(fetch: Callable[[str], str], url: str, waits: tuple[float, ...] = BACKOFF, sleep: Callable[[float], None] = time.sleep) -> str:
    """The page; refusals (429), server errors and lost connections are tried again after each wait."""
    for wait in (*waits, None):
        try:
            return fetch(url)
        except urllib.error.HTTPError as e:
            if wait is None or (e.code != 429 and e.code < 500):
                raise
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if wait is None:
                raise
        sleep(wait)
    raise AssertionError


def fetch_pages(
    urls: DataFrame,
    make: Callable[[], Callable[[str], str]] = lambda: get,
    url_col: str = "url",
    workers: int = WORKERS,
    spacing: float = SPACING,
    waits: tuple[float, ...] = BACKOFF,
) -> DataFrame:
    """(url, html, error): one request at a time in each of ``workers`` partitions; a page that fails is a row with its error."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = make()
        for batch in batches:
            out = []
            for url in batch[url_col]:
                try:
                    out.append((url, patient(fetch, url, waits), None))
                except Exception as e:
                    out.append((url, None, f"{type(e).__name__}: {e}"))
                time.sleep(spacing)
            yield pd.DataFrame(out, columns=["url", "html", "error"])

    return urls.select(url_col).repartition(workers).mapInPandas(each, "url string, html string, error string")
