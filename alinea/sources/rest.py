"""A cursor-paged REST source as a Spark data source, one partition per resource."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class RetryableError(Exception):
    """A busy or failing server, or a broken connection: worth another attempt."""


def fetch_json(url: str, timeout: float = 30.0) -> dict:
    """The reply as an object; a missing resource (404) is an empty one."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
            return json.load(r)
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return {}
        if e.code == 429 or e.code >= 500:
            raise RetryableError(f"HTTP {e.code}") from e
        raise
    except urllib.error.URLError as e:
        raise RetryableError(str(e.reason)) from e


def get(url: str, fetch: Callable[[str], dict] = fetch_json, attempts: int = 5, least: float = 1.0, most: float = 30.0) -> dict:
    """One reply, with up to ``attempts`` tries and waits that double from ``least`` to ``most`` seconds."""
    for n in range(attempts):
        try:
            return fetch(url)
        except RetryableError:
            if n + 1 == attempts:
                raise
            time.sleep(min(most, least * 2**n))
    raise AssertionError


def pages(base: str, resource: str, params: dict[str, str], fetch: Callable[[str], dict] = fetch_json, page_size: int = 100, most_pages: int = 50_000) -> Iterator[dict]:
    """The items of all pages of a resource, until there is no more or no next cursor.

    More than ``most_pages`` pages raise an error: a cursor that never ends shouldn't end in a cut list.
    """
    cursor = None
    for _ in range(most_pages):
        query = params | {"limit": str(page_size)} | ({"cursor": cursor} if cursor else {})
        reply = get(f"{base}/{resource}?{urllib.parse.urlencode(query)}", fetch)
        yield from reply.get("data") or []
        after = reply.get("pagination") or {}
        cursor = after.get("nextCursor")
        if not after.get("hasMore") or not cursor:
            return
    raise RuntimeError(f"{resource}: more than {most_pages} pages")


class PagedPartition(InputPartition):
    def __init__(self, resource: str):
        super().__init__(resource)
        self.resource = resource


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[PagedPartition]:
        return [PagedPartition(r.strip()) for r in self.options["resources"].split(",") if r.strip()]

    def read(self, partition: PagedPartition) -> Iterator[tuple]:
        params = {k[6:]: v for k, v in self.options.items() if k.startswith("param.")}
        for item in pages(self.options["base"], partition.resource, params, page_size=int(self.options.get("pagesize", "100"))):
            yield (partition.resource, json.dumps(item, ensure_ascii=False))


class PagedSource(DataSource):
    """``spark.read.format("paged_rest").option("base", url).option("resources", "a,b").load()``.

    Rows: resource and the item as JSON text. Options ``param.x`` are sent with each request. A failed
    task is run again by Spark, beyond the attempts of each request.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "resource string, item string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def enrich(keys: DataFrame, key: str, base: str, resource: str, partitions: int, fetch: Callable[[str], dict] = fetch_json) -> DataFrame:
    """(key, item): all items of ``resource`` (with ``{key}`` in its path) for each distinct key.

    ``partitions`` bounds how many requests run at once.
    """
    kind = dict(keys.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in pdf[key]:
                items = [json.dumps(x, ensure_ascii=False) for x in pages(base, resource.format(key=urllib.parse.quote(str(k))), {}, fetch)]
                if items:
                    yield pd.DataFrame({key: [k] * len(items), "item": items})

    return keys.select(key).filter(F.col(key).isNotNull()).distinct().repartition(partitions).mapInPandas(run, f"{key} {kind}, item string")
