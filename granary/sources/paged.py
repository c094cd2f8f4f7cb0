"""Paged sources: rows behind an interface that gives pages, and pages kept by address."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from granary.functions import text as X
from granary.operators.dedup import first_wins
from granary.operators.mix import capped

PAGE = 100
ATTEMPTS = 4  # of a page; waits of 5 s times the attempt where the server asks for patience, else of 2 s


class TooManyRequests(Exception):
    pass


class LostPage(RuntimeError):
    pass


def fetch_page(get: Callable[[int, int], list], offset: int, length: int, sleep: Callable[[float], None] = time.sleep) -> list:
    """Rows of a page; :class:`LostPage` after ``ATTEMPTS`` failures. Anything but a list counts as a failure."""
    for k in range(1, ATTEMPTS + 1):
        try:
            rows = get(offset, length)
            if not isinstance(rows, list):
                raise ValueError("a page is a list of rows")
            return rows
        except Exception as e:
            if k == ATTEMPTS:
                raise LostPage(f"rows {offset} to {offset + length} after {ATTEMPTS} attempts: {e!r}") from e
            sleep((5.0 if isinstance(e, TooManyRequests) else 2.0) * k)
    return []


class _Page(InputPartition):
    def __init__(self, offset: int, length: int) -> None:
        super().__init__((offset, length))
        self.offset, self.length = offset, length


class PagedSource(DataSource):
    """Python data source 'pages': one task per page of a module's function ``get(offset, length)``.

    Options: ``module`` and ``function`` (importable on the workers), ``rows`` (how many there are), ``most`` (rows to
    read at most, 0 for all), ``lost`` ('fail', or 'rows': a page that can't be had gives one row of its offset whose text is
    null, so that it can be asked for again). Yields row_idx and the row as JSON text.
    """

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "row_idx BIGINT, row STRING"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PageReader(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.module, self.function = options["module"], options["function"]
        most = int(options.get("most", "0"))
        self.rows = min(int(options["rows"]), most) if most else int(options["rows"])
        self.lost = options.get("lost", "fail")

    def partitions(self):
        return [_Page(o, min(PAGE, self.rows - o)) for o in range(0, self.rows, PAGE)]

    def read(self, partition):
        import importlib
        import json

        get = getattr(importlib.import_module(self.module), self.function)
        try:
            rows = fetch_page(get, partition.offset, partition.length)
        except LostPage:
            if self.lost != "rows":
                raise
            yield (partition.offset, None)
            return
        for k, row in enumerate(rows[: partition.length]):
            if isinstance(row, dict) and "row" in row:
                yield (int(row.get("row_idx", partition.offset + k)), json.dumps(row["row"]))


def source_rows(rows: DataFrame, mapped: Callable[[DataFrame], DataFrame], order: str, cap: int = 0, source: str | None = None) -> DataFrame:
    """Records of a source: mapped, each output once (least ``order``), at most ``cap`` (0: all) in that order.

    ``mapped`` keeps ``order``, which is unique. Rows of several sources are told apart by their column
    ``source``, which ``mapped`` keeps too; each output counts once, and the cap holds, in each of them.
    """
    records = mapped(rows)
    once = first_wins(records.withColumn("_d", X.digest(F.col("output"))), ["_d"] if source is None else [source, "_d"], order).drop("_d")
    if source is not None:
        return capped(once, source, order, cap) if cap else once
    return once.orderBy(order).limit(cap) if cap else once


def uncached(addresses: DataFrame, cache: DataFrame) -> DataFrame:
    """Addresses (url) whose page isn't in ``cache`` (name, html), by the file name of the address."""
    named = addresses.withColumn("name", X.safe_filename(F.col("url")))
    return named.join(cache.where(F.col("html").rlike(HTML_RE)).select("name"), "name", "left_anti")


HTML_RE = r"(?i)<html|<!doctype|<body|<article|<main"


def fetch_into(addresses: list[str], cache_dir: str, get: Callable[[str], str], sleep: Callable[[float], None] = time.sleep, pause: float = 0.5) -> tuple[int, list[str]]:
    """Fetch the pages of ``addresses`` that a local ``cache_dir`` lacks, with a pause between them: (fetched, addresses given up).

    A page is kept under the safe name of its address if it looks like HTML; one that doesn't, or fails, is given up.
    """
    import os
    import re

    os.makedirs(cache_dir, exist_ok=True)
    fetched, failed = 0, []
    for url in dict.fromkeys(addresses):
        path = os.path.join(cache_dir, X.safe_filename_of(url) + ".html")
        if os.path.exists(path):
            continue
        if fetched or failed:
            sleep(pause)
        try:
            html = get(url)
            if not re.search(HTML_RE, html):
                raise ValueError("no HTML")
            with open(path, "w", encoding="utf-8") as f:
                f.write(html)
            fetched += 1
        except Exception:
            failed.append(url)
    return fetched, failed


def http_get(url: str, timeout: float = 30.0) -> str:
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "granary"}), timeout=timeout) as r:
        return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")


def cached_pages(addresses: DataFrame, cache: DataFrame) -> DataFrame:
    """Pages of addresses from the cache: url, html. Addresses without one are left out."""
    return addresses.withColumn("name", X.safe_filename(F.col("url"))).join(cache, "name").select("url", "html")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)


def sample_page(offset: int, length: int) -> list:
    """Offline pages for tests: rows of their own number."""
    return [{"row_idx": i, "row": {"n": i}} for i in range(offset, offset + length)]


def sample_instructions(offset: int, length: int) -> list:
    """Offline pages of instruction rows, for tests."""
    return [{"row_idx": i, "row": {"instruction": f"Say the number {i} in words, and nothing else", "output": f"The number is {i}, which is {i % 10} more than {i - i % 10}."}} for i in range(offset, offset + length)]
