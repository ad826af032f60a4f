"""Paged lists as a Spark source: every list is a partition, whose pages are fetched from link to link."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mergelane.sources.paged import REQUEST_LOG

# Takes a url; gives the status code and the text of the answer, or raises.
Fetch = Callable[[str], tuple[int, str]]

SCHEMA = f"list string, page int, {REQUEST_LOG}"


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, lists: Sequence[str], on_error: str) -> None:
        self.fetch, self.lists, self.on_error = fetch, lists, on_error

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(url) for url in self.lists]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, page, seen = partition.value, 0, set()
        while url is not None:
            seen.add(url)
            asked, clock, status, payload, link = datetime.now(timezone.utc), time.monotonic(), -1, None, None
            try:
                status, payload = self.fetch(url)
                if status >= 400:
                    raise OSError(f"status {status}")
                link = json.loads(payload).get("@odata.nextLink")
                if link in seen:
                    raise ValueError(f"the pages go in a circle, back to {link}")
                error = None
            except Exception as failure:  # whatever a client raises belongs into the log
                if self.on_error == "fail":
                    raise RuntimeError(f"page {page} of {partition.value}, {url}: {failure}") from failure
                error, link = str(failure), None
            yield partition.value, page, url, payload, status, asked, time.monotonic() - clock, error
            url, page = link, page + 1


def paged_source(fetch: Fetch, name: str = "paged_lists") -> type[DataSource]:
    """A source to register with Spark, which fetches pages by `fetch`.

    Options: ``lists``, a JSON list of the urls of first pages, and ``on_error``, see `read_paged`.
    """

    class PagedLists(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: object) -> DataSourceReader:
            return _Reader(fetch, json.loads(self.options["lists"]), self.options.get("on_error", "fail"))

    return PagedLists


def read_paged(spark: SparkSession, fetch: Fetch, lists: Sequence[str], on_error: str = "fail", name: str = "paged_lists") -> DataFrame:
    """One row per page of every list: ``list`` (its first url), ``page`` (from 0), and the request as in REQUEST_LOG.

    The following page is the one that ``@odata.nextLink`` names. A task holds one page and the urls of its list. A page that cannot
    be fetched or parsed, has a status from 400 on or leads back to an earlier page fails the job; with ``on_error="log"`` its row
    has the error (and status -1 if there was no answer), and its list ends there. Pages are fetched again whenever
    the result is computed, so write it first. Lists given twice are fetched twice; no lists give no rows.
    """
    if on_error not in ("fail", "log"):
        raise ValueError(f"on_error is 'fail' or 'log', not {on_error!r}")
    if not lists:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(paged_source(fetch, name))
    return spark.read.format(name).option("lists", json.dumps(list(lists))).option("on_error", on_error).load()


def fetch_file(url: str) -> tuple[int, str]:
    """A page that Spark wrote as text into a folder of its own."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri("/" + url[5:].lstrip("/") if url.startswith("file:") else url)
    found = system.get_file_info(fs.FileSelector(path))
    parts = sorted(f.path for f in found if f.base_name.startswith("part-"))
    text = []
    for part in parts:
        with system.open_input_stream(part) as stream:
            text.append(stream.read().decode())
    return (200, "".join(text)) if parts else (404, "")
