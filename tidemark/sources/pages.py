"""Stored API responses as tables: a Python data source over listing pages, and readers of stored range responses.

A listing is a folder with one folder a page (page=1, page=2, ...), each with the response's JSON list. The source deals ranges
of pages out to tasks, fetches a page at a time and stops in its range after a page that is short or missing; which page ends
the listing is then found over all ranges. Filters on page prune the ranges before anything is fetched.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "page int, place int, size int, payload string"
_ARROW = pa.schema([("page", pa.int32()), ("place", pa.int32()), ("size", pa.int32()), ("payload", pa.string())])


@dataclass
class PageRange(InputPartition):
    first: int
    last: int


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.per_page, self.each = int(options.get("per_page", "250")), int(options.get("pages_per_task", "16"))
        self.first, self.last = int(options.get("first_page", "1")), int(options["pages"])
        self.stop = options.get("stop_at_short", "true") == "true"

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Bounds of the page number narrow the ranges; all other filters are Spark's."""
        for f in filters:
            if getattr(f, "attribute", None) != ("page",):
                yield f
            elif isinstance(f, EqualTo):
                self.first, self.last = max(self.first, f.value), min(self.last, f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [PageRange(a, min(a + self.each - 1, self.last)) for a in range(self.first, self.last + 1, self.each)] or [PageRange(1, 0)]

    def fetch(self, page: int) -> list:
        """The records of a page; a response that is no list has none."""
        from pyarrow import fs as filesystems

        store, root = filesystems.FileSystem.from_uri(self.path)
        files = store.get_file_info(filesystems.FileSelector(f"{root}/page={page}", allow_not_found=True))
        texts = [store.open_input_stream(f.path).read().decode() for f in sorted(files, key=lambda f: f.path) if f.is_file and f.base_name[0] not in "_."]
        data = json.loads("".join(texts)) if texts else []
        return data if isinstance(data, list) else []

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        for page in range(partition.first, partition.last + 1):
            records = self.fetch(page)
            rows = [(i, json.dumps(r)) for i, r in enumerate(records) if isinstance(r, dict)]
            if len(records) < self.per_page:
                rows.append((None, None))  # marks the page as short, even if it is empty
            places, payloads = zip(*rows, strict=True) if rows else ((), ())
            n = len(rows)
            yield pa.RecordBatch.from_arrays([pa.array([page] * n, pa.int32()), pa.array(places, pa.int32()), pa.array([len(records)] * n, pa.int32()), pa.array(payloads, pa.string())], schema=_ARROW)
            if self.stop and len(records) < self.per_page:
                return


class PageSource(DataSource):
    """Options: path, pages (the last that may be asked for), per_page, first_page, pages_per_task, stop_at_short."""

    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(dict(self.options))


def read_pages(spark: SparkSession, path: str, pages: int, **options: object) -> DataFrame:
    """page, place, size and payload of the stored pages; a short or missing page has one row more, without a place."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
    return spark.read.format("listing_pages").options(path=path, pages=pages, **options).load()


def whole_listing(pages: DataFrame, per_page: int = 250) -> DataFrame:
    """The records up to the first short or missing page, as a client would get them that asks for one page after the other."""
    end = pages.where(F.col("size") < per_page).agg(F.min("page").alias("_end"))
    return pages.where("place is not null").crossJoin(F.broadcast(end)).where(F.col("page") <= F.coalesce("_end", "page")).drop("_end")


def window_pages(first_rank: int, last_rank: int, per_page: int = 250) -> tuple[int, int]:
    """The pages on which a window of ranks lies."""
    first = max(1, (first_rank - 1) // per_page + 1)
    return first, max(first, -(-last_rank // per_page))


def write_pages(rows: DataFrame, path: str) -> str:
    """rows: page, place, payload (a JSON object). Each page's records in order of place, as one response."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("place", "payload"))), lambda r: r["payload"])
    pages = rows.groupBy("page").agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("value"))
    pages.write.partitionBy("page").text(path)
    return path


def write_responses(responses: DataFrame, path: str, *keys: str) -> str:
    """responses: the keys of the request and json, the response to it. One folder a request."""
    responses.select(*keys, F.col("json").alias("value")).write.partitionBy(*keys).text(path)
    return path


def read_responses(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """The stored responses: the keys (a schema) and json. Filters on the keys prune the folders."""
    return spark.read.schema(f"value string, {keys}").option("wholetext", "true").text(path).withColumnRenamed("value", "json")
