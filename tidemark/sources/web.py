"""JSON records from a paged web API as a Spark data source."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..naming import ref, require_columns


class _Page(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)


class PagedRecords(DataSource):
    """One input partition per page; every page is a JSON array of flat objects.

    Options: ``url``; ``params`` (a JSON object); ``page_param`` with ``first_page``
    and ``last_page`` for a paged API (``{page}`` inside the URL works as well);
    ``timeout`` in seconds; ``retries`` after "too many requests". As a stream it takes the pages
    from ``first_page`` on that are there, and after them those that came since; with ``page_size``
    a page with fewer records waits until it is full.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedRecordsReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedRecordsStream(schema, self.options)


class PagedRecordsReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        if not options.get("url"):
            raise ValueError("option 'url' is missing")
        self.schema = schema
        self.url = options["url"]
        self.params = json.loads(options.get("params", "{}"))
        self.page_param = options.get("page_param")
        self.first = int(options.get("first_page", "1"))
        self.last = int(options.get("last_page", str(self.first)))
        self.timeout = float(options.get("timeout", "5"))
        self.retries = int(options.get("retries", "3"))

    def page(self, number: int) -> str:
        """The address of a page."""
        params = dict(self.params)
        if self.page_param:
            params[self.page_param] = number
        url = self.url.replace("{page}", str(number))
        return f"{url}?{urllib.parse.urlencode(params)}" if params else url

    def partitions(self) -> list[InputPartition]:
        return [_Page(self.page(number)) for number in range(self.first, self.last + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        records = self.fetch(partition.value)
        for record in records if isinstance(records, list) else [records]:
            yield tuple(_fitted(record.get(f.name), f.dataType) for f in self.schema.fields)

    def fetch(self, url: str) -> object:
        """The parsed body; waits as told when the server asks for fewer requests."""
        for attempt in range(self.retries + 1):
            try:
                with urllib.request.urlopen(url, timeout=self.timeout) as response:
                    return json.loads(response.read().decode("utf-8"))
            except urllib.error.HTTPError as error:
                if error.code != 429 or attempt == self.retries:
                    raise
                time.sleep(float(error.headers.get("Retry-After") or 1))
        raise AssertionError("unreachable")


class PagedRecordsStream(DataSourceStreamReader):
    """Offsets are numbers of pages, the next one to read; Spark keeps them in the query's checkpoint."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.pages = PagedRecordsReader(schema, options)
        self.page_size = int(options.get("page_size", "1"))
        self.next = self.pages.first

    def initialOffset(self) -> dict:
        return {"page": self.pages.first}

    def _is_there(self, number: int) -> bool:
        try:
            records = self.pages.fetch(self.pages.page(number))
        except urllib.error.HTTPError as error:
            if error.code in (404, 410, 416):
                return False
            raise
        except urllib.error.URLError as error:
            if isinstance(error.reason, FileNotFoundError) or "No such file" in str(error.reason):
                return False
            raise
        return len(records) >= self.page_size if isinstance(records, list) else bool(records)

    def latestOffset(self) -> dict:
        """The first page that is not there yet: pages follow each other, so the steps double until
        one is missed, and are halved again. Some few pages are fetched for it."""
        there, step = self.next - 1, 1
        while self._is_there(there + step):
            there, step = there + step, step * 2
        while step > 1:
            step //= 2
            if self._is_there(there + step):
                there += step
        self.next = there + 1
        return {"page": self.next}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.next = max(self.next, end["page"])
        return [_Page(self.pages.page(number)) for number in range(start["page"], end["page"])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.pages.read(partition)


def _fitted(value: object, kind: T.DataType) -> object:
    """JSON does not tell 1 from 1.0; the schema does."""
    if isinstance(kind, T.DoubleType) and isinstance(value, int):
        return float(value)
    if isinstance(kind, T.StringType) and value is not None and not isinstance(value, str):
        return json.dumps(value)
    return value


def read_api(
    spark: SparkSession,
    url: str,
    schema: T.StructType | str,
    params: dict[str, object] | None = None,
    columns: list[str] | None = None,
    page_param: str | None = None,
    pages: tuple[int, int] = (1, 1),
    timeout: float = 5,
    retries: int = 3,
) -> DataFrame:
    """All records of a web API, ``pages`` being the first and the last page.

    The API is called again each time the plan runs: write the records first
    (``sinks.write_parquet``) and work on the written table.
    """
    spark.dataSource.register(PagedRecords)
    options = {
        "url": url,
        "params": json.dumps(params or {}),
        "first_page": str(pages[0]),
        "last_page": str(pages[1]),
        "timeout": str(timeout),
        "retries": str(retries),
    }
    if page_param:
        options["page_param"] = page_param
    df = spark.read.format("paged_records").schema(schema).options(**options).load()
    return df.select([ref(c) for c in require_columns(df, columns)]) if columns else df


def ingest_api(
    spark: SparkSession,
    url: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    params: dict[str, object] | None = None,
    page_param: str | None = None,
    first_page: int = 1,
    page_size: int | None = None,
    timeout: float = 5,
    retries: int = 3,
) -> None:
    """Add the pages of a web API that came since the last run to a Parquet table.

    The checkpoint holds the next page to read and the target's log the batches that were committed,
    so a rerun adds nothing twice. Pages are read by tasks, each a partition. Name the ``page_size`` if
    the last page fills up over time: it is read once it is full.
    """
    spark.dataSource.register(PagedRecords)
    options = {
        "url": url,
        "params": json.dumps(params or {}),
        "first_page": str(first_page),
        "timeout": str(timeout),
        "retries": str(retries),
    }
    if page_param:
        options["page_param"] = page_param
    if page_size:
        options["page_size"] = str(page_size)
    rows = spark.readStream.format("paged_records").schema(schema).options(**options).load()
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(target).awaitTermination()
