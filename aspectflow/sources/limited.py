"""A table as a stream with its own row offsets (SRC-1/2, STM-4, STM-5).

``append_feed`` numbers a table's rows densely in a given order and stores them in chunks of offsets.  The data source
``row_feed`` reads them as a stream: so many rows a trigger, from the first row or from the rows that come after the
start, and after a restart from where the checkpoint says.  Tasks read only the chunks of their own offsets; a trigger of
a few rows is read where it is planned, as starting a task's Python costs many times the reading.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType,
)

from aspectflow.operators.ordering import with_row_index
from aspectflow.sources.io import path_exists

CHUNK = 10_000          # offsets a folder of the feed; a task reads one chunk at most
FEW = 256               # rows a trigger, at most, that are read where the trigger is planned, not by tasks
_PLAIN = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, BinaryType, StringType)


def plain_types(schema: StructType) -> bool:
    """Whether Arrow and Spark store the values of all columns alike (no times, nested or collated ones)."""
    return all(type(f.dataType) in _PLAIN and f.dataType == type(f.dataType)() for f in schema)


def _names(path: str) -> list[str]:
    """File and folder names under ``path``, by Arrow's file systems (local, HDFS, object stores)."""
    from pyarrow import fs

    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return [f.base_name for f in found]


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)


def feed_end(path: str) -> int:
    """Number of rows that the feed holds."""
    return max((int(n) for n in _names(f"{path.rstrip('/')}/_ends") if n.isdigit()), default=0)


def append_feed(rows: DataFrame, path: str, order: list[str], chunk: int = CHUNK) -> int:
    """Add ``rows`` to the feed in ``order`` and return its new end; one writer at a time.

    Rows become visible when the end moves, after all of them are stored: an append that failed in between leaves the
    feed as it was, and the next one overwrites its chunks.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    start = feed_end(path)
    numbered = with_row_index(rows, order, "feed_offset", start)
    chunked = numbered.withColumn("chunk", F.floor(F.col("feed_offset") / chunk).cast("long"))
    (chunked.repartition("chunk").sortWithinPartitions("feed_offset").write.mode("overwrite")
     .partitionBy("chunk").parquet(f"{path}/from={start}"))
    end = start + spark.read.schema(chunked.schema).parquet(f"{path}/from={start}").count()
    if end > start:
        spark.createDataFrame([(chunk, start)], "chunk long, start long").coalesce(1).write.mode("overwrite").json(f"{path}/_ends/{end}")
    return end


class _Range(InputPartition):
    def __init__(self, segment: int, chunk: int, first: int, last: int):
        super().__init__((segment, chunk, first, last))
        self.segment, self.chunk, self.first, self.last = segment, chunk, first, last


class _FeedReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.names
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("rowsPerTrigger", 0))
        self.chunk = int(options.get("chunk", CHUNK))
        self.starting = options.get("startingOffsets", "earliest")
        if self.starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is earliest or latest")
        self.checkpoint = options.get("checkpointLocation")
        if self.limit and not self.checkpoint:
            raise ValueError("a limit of rows needs checkpointLocation, to go on from it after a restart")
        self.at: int | None = None          # up to here rows have been planned

    def initialOffset(self) -> dict:  # noqa: N802 - names of the interface
        self.at = 0 if self.starting == "earliest" else feed_end(self.path)
        return {"offset": self.at}

    def _planned(self) -> int | None:
        """The last offset in the checkpoint's log; Spark doesn't pass it to a source that starts again."""
        folder = f"{self.checkpoint.rstrip('/')}/offsets"
        logs = sorted((n for n in _names(folder) if n.isdigit()), key=int)
        if not logs:
            return None
        store, root = _store(f"{folder}/{logs[-1]}")
        with store.open_input_stream(root) as f:
            return json.loads(f.read().decode().strip().splitlines()[-1])["offset"]

    def latestOffset(self) -> dict:  # noqa: N802
        end = feed_end(self.path)
        if not self.limit:
            return {"offset": end}
        if self.at is None:
            self.at = self._planned()
        if self.at is None:
            self.initialOffset()
        self.at = max(self.at, min(self.at + self.limit, end))
        return {"offset": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last, out = start["offset"], end["offset"], []
        self.at = max(self.at or 0, last)
        for a, b in _segments(self.path):
            lo, hi = max(first, a), min(last, b)
            while lo < hi:
                upto = min(hi, (lo // self.chunk + 1) * self.chunk)
                out.append(_Range(a, lo // self.chunk, lo, upto))
                lo = upto
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        store, root = _store(f"{self.path}/from={partition.segment}/chunk={partition.chunk}")
        found, at = ds.dataset(root, filesystem=store, format="parquet"), ds.field("feed_offset")
        yield from found.to_table(columns=self.columns, filter=(at >= partition.first) & (at < partition.last)).to_batches()

    def commit(self, end: dict) -> None:
        pass


class _FewRowsReader(SimpleDataSourceStreamReader):
    """The same feed, offsets and rows, read by the process that plans the triggers; a batch that was planned before a
    restart is read by a task."""

    def __init__(self, schema: StructType, options: dict):
        self.feed, self.schema = _FeedReader(schema, options), to_arrow_schema(schema)

    def initialOffset(self) -> dict:  # noqa: N802 - names of the interface
        # after a restart, Spark asks only where it has planned no batch of the log itself
        planned = self.feed._planned()
        if planned is None:
            return self.feed.initialOffset()
        self.feed.at = planned
        return {"offset": planned}

    def read(self, start: dict) -> tuple[Iterator[pa.RecordBatch], dict]:
        self.feed.at = start["offset"]
        end = self.feed.latestOffset()
        return iter(list(self.readBetweenOffsets(start, end))), end        # Spark copies the iterator: no generator

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[pa.RecordBatch]:  # noqa: N802
        # as the stream's schema has it: a stored column may be one that can't be null
        return (b.cast(self.schema) for b in chain.from_iterable(map(self.feed.read, self.feed.partitions(start, end))))


def _segments(path: str) -> list[tuple[int, int]]:
    """(first offset, end) of every append whose end has been stored."""
    ends = sorted(int(n) for n in _names(f"{path}/_ends") if n.isdigit())
    return list(zip([0, *ends], ends))


class RowFeed(DataSource):
    """``spark.readStream.format("row_feed")`` with options path, schema (DDL), rowsPerTrigger, startingOffsets
    (``earliest`` or ``latest``) and checkpointLocation (the query's own)."""

    @classmethod
    def name(cls) -> str:
        return "row_feed"

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        if 0 < int(self.options.get("rowsPerTrigger", 0)) <= FEW and plain_types(schema):
            raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED", messageParameters={"feature": "streamReader"})
        return _FeedReader(schema, self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _FewRowsReader(schema, self.options)


def feed_stream(spark: SparkSession, path: str, schema: StructType, rows_per_trigger: int | None = None,
                starting: str = "earliest", checkpoint: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The feed at ``path`` as a stream of its columns; ``rows_per_trigger`` rows a micro-batch at most."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    spark.dataSource.register(RowFeed)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"path": path, "schema": ddl, "startingOffsets": starting, "chunk": str(chunk)}
    if rows_per_trigger:
        options["rowsPerTrigger"] = str(int(rows_per_trigger))
    if checkpoint:
        options["checkpointLocation"] = checkpoint
    return spark.readStream.format("row_feed").options(**options).load()
