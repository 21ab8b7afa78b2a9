"""A table whose readers see whole batches only (SNK-1, SNK-2).

Tasks write data files under names of their own; the driver then commits the batch by one manifest that lists them.  A
file without a manifest is not part of the table, so a killed or failed write leaves nothing to be seen, and a replayed
batch replaces its own manifest.  Rows of all sources share files (sorted by source in each row group):
there is no folder per source and batch, and ``compact`` folds committed files into a given number of new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from aspectflow.sources.limited import _names, _store

ROW_GROUP = 1 << 16


@dataclass
class _Written(WriterCommitMessage):
    file: str | None
    rows: int


def _put(path: str, name: str, content: dict) -> None:
    """A small file that appears at once: written aside, then renamed."""
    store, root = _store(path)
    store.create_dir(root, recursive=True)
    aside = f"{root}/.{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as f:
        f.write(json.dumps(content).encode())
    store.move(aside, f"{root}/{name}")


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.checkpoint = options["path"].rstrip("/"), options["checkpointLocation"].rstrip("/")
        self.sort_by = options.get("sortBy")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.parquet as pq

        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        store, root = _store(f"{self.path}/data")
        for batch in iterator:
            if not batch.num_rows:
                continue
            if self.sort_by:                 # a stream can't be sorted; its batches can
                batch = batch.sort_by(self.sort_by)
            if writer is None:
                store.create_dir(root, recursive=True)
                writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store)
            writer.write_batch(batch, row_group_size=ROW_GROUP)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        return _Written(name if writer is not None else None, rows)

    def _stream(self) -> str:
        store, root = _store(f"{self.checkpoint}/metadata")
        with store.open_input_stream(root) as f:
            return json.loads(f.read())["id"]

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 - names of the interface
        kept = [m for m in messages if m is not None and m.file]
        _put(f"{self.path}/_commits", f"{self._stream()}-{batchId}.json",
             {"files": [m.file for m in kept], "rows": sum(m.rows for m in kept), "replaces": []})

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        """Files of tasks that did end; those of a killed job stay unseen until :func:`vacuum`."""
        store, root = _store(f"{self.path}/data")
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/{m.file}")


class CommittedTable(DataSource):
    """``writeStream.format("committed_table")`` with options path and checkpointLocation (the query's own)."""

    @classmethod
    def name(cls) -> str:
        return "committed_table"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:  # noqa: N802
        return _Writer(self.options)


def write_committed(rows: DataFrame, path: str, checkpoint: str, files_per_batch: int, sort_by: str | None = None,
                    trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to the table at ``path``, at most ``files_per_batch`` files a micro-batch, whose row groups are
    sorted by ``sort_by``.  With a trigger every t seconds a day has at most 86400 / t x ``files_per_batch`` files, until
    :func:`compact` folds them."""
    rows.sparkSession.dataSource.register(CommittedTable)
    writer = (rows.coalesce(files_per_batch).writeStream.format("committed_table").option("path", path)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})))
    return (writer.option("sortBy", sort_by) if sort_by else writer).start()


def manifests(path: str) -> dict[str, dict]:
    """Commits in force, by name: a compaction's manifest stands for those that it replaces."""
    folder = f"{path.rstrip('/')}/_commits"
    found = {}
    for name in _names(folder):
        if name.endswith(".json") and not name.startswith("."):
            store, root = _store(f"{folder}/{name}")
            with store.open_input_stream(root) as f:
                found[name] = json.loads(f.read())
    gone = {n for m in found.values() for n in m["replaces"]}
    return {n: m for n, m in found.items() if n not in gone}


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches; the list of files is fixed when this is called."""
    files = [f"{path.rstrip('/')}/data/{f}" for m in manifests(path).values() for f in m["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: StructType, files: int, sort_by: str | None = None) -> int:
    """Fold the committed batches into ``files`` new files under one manifest; readers see the same rows before and
    after.  Returns how many commits it replaced.  A batch that is replayed after its compaction would come twice, so
    compact only what the stream's checkpoint has committed, e.g. between runs."""
    current = manifests(path)
    if not current:
        return 0
    rows = read_committed(spark, path, schema)
    spread = rows.repartitionByRange(files, sort_by).sortWithinPartitions(sort_by) if sort_by else rows.coalesce(files)
    staged, kept = f"{path.rstrip('/')}/data/compact-{uuid.uuid4().hex}", []
    spread.write.parquet(staged)
    for name in _names(staged):
        if name.endswith(".parquet"):
            kept.append(f"{staged.rsplit('/', 1)[1]}/{name}")
    _put(f"{path.rstrip('/')}/_commits", f"compact-{uuid.uuid4().hex}.json",
         {"files": kept, "rows": sum(m["rows"] for m in current.values()), "replaces": sorted(current)})
    return len(current)


def vacuum(path: str) -> int:
    """Delete data files that no commit in force lists (failed writes, files that a compaction replaced); no writer or
    reader of older lists may be at work.  Returns how many."""
    listed = {f for m in manifests(path).values() for f in m["files"]}
    store, root = _store(f"{path.rstrip('/')}/data")
    gone = 0
    for name in _names(f"{path.rstrip('/')}/data"):
        if name.startswith("compact-"):
            names = [f"{name}/{n}" for n in _names(f"{path.rstrip('/')}/data/{name}")]
        else:
            names = [name]
        for n in names:
            if n.endswith(".parquet") and n not in listed:
                store.delete_file(f"{root}/{n}")
                gone += 1
    return gone
