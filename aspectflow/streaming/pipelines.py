"""Micro-batch pipelines.

Both reference streams are stateless map + sink, so a pipeline here is:
source -> DataFrame transform -> ``foreachBatch`` sink.  The sink writes the
whole micro-batch in one distributed write (one of a few rows, where the caller
says so, as one file from the driver), tagged with the stream's identity
and the batch id and partitioned by both, with dynamic partition overwrite: a
batch replayed after a failure (the checkpoint has not committed it) overwrites
its own partition, so the table never loses or duplicates rows.  The identity
is the query id that Spark keeps in the checkpoint: a stream restarted with a
new checkpoint counts its batches from 0 again, but under another identity, so
it appends to what earlier runs stored.  Failures are re-raised (never
swallowed), so Spark replays the batch.
"""

from __future__ import annotations

import json
import logging
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyarrow import ArrowInvalid
from pyarrow.fs import FileSelector, FileSystem
from pyarrow.parquet import write_table
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from aspectflow.sources.io import path_exists
from aspectflow.sources.limited import plain_types

log = logging.getLogger("aspectflow.streaming")

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def kafka_reader(spark: SparkSession, servers: str, topics: str, starting: str = "earliest",
                 max_offsets: int | None = None, extra: dict | None = None) -> DataFrame:
    """SRC-1/SRC-2 (+STM-4/5): Kafka topics as a stream of ``value`` bytes.

    ``topics`` is one name or a comma list (several cameras merge into one
    stream; Kafka's own ``topic`` column tells them apart).  Needs the Kafka
    connector on the class path.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(
        servers, topics, starting, max_offsets, extra))
    return reader.load()


def kafka_options(servers: str, topics: str, starting: str = "earliest",
                  max_offsets: int | None = None, extra: dict | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting}
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    opts.update(extra or {})
    return opts


def publish_kafka(df: DataFrame, servers: str, topic: str | None = None,
                  max_request_bytes: int | None = None, checkpoint: str | None = None,
                  trigger: dict | None = None):
    """SNK-4/SNK-5: write ``value`` (and optionally ``key``/``topic``) rows
    to Kafka - a batch write, or a stream when ``df`` is streaming (then a
    checkpoint is required).  Needs the Kafka connector on the class path."""
    opts = {"kafka.bootstrap.servers": servers}
    if topic:
        opts["topic"] = topic
    if max_request_bytes:
        opts["kafka.max.request.size"] = str(int(max_request_bytes))
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming publish needs a checkpoint")
        return (df.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or DEFAULT_TRIGGER)).start())
    df.write.format("kafka").options(**opts).save()
    return None


def replay_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = 1, file_glob: str | None = None) -> DataFrame:
    """STM-9: a stored table fed through the streaming path, a few files per
    micro-batch (``maxFilesPerTrigger`` plays the role of the offset limit).
    ``path`` is a folder; ``file_glob`` picks the table's files inside it."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.load(path)


@dataclass
class FailOnce:
    """STM-7 test hook: raise before the write of batch ``batch_id`` - once.

    (The reference's hook fires on every replay of that batch, so its stream
    can never get past it; this one fires a single time.)
    """
    batch_id: int
    fired: bool = field(default=False)

    def __call__(self, batch_id: int) -> None:
        if batch_id == self.batch_id and not self.fired:
            self.fired = True
            raise RuntimeError(f"test failure before the write of batch {batch_id}")


def batch_sink(path: str, partition_cols=(), fmt: str = "parquet",
               preview_rows: int = 5, fail_hook: Callable[[int], None] | None = None,
               on_batch: Callable[[int, int, list], None] | None = None,
               dead_letter_path: str | None = None, table: str | None = None, few: int = 0):
    """SNK-1/SNK-2/SNK-11 + AGG-7 + STM-10: idempotent writer for :func:`run_stream`.

    The row count comes from an ``Observation`` on the write itself (no extra
    job); the preview is ``limit`` on the persisted batch.  ``partition_cols``
    (e.g. ``source_video``) route rows to their source's partition in the
    same single write - never one job per row or per source.

    SNK-11: a failed write is re-raised, so the checkpoint does not advance
    and Spark replays the batch.  With ``dead_letter_path`` the batch is
    instead kept there (tagged with stream, batch id and the whole error, in a
    partition of its own that a replay overwrites) and the stream moves on -
    the data is kept, never silently dropped.  Only a failed write is a dead
    letter: a batch that is in the table is never there too.  ``table`` names the catalog
    table at ``path``; the new partitions are made known to it.

    ``few``: batches are expected to have so many rows at most, of a stream with a row
    limit.  The driver stores such a batch as one file in the same partition, as Spark's
    write of a few rows takes many times as long (:class:`_FewRows`); a batch that has
    more rows all the same is written as any other.
    """
    few_rows = _FewRows(path, few) if few and fmt == "parquet" and not partition_cols and table is None else None

    def _write(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        once = few_rows is not None and few_rows.can_store(batch)
        if not once:
            batch = batch.persist()
        try:
            preview = batch.limit(preview_rows).collect() if preview_rows else []
            if fail_hook is not None:
                fail_hook(batch_id)

            def tagged() -> DataFrame:
                return (batch.withColumn("stream_id", F.lit(stream_id))
                        .withColumn("batch_id", F.lit(batch_id).cast("long")))

            def store(rows_out: DataFrame, where: str, by: tuple) -> None:
                (rows_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(*by, "stream_id", "batch_id").format(fmt).save(where))

            try:
                rows = few_rows.store(batch, batch_id, stream_id) if once else None
                if rows is None:
                    obs = Observation(f"batch_{batch_id}")
                    store(tagged().observe(obs, F.count(F.lit(1)).alias("rows")), path, tuple(partition_cols))
                    rows = obs.get["rows"]
            except Exception as exc:  # noqa: BLE001 - routed or re-raised below
                if dead_letter_path is None:
                    raise
                log.error("batch %s: write failed, kept in %s: %s", batch_id, dead_letter_path, exc)
                store(tagged().withColumn("error", F.lit(str(exc))), dead_letter_path, ())
                rows = 0
            else:
                # a step of its own: the rows are stored, so its failure is no dead letter but a replay of the
                # batch, which overwrites them
                if table is not None:
                    add_partitions(tagged(), table, [*partition_cols, "stream_id", "batch_id"])
            log.info("batch %s: %s rows written to %s", batch_id, rows, path)
            if on_batch is not None:
                on_batch(batch_id, rows, preview)
        finally:
            if not once:
                batch.unpersist()

    return _write


class _FewRows:
    """Batches of a few rows as one Parquet file each, written by the driver into the batch's partition: complete when it
    gets its name, and in place of what an earlier try of the batch left there."""

    def __init__(self, path: str, few: int):
        self.path, self.few, self.table, self.folders = path, few, None, {}

    def can_store(self, batch: DataFrame) -> bool:
        """Whether Arrow knows the table's file system and stores all columns as Spark does."""
        if self.table is None:
            context = batch.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(self.path)
            uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toUri().toASCIIString()
            try:
                self.table = FileSystem.from_uri(uri)
            except ArrowInvalid:
                self.table = ()
        return bool(self.table) and plain_types(batch.schema)

    def store(self, batch: DataFrame, batch_id: int, stream_id: str) -> int | None:
        """Number of rows stored; None, and nothing done, if there are more than a few."""
        rows = batch.limit(self.few + 1).toArrow()
        if rows.num_rows > self.few:
            return None
        if not rows.num_rows:
            return 0
        files, root = self.table
        if stream_id not in self.folders:
            names = batch.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
            self.folders[stream_id] = f"{root}/{names.getPartitionPathString('stream_id', stream_id)}"
        folder, name = f"{self.folders[stream_id]}/batch_id={batch_id}", f"part-00000-{uuid.uuid4()}.snappy.parquet"
        files.create_dir(folder)
        earlier = files.get_file_info(FileSelector(folder))
        write_table(rows.drop_columns([c for c in rows.column_names if c.lower() in ("stream_id", "batch_id")]),
                    f"{folder}/.{name}", filesystem=files, compression="snappy")
        for found in earlier:
            (files.delete_file if found.is_file else files.delete_dir)(found.path)
        files.move(f"{folder}/.{name}", f"{folder}/{name}")
        return rows.num_rows


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The query id that Spark wrote into the checkpoint when it was first used."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def add_partitions(rows: DataFrame, table: str, columns: list[str]) -> None:
    """SNK-6: make the partitions that ``rows`` were written to known to the catalog
    table (one per source and batch; nothing else is listed)."""
    spark = rows.sparkSession
    for values in rows.select(*columns).distinct().collect():
        spec = ", ".join("`%s`=%s" % (c, "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'")
                         for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)


def compact(spark: SparkSession, path: str, into: str, partition_cols=(), fmt: str = "parquet") -> None:
    """Rewrite a sink's many small batch folders as one table with ``partition_cols``
    only (stream and batch ids become columns), for readers; run it between batches."""
    rows = spark.read.format(fmt).load(path)
    spread = rows.repartition(*[F.col(c) for c in partition_cols]) if partition_cols else rows
    spread.write.mode("overwrite").partitionBy(*partition_cols).format(fmt).save(into)


def run_stream(df: DataFrame, sink: Callable[[DataFrame, int, str], None], checkpoint: str,
               trigger: dict | None = None, name: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """STM-1/2/3/6: start ``df`` with a sink called per micro-batch with the
    batch, its id and the stream's identity; a mandatory checkpoint, and append
    mode unless ``df`` aggregates (then ``update`` hands on the changed keys).  ``trigger={"availableNow": True}`` drains the source and
    stops (tests, scheduled runs)."""
    known: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(stream_identity(batch.sparkSession, checkpoint))
        sink(batch, batch_id, known[0])

    writer = (df.writeStream.foreachBatch(each).outputMode(output_mode)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or DEFAULT_TRIGGER)))
    if name:
        writer = writer.queryName(name)
    with _checkpoint_files(df.sparkSession, checkpoint):
        return writer.start()


@contextmanager
def _checkpoint_files(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """Streams started inside write a checkpoint on a local disk by Hadoop's ``FileSystem``, not its ``FileContext``, which
    starts more processes for a log entry (two entries a micro-batch).  An entry is a file that is renamed when complete
    either way.  Other stores, and sessions that name a manager, keep theirs."""
    key = "spark.sql.streaming.checkpointFileManagerClass"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    scheme = jvm.org.apache.hadoop.fs.Path(checkpoint).getFileSystem(conf).getUri().getScheme()
    if scheme != "file" or spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        yield
    finally:
        spark.conf.unset(key)


def drain(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an availableNow query; re-raise its failure."""
    query.awaitTermination(timeout)
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


class ProgressCollector:
    """STM-8: a ``StreamingQueryListener`` that records every progress event.

    With ``path`` the events are stored in a table there, ``flush_every`` at
    a time and at :meth:`close`; without it they stay in the driver's memory.
    The listener's thread and the caller's may flush at the same time: events
    are taken out under a lock, each flush writes a folder of its own, and
    events whose write failed are put back."""

    SCHEMA = "query_id string, batch_id long, input_rows long, input_rate double, process_rate double"

    def __init__(self, spark: SparkSession, path: str | None = None, flush_every: int = 1000):
        from pyspark.sql.streaming import StreamingQueryListener

        collector = self
        self.spark, self.path, self.flush_every, self.events, self.terminated = spark, path, flush_every, [], []
        self._lock = threading.RLock()

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):  # noqa: N802 - Spark callback names
                pass

            def onQueryProgress(self, event):  # noqa: N802
                p = event.progress
                collector.add((str(p.id), p.batchId, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond))

            def onQueryIdle(self, event):  # noqa: N802
                pass

            def onQueryTerminated(self, event):  # noqa: N802
                collector.terminated.append((str(event.id), event.exception))

        self.listener = _Listener()
        spark.streams.addListener(self.listener)

    def add(self, event: tuple) -> None:
        with self._lock:
            self.events.append(event)
            full = self.path is not None and len(self.events) >= self.flush_every
        if full:
            self.flush()

    def flush(self) -> None:
        """Store what has been collected."""
        if not self.path:
            return
        with self._lock:          # one writer; the events belong to it before it starts
            taken, self.events = self.events, []
            if not taken:
                return
            try:
                (self.spark.createDataFrame(taken, self.SCHEMA).coalesce(1)
                 .write.parquet(f"{self.path.rstrip('/')}/flush={uuid.uuid4().hex}"))
            except Exception:
                self.events = taken + self.events
                raise

    def frame(self) -> DataFrame:
        """All events so far."""
        self.flush()
        if self.path and path_exists(self.spark, self.path):
            return self.spark.read.schema(f"{self.SCHEMA}, flush string").parquet(self.path).drop("flush")
        with self._lock:
            return self.spark.createDataFrame(list(self.events), self.SCHEMA)

    def close(self) -> None:
        self.flush()
        self.spark.streams.removeListener(self.listener)


def _progress_dict(p) -> dict:
    if isinstance(p, dict):
        return p
    j = getattr(p, "json", None)
    return json.loads(j() if callable(j) else j)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """STM-8: the query's recent progress as rows (bounded by Spark's
    progress retention, ``spark.sql.streaming.numRecentProgressUpdates``)."""
    rows = []
    for p in map(_progress_dict, query.recentProgress):
        rows.append((p.get("batchId"), p.get("numInputRows"), p.get("inputRowsPerSecond"),
                     p.get("processedRowsPerSecond"),
                     (p.get("durationMs") or {}).get("triggerExecution"), p.get("timestamp")))
    return spark.createDataFrame(rows, "batch_id long, input_rows long, input_rate double, "
                                       "process_rate double, trigger_ms long, timestamp string")


def checkpoint_status(spark: SparkSession, checkpoint: str) -> DataFrame:
    """STM-8: is the job's checkpoint there, how many files and bytes
    (file listing only; contents are not read)."""
    if not path_exists(spark, checkpoint):      # a missing folder means "not running"
        return spark.createDataFrame([(0, 0, False)], "files long, bytes long, exists boolean")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(checkpoint).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0))
                     .alias("bytes")).withColumn("exists", F.col("files") > 0)
