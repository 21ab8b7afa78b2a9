"""Batch readers and writers (SRC-3..9, SNK-6..10).

Paths are whatever the cluster shares (HDFS, object store, NFS); nothing here
writes to a machine-local folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aspectflow.schemas import (
    ASPECTS, FRAME_RESULT, PAD_ID, PAD_TOKEN, REGISTRY, UNK_ID, UNK_TOKEN, VOCABULARY, labelled_reviews_schema,
)
from aspectflow.sources.csv_split import read_split_csv


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there.  Any other trouble (permission, unknown
    file system, store down) is raised, never taken for absence."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


# --- CSV -------------------------------------------------------------------------


def read_labelled_csv(spark: SparkSession, path: str, text_col: str = "Review", parallel: bool = True) -> DataFrame:
    """SRC-3: header CSV (UTF-8, quoted multi-line texts) with an explicit
    schema, plus a dense ``row_id`` over all files, by file name and the row's
    place in it (used for first-seen tie-breaks and batch numbering).  A large
    file is read by many tasks; with ``parallel=False`` Spark's own reader
    takes one task a file, which also reads files whose quotes follow no rule."""
    if parallel:
        return read_split_csv(spark, path, labelled_reviews_schema(text_col))
    df = (spark.read.schema(labelled_reviews_schema(text_col))
          .option("header", True).option("multiLine", True).option("encoding", "UTF-8")
          .option("escape", '"').csv(path))
    by_file = df.withColumn("_file", F.input_file_name()).withColumn("_row", F.monotonically_increasing_id())
    # one multi-line file is read by one task, so _row follows the file; files are few and numbered by name
    files = (by_file.groupBy("_file").agg(F.count("*").alias("_n"), F.min("_row").alias("_first")))
    before = F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")
    offsets = files.select("_file", "_first", before.alias("_before"))
    return (by_file.join(F.broadcast(offsets), "_file")      # one row per file
            .withColumn("row_id", F.col("_before") + F.col("_row") - F.col("_first"))
            .drop("_file", "_row", "_first", "_before"))


def read_review_csv(spark: SparkSession, path: str, parallel: bool = True) -> DataFrame:
    """SRC-4: only the first column, as text (nulls stay null and are later
    dropped by the stream; the reference turned them into the word 'nan').
    ``parallel`` as in :func:`read_labelled_csv`."""
    df = (spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8")
          .option("escape", '"').option("inferSchema", False).csv(path))
    first = f"`{df.columns[0]}`"
    if parallel:
        df = read_split_csv(spark, path, df.schema, with_row_id=None)
    return df.select(F.col(first).cast("string").alias("Review"))


# --- vocabulary, encoded features, metrics (SNK-7/8/9, SRC-5/6) --------------------


def save_vocab(vocab: DataFrame, path: str) -> None:
    """SNK-7: persist the vocabulary (version it beside its model: Q8)."""
    vocab.select("token", "id").coalesce(1).write.mode("overwrite").parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: the stored vocabulary, or just <PAD>/<UNK> when it is absent."""
    if path_exists(spark, path):
        return spark.read.schema(VOCABULARY).parquet(path)
    return spark.createDataFrame([(PAD_TOKEN, PAD_ID), (UNK_TOKEN, UNK_ID)], VOCABULARY)


def save_encoded(df: DataFrame, path: str, partition_by=()) -> None:
    """SNK-8: encoded ids + labels (train/validation as a partition column)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6."""
    return spark.read.parquet(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """SNK-9: the one-row metrics document."""
    metrics.select("macro_f1", "balanced_acc").coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("macro_f1 double, balanced_acc double").json(path)


# --- catalog tables (SNK-6, SNK-10) ----------------------------------------------------

def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


RESULTS_DDL = _ddl(FRAME_RESULT) + ", source_video STRING, stream_id STRING, batch_id BIGINT"
REGISTRY_DDL = _ddl(REGISTRY)
SCORED_DDL = "ReviewText STRING, " + ", ".join(f"{a} STRING" for a in ASPECTS) + (
    ", row_in_batch BIGINT, created_at TIMESTAMP, stream_id STRING, batch_id BIGINT")


def ensure_table(spark: SparkSession, name: str, ddl: str, location: str,
                 partitioned_by=()) -> None:
    """SNK-6: create the table if missing (parquet at a shared location)."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part} "
              f"LOCATION '{location}'")


def reset_table(spark: SparkSession, name: str) -> None:
    """SNK-10: empty a table, keeping its definition.

    An overwrite with no rows empties a partitioned table only if it isn't dynamic, so it runs in a session
    of its own with that setting, whatever the caller's says."""
    own = spark.newSession()
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    own.createDataFrame([], own.table(name).schema).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def purge_partition(spark: SparkSession, path: str, column: str, value: str) -> bool:
    """SNK-10: drop one source's stored rows (one camera after its run); False
    if there were none.  The folder name is escaped as Spark's writer does it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"), name)
    fs = target.getFileSystem(conf)
    if not fs.exists(target):
        return False
    if not fs.delete(target, True):
        raise OSError(f"could not delete {target}")
    return True


# --- JDBC (SRC-7, SNK-1 JDBC variant) ---------------------------------------------------


@dataclass(frozen=True)
class JdbcTarget:
    """Where results go; credentials come from the caller, never from code."""
    url: str
    table: str
    driver: str | None = None
    properties: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, **self.properties}
        if self.driver:
            opts["driver"] = self.driver
        return opts


def write_jdbc(df: DataFrame, target: JdbcTarget, mode: str = "append",
               num_partitions: int | None = None) -> None:
    """Batch append over JDBC; ``numPartitions`` caps concurrent connections."""
    w = df.write.format("jdbc").options(**target.options()).mode(mode)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.save()


def route_by_source_jdbc(batch: DataFrame, target_for, source_col: str = "source_video",
                         mode: str = "append") -> list[str]:
    """SNK-2, JDBC variant: one table per source (``target_for(source)``),
    written with one filtered distributed write per distinct source - never
    one job per row.  The distinct sources (cameras) are a handful, so
    listing them on the driver is bounded."""
    sources = [r[0] for r in batch.select(source_col).distinct().collect()]
    for src in sources:
        write_jdbc(batch.where(F.col(source_col) == src).drop(source_col), target_for(src), mode)
    return sources


def read_jdbc(spark: SparkSession, target: JdbcTarget, query: str | None = None) -> DataFrame:
    """SRC-7: a table or a pushed-down query as a DataFrame."""
    opts = target.options()
    if query:
        opts.pop("dbtable")
        opts["query"] = query
    return spark.read.format("jdbc").options(**opts).load()


# --- frames and model files (SRC-8, SRC-9) -----------------------------------------------


def read_frames(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """SRC-8: image files as frame rows.  Two layouts are read: the frame sink's own
    ``<dir>/<source>_frame_<id>.<ext>`` and ``<dir>/<source>/<id>.<ext>``; a file
    that fits neither has null source and frame id."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(path))
    flat = F.regexp_extract("path", r"/([^/]+)_frame_\d+\.[^./]+$", 1)
    nested = F.regexp_extract("path", r"/([^/]+)/\d+\.[^./]+$", 1)
    number = F.regexp_extract("path", r"(?:_frame_|/)(\d+)\.[^./]+$", 1)
    source = F.when(flat != "", flat).when(nested != "", nested)
    return files.select(source.alias("source_video"), number.try_cast("long").alias("frame_id"),
                        F.col("content").alias("image"))


def list_models(spark: SparkSession, path: str, pattern: str = "*.pth") -> DataFrame:
    """SRC-9: model artefacts under ``path``, files or folders whose name fits
    ``pattern`` (names only; nothing is read).  No folder, no artefacts."""
    names: list[tuple[str]] = []
    if path_exists(spark, path):
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(
            jvm.org.apache.hadoop.fs.Path(root, pattern))
        names = sorted((f.getPath().getName(),) for f in found)      # one entry per model version
    return spark.createDataFrame(names, "model_name string")
