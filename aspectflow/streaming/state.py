"""Dashboard tables kept up to date by a stream (AGG-5, AGG-6, JOIN-5, TOP-3).

The stream keeps one state per key: a count per (aspect, sentiment) cell, the newest row per camera.  Spark's streaming
aggregates fold each task's rows first, so a key that most rows share costs one row a task, and the state is as large as
the number of keys.  There is no watermark: late rows count like any other.  Each micro-batch stores the keys that it
changed with their new values under its own batch id, so a replay overwrites them; the table's current rows are the
last ones stored for each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aspectflow.operators.aspects import present_aspects
from aspectflow.schemas import ASPECTS, DASHBOARD_SENTIMENTS
from aspectflow.sources.io import path_exists
from aspectflow.streaming.pipelines import batch_sink, run_stream


def run_sentiment_state(scored: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, aspects=ASPECTS,
                        sentiments=DASHBOARD_SENTIMENTS, fail_hook=None) -> StreamingQuery:
    """AGG-5 over a stream of scored reviews: ``path`` keeps the count of every cell that has one."""
    cells = F.array(*[F.struct(F.lit(a).alias("Aspect"), F.col(a).alias("Sentiment")) for a in present_aspects(scored, aspects)])
    counts = scored.select(F.inline(cells)).where(F.col("Sentiment").isin(*sentiments)).groupBy("Aspect", "Sentiment").agg(
        F.count(F.lit(1)).alias("Count"))
    return run_stream(counts, batch_sink(path, preview_rows=0, fail_hook=fail_hook), checkpoint, trigger, output_mode="update")


def current_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The last stored row of every key; None before the first batch.

    A stream stores a key again whenever it changes, so the newest batch holds its value: a hash aggregate on the batch
    number joined back.  A table belongs to one stream."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.parquet(path).drop("stream_id")
    last = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("batch_id").alias("_last"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("batch_id") == F.col("_last")]
    return rows.join(last, same, "left_semi").drop("batch_id")


def current_grid(spark: SparkSession, path: str, aspects=ASPECTS, sentiments=DASHBOARD_SENTIMENTS) -> DataFrame:
    """AGG-5 + JOIN-5: the dense grid as of the last batch, 0 in cells that have no review yet."""
    grid = spark.createDataFrame([(a, s) for a in aspects for s in sentiments], "Aspect string, Sentiment string")
    now = current_rows(spark, path, ["Aspect", "Sentiment"])
    if now is None:
        return grid.withColumn("Count", F.lit(0).cast("long"))
    return grid.join(now, ["Aspect", "Sentiment"], "left").select(
        "Aspect", "Sentiment", F.coalesce("Count", F.lit(0)).cast("long").alias("Count"))


def run_latest_state(rows: DataFrame, path: str, checkpoint: str, by: str, order_col: str, tie: str,
                     trigger: dict | None = None, fail_hook=None) -> StreamingQuery:
    """TOP-3 over a stream: ``path`` keeps the row with the newest ``order_col``, then largest ``tie``, of every ``by``.

    A null time is older than any, and a late row that is older than the kept one changes nothing."""
    values = [c for c in rows.columns if c != by]
    rank = F.struct(F.col(order_col).alias("_o"), F.col(tie).alias("_t"))
    newest = rows.groupBy(by).agg(F.max_by(F.struct(*values), rank).alias("_row"))
    store = batch_sink(path, preview_rows=0, fail_hook=fail_hook)

    def sink(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        store(batch.select(by, "_row.*"), batch_id, stream_id)

    return run_stream(newest, sink, checkpoint, trigger, output_mode="update")


def current_latest(spark: SparkSession, path: str, by: str) -> DataFrame | None:
    return current_rows(spark, path, [by])
