"""Driver tables and how they stand in for the reference's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Stand-in parameters for the registered queries.
METRIC_ASPECTS = ["quality", "toxic"]      # labels columns used as two aspects
FPS = 29.97                               # camera frame rate for sampling
PATIENCE = 10                             # early-stop patience of the retrain job
TOP_WORDS = 10
HEAVY_WORDS, HEAVY_COUNTERS = 25, 1000     # words asked for, counters of a task's summary
LEADERBOARD_K = 30
SAMPLE_ROWS = 300
PREVIEW_ROWS = 10
REVIEW_TOPIC = "reviews"
EPOCH_SECONDS_2024 = 1704067200           # registry clock origin: 2024-01-01 00:00:00 UTC


def load(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A driver table.  ``partitions`` spreads it by a shuffle: for heavy work on a
    file that reads as one task; by default the file's own splits are kept."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def metric_predictions(docs: DataFrame, carry=()) -> DataFrame:
    """Prediction rule on n_chars standing in for a model's two heads."""
    return docs.select(
        "doc_id", *carry,
        (F.col("n_chars") % 4).cast("int").alias("quality"),
        F.when(F.col("n_chars") > 2000, 2).otherwise(1).cast("int").alias("toxic"))


def metric_truth(labels: DataFrame) -> DataFrame:
    """Stored truth = raw label + 1."""
    return labels.select("doc_id", (F.col("quality") + 1).cast("int").alias("quality"),
                         (F.col("toxic") + 1).cast("int").alias("toxic"))
