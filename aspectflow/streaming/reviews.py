"""Review stream: messages -> ReviewText -> 8 aspect labels -> table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.schemas import ASPECTS
from aspectflow.sources.messages import parse_reviews
from aspectflow.streaming.pipelines import batch_sink, run_stream

Scorer = Callable[[DataFrame], DataFrame]


def score_reviews(messages: DataFrame, scorer: Scorer, keep=()) -> DataFrame:
    """PRJ-1/3 + ML-2 + PRJ-4/5: parse, drop null reviews, score, keep the
    text and the 8 aspect columns (scoring is row-local, so a label never
    depends on the other rows of the batch)."""
    reviews = parse_reviews(messages, keep=keep)
    scored = scorer(reviews)
    return scored.select(*keep, "ReviewText", *[F.col(a) for a in ASPECTS])


def run_reviews_stream(messages: DataFrame, scorer: Scorer, sink_path: str, checkpoint: str,
                       trigger: dict | None = None, fail_hook=None, keep=(), on_batch=None,
                       table: str | None = None):
    """The review pipeline end to end (STM-2).  Stored rows carry their key
    (``stream_id``, ``batch_id``, ``row_in_batch``) and the time they were
    taken in (DATE-1), by which recent rows are found."""
    store = batch_sink(sink_path, fail_hook=fail_hook, on_batch=on_batch, table=table)

    def sink(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        keyed = batch.withColumn("row_in_batch", F.monotonically_increasing_id())
        store(keyed.withColumn("created_at", F.current_timestamp()), batch_id, stream_id)

    return run_stream(score_reviews(messages, scorer, keep), sink, checkpoint, trigger, name=None)


def recent_reviews(table: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows taken in last, newest first; ties by the rows' key."""
    return table.orderBy(F.col("created_at").desc(), "stream_id", F.col("batch_id").desc(),
                         F.col("row_in_batch").desc()).limit(n)
