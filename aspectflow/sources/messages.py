"""Message (de)serialisation for the broker edge (PRJ-1/2/3, SNK-4/5, JSON-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.codec import b64_encode
from aspectflow.schemas import FRAME_MESSAGE, MAX_MESSAGE_BYTES, REVIEW_MESSAGE


def review_messages(df: DataFrame, text_col: str = "Review", keep=()) -> DataFrame:
    """SNK-4: one JSON message ``{"review": text}`` per row (null text stays null:
    the consumer drops it, see Q3)."""
    return df.select(*keep, F.to_json(F.struct(F.col(text_col).cast("string").alias("review")))
                     .alias("value"))


def frame_messages(frames: DataFrame, topic_col: str | None = None,
                   max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """SNK-5: one JSON frame message per frame with its size ``n_bytes`` and
    ``within_limit``: no row is dropped.  Messages above the broker's limit are
    for the caller to route (see :func:`split_oversize`).

    ``frames`` has ``frame_id, video_second, image`` (binary) and either
    ``source_video`` or, with ``topic_col``, a topic from which it is derived.
    """
    from aspectflow.operators.frames import source_from_topic

    source = source_from_topic(topic_col) if topic_col else F.col("source_video")
    body = F.struct(F.col("frame_id").cast("int").alias("frame_id"),
                    F.col("video_second").cast("int").alias("video_second"),
                    b64_encode(F.col("image")).alias("image_b64"),
                    source.alias("source_video"))
    out = frames.select(*([topic_col] if topic_col else []), F.to_json(body).alias("value"))
    return out.withColumn("n_bytes", F.octet_length("value")).withColumn(
        "within_limit", F.col("n_bytes") <= max_bytes)


def split_oversize(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages that the broker takes, rejects to be stored elsewhere)."""
    return messages.where("within_limit"), messages.where("not within_limit")


def parse_reviews(messages: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """PRJ-1 + PRJ-3: bytes -> JSON -> ``ReviewText``; malformed JSON or a
    missing review gives null and the row is dropped (PERMISSIVE)."""
    data = F.from_json(F.col(value_col).cast("string"), REVIEW_MESSAGE)
    return (messages.select(*keep, data.alias("data"))
            .select(*keep, F.col("data.review").alias("ReviewText"))
            .where(F.col("ReviewText").isNotNull()))


def parse_frames(messages: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """PRJ-2: frame messages -> flat columns."""
    data = F.from_json(F.col(value_col).cast("string"), FRAME_MESSAGE)
    return messages.select(*keep, data.alias("data")).select(*keep, "data.*")
