"""Frame stream: frame messages -> detections -> counts -> per-camera table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.operators.frames import frame_blobs, frame_results
from aspectflow.operators.ordering import with_row_index
from aspectflow.streaming.pipelines import batch_sink, run_stream

RESULT_COLUMNS = ["id", "source_video", "frame_id", "video_second", "total_count",
                  "class_counts", "image_path", "annotation_json", "created_at"]


def with_result_keys(batch: DataFrame, batch_id: int, handles: list | None = None) -> DataFrame:
    """WIN-3 + DATE-1 for an appended batch: a surrogate key that is unique
    across a stream's batches and identical when the batch is replayed
    (batch_id * 2^32 + dense index in (source, frame) order), and the
    insertion time.  The table's key is (stream_id, id): the sink adds the
    stream's identity."""
    indexed = with_row_index(batch, ["source_video", "frame_id"], "_ri",
                             materialize="persist", handles=handles)
    return indexed.withColumn("id", F.lit(batch_id).cast("long") * F.lit(1 << 32) + F.col("_ri")) \
        .withColumn("created_at", F.current_timestamp()).drop("_ri")


def run_frames_stream(frames: DataFrame, sink_path: str, checkpoint: str,
                      inference_col: str = "inference", image_dir: str = "",
                      trigger: dict | None = None, fail_hook=None, on_batch=None,
                      blob_path: str | None = None, table: str | None = None):
    """SNK-2: every row goes to its camera's partition (``source_video``) in
    one distributed write per micro-batch; no collect, no per-row job.
    With ``blob_path`` the annotated images (SNK-3) are written beside, in
    the same micro-batch, partitioned by source and batch."""
    inner = batch_sink(sink_path, partition_cols=("source_video",), fail_hook=fail_hook,
                       on_batch=on_batch, table=table)
    blobs = batch_sink(blob_path, partition_cols=("source_video",), preview_rows=0) \
        if blob_path else None

    def _sink(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        handles: list = []
        batch = batch.persist()
        try:
            results = frame_results(batch, inference_col, image_dir)
            inner(with_result_keys(results, batch_id, handles), batch_id, stream_id)
            if blobs is not None:
                blobs(frame_blobs(batch, inference_col, image_dir), batch_id, stream_id)
        finally:
            for h in handles:
                h.unpersist()
            batch.unpersist()

    return run_stream(frames, _sink, checkpoint, trigger)
