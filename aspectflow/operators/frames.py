"""Camera-frame operators (SRC-8 shaping, PRJ-7/8/12, JOIN-2, AGG-3/4, ARR-3,
BIN-1, JSON-1, MAP-1, UDF-2/4).

Counting is native: conditional counts in a partial aggregate for long-form
detections, or ``size(filter(...))`` for per-frame box arrays.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.codec import b64_decode, counts_json
from aspectflow.schemas import (
    INFERENCE_RESULT, UNKNOWN_VEHICLE, VEHICLE_CLASSES, VEHICLE_NAMES,
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def source_from_topic(topic) -> Column:
    """PRJ-12: topic ``videoN_topic`` -> source ``videoN``."""
    return F.replace(_c(topic), F.lit("_topic"), F.lit(""))


def frame_step(fps) -> Column:
    """Frames per sampled second: int(fps), at least 1 (fps < 1 would divide by 0)."""
    if isinstance(fps, (int, float)):
        return F.lit(max(1, int(fps)))
    return F.greatest(F.lit(1), F.floor(_c(fps)).cast("int"))


def sample_frames(df: DataFrame, fps, frame_col: str = "frame_id") -> DataFrame:
    """PRJ-7: keep one frame per video second and add ``video_second``."""
    k = frame_step(fps)
    f = F.col(frame_col)
    return df.where(f % k == 0).withColumn("video_second", F.call_function("div", f.cast("long"), k.cast("long")))


def vehicle_label(class_id) -> Column:
    """JOIN-2: detector class id -> vehicle name, default ``unknown``."""
    expr = None
    for cid, name in VEHICLE_CLASSES.items():
        expr = (F.when(_c(class_id) == cid, name) if expr is None
                else expr.when(_c(class_id) == cid, name))
    return expr.otherwise(F.lit(UNKNOWN_VEHICLE))


def vehicles_only(detections: DataFrame, class_col: str = "class_id") -> DataFrame:
    """PRJ-8: only the vehicle class ids."""
    return detections.where(F.col(class_col).isin(list(VEHICLE_CLASSES)))


def counts_map() -> Column:
    """MAP-1: the fixed four-key name -> count map (native map column)."""
    return F.create_map(*[x for n in VEHICLE_NAMES for x in (F.lit(n), F.col(n))])


def _with_totals(df: DataFrame) -> DataFrame:
    """AGG-4 total, MAP-1 map and JSON-1 text from the four count columns."""
    total = sum([F.col(n) for n in VEHICLE_NAMES[1:]], F.col(VEHICLE_NAMES[0]))
    return (df.withColumn("total_count", total.cast("int"))
            .withColumn("counts", counts_map())
            .withColumn("class_counts", counts_json([F.col(n) for n in VEHICLE_NAMES])))


def count_per_frame(frames: DataFrame, detections: DataFrame, keys,
                    label_col: str = "label") -> DataFrame:
    """AGG-3/4 + MAP-1: zero-filled counts per frame, total, counts JSON.

    Detections are pre-aggregated by frame (partial aggregate: a frame with
    a third of all detections still ships one row per task), then joined to
    the frames so a frame without detections gets zeros.  ``unknown``
    detections are listed elsewhere but never counted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = detections.groupBy(*keys).agg(
        *[F.count_if(F.col(label_col) == n).cast("int").alias(n) for n in VEHICLE_NAMES])
    out = frames.join(counts, keys, "left")
    filled = [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in VEHICLE_NAMES]
    out = out.select(*[c for c in frames.columns], *filled)
    return _with_totals(out)


def count_boxes(df: DataFrame, boxes_col: str = "boxes") -> DataFrame:
    """AGG-3/4 on per-frame box arrays, with higher-order functions (no shuffle).
    A null box list counts as no boxes."""
    def is_label(name):
        return lambda b: b["label"] == F.lit(name)

    counts = [F.when(F.col(boxes_col).isNull(), F.lit(0))
              .otherwise(F.size(F.filter(F.col(boxes_col), is_label(n)))).alias(n)
              for n in VEHICLE_NAMES]
    out = df.select("*", *counts)
    return _with_totals(out)


def box_struct(label, conf, xyxy) -> Column:
    return F.struct(_c(label).alias("label"), _c(conf).cast("double").alias("conf"),
                    _c(xyxy).cast("array<double>").alias("xyxy"))


def boxes_per_frame(detections: DataFrame, keys, box_col: str = "box") -> DataFrame:
    """ARR-3: the frame's boxes, most confident first (ties on label, coordinates).

    The list is bounded by the detector's per-image detection limit, so the
    per-frame collect is bounded whatever the number of frames.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    b = F.col(box_col)
    keyed = F.struct((-b["conf"]).alias("k"), b["label"].alias("label"), b["conf"].alias("conf"),
                     b["xyxy"].alias("xyxy"))
    grouped = detections.groupBy(*keys).agg(F.array_sort(F.collect_list(keyed)).alias("_b"))
    return grouped.select(*keys, F.transform("_b", lambda x: F.struct(
        x["label"].alias("label"), x["conf"].alias("conf"), x["xyxy"].alias("xyxy"))).alias("boxes"))


def image_path(source, frame_id, has_image, directory: str) -> Column:
    """SNK-3 / STR-6: ``{dir}/{source}_frame_{id}.jpg``, empty without an image."""
    name = F.format_string("%s_frame_%d.jpg", _c(source), _c(frame_id))
    return F.when(has_image, F.concat(F.lit(directory.rstrip("/") + "/"), name)).otherwise(F.lit(""))


def with_inference_defaults(col) -> Column:
    """UDF-4: a failed image yields 0, '{}', '[]', '' (null-safe, native)."""
    s = _c(col)
    return F.struct(
        F.coalesce(s["total_count"], F.lit(0)).alias("total_count"),
        F.coalesce(s["class_counts"], F.lit("{}")).alias("class_counts"),
        F.coalesce(s["boxes_json"], F.lit("[]")).alias("boxes_json"),
        F.coalesce(s["annotated_b64"], F.lit("")).alias("annotated_b64"))


DETECTIONS = "array<struct<cls: int, conf: double, xyxy: array<double>>>"


def detections_udf(detect: Callable[[bytes], list[dict]]):
    """UDF-2/3: Arrow UDF, image bytes in, the detector's raw detections out; null
    where there is no image or the detector fails on it (that row only).

    ``detect(image_bytes) -> [{"cls": int, "conf": float, "xyxy": [4 floats]}]``
    is user code (e.g. a neural detector loaded once per worker).
    """
    def one(image):
        try:
            return None if image is None else [
                {"cls": int(d["cls"]), "conf": float(d["conf"]), "xyxy": [float(v) for v in d["xyxy"]]} for d in detect(image)]
        except Exception:  # noqa: BLE001 - a bad image must not stop the others
            return None

    @F.pandas_udf(DETECTIONS)
    def run(images: pd.Series) -> pd.Series:
        return images.map(one)

    return run


def inference_udf(detect: Callable[[bytes], list[dict]]) -> Callable[[object], Column]:
    """Inference struct of a base64 image column: only the detector is Python.

    Decoding (one tolerant decoder for all paths), labels, counts, total and JSON
    are native expressions; a null or undecodable image, or a failing detector,
    leaves the struct's fields null for ``with_inference_defaults``.
    """
    run = detections_udf(detect)

    def column(b64) -> Column:
        found = run(b64_decode(_c(b64)))
        boxes = F.transform(found, lambda d: F.struct(vehicle_label(d["cls"]).alias("label"),
                                                      d["conf"].alias("conf"), d["xyxy"].alias("xyxy")))

        def number(name: str) -> Column:
            return F.size(F.filter(boxes, lambda x: x["label"] == name))

        ok = found.isNotNull()
        counts = [number(n) for n in VEHICLE_NAMES]
        return F.struct(
            F.when(ok, sum(counts[1:], counts[0])).alias("total_count"),
            F.when(ok, counts_json(counts)).alias("class_counts"),
            F.when(ok, F.to_json(boxes)).alias("boxes_json"),
            F.when(ok, _c(b64)).alias("annotated_b64")).cast(INFERENCE_RESULT)

    return column


def frame_results(df: DataFrame, inference_col: str = "inference", image_dir: str = "") -> DataFrame:
    """PRJ-6: result rows (without id/created_at) from frames + inference struct."""
    inf = with_inference_defaults(F.col(inference_col))
    return df.select(
        "source_video", "frame_id", "video_second",
        inf["total_count"].alias("total_count"), inf["class_counts"].alias("class_counts"),
        image_path("source_video", "frame_id", F.length(inf["annotated_b64"]) > 0, image_dir)
        .alias("image_path"),
        inf["boxes_json"].alias("annotation_json"))


def frame_blobs(df: DataFrame, inference_col: str = "inference", image_dir: str = "") -> DataFrame:
    """SNK-3: annotated images as a binary column beside their path (rows
    without an image, or with undecodable base64, carry none).  Written
    partitioned by source instead of one file per frame from the driver."""
    inf = with_inference_defaults(F.col(inference_col))
    blob = b64_decode(inf["annotated_b64"])
    out = df.select("source_video", "frame_id",
                    image_path("source_video", "frame_id", F.length(inf["annotated_b64"]) > 0,
                               image_dir).alias("image_path"),
                    blob.alias("image"))
    return out.where(F.col("image").isNotNull() & (F.length("image") > 0))
