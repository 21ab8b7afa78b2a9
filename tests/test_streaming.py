import os

import pytest
from pyspark.sql import functions as F

from aspectflow.operators.frames import vehicle_label
from aspectflow.schemas import INFERENCE_RESULT
from aspectflow.sources.messages import review_messages
from aspectflow.streaming import pipelines as P
from aspectflow.streaming.frames import run_frames_stream
from aspectflow.streaming.reviews import run_reviews_stream, score_reviews

NOW = {"availableNow": True}


def _split_copy(df, path, n):
    df.repartition(n).write.mode("overwrite").parquet(path)
    return df.schema


def _upper_scorer(reviews):
    # row-local stand-in scorer: label from text length parity
    lab = F.when(F.length("ReviewText") % 2 == 0, "POS").otherwise("NEG")
    return reviews.select("*", *[lab.alias(a) for a in
                                 ["Price", "Shipping", "Outlook", "Quality", "Size",
                                  "Shop_Service", "General", "Others"]])


def test_review_stream_equals_batch_and_recovers(spark, scratch, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**9, None)], "doc_id long, text string"))
    msgs = review_messages(docs, text_col="text", keep=["doc_id"])
    src = os.path.join(scratch, "src")
    schema = _split_copy(msgs, src, 4)
    stream = P.replay_source(spark, src, schema, max_files_per_trigger=1)
    sink, ckpt = os.path.join(scratch, "sink"), os.path.join(scratch, "ckpt")
    hook = P.FailOnce(2)
    seen = []
    q = run_reviews_stream(stream, _upper_scorer, sink, ckpt, NOW, fail_hook=hook, keep=["doc_id"],
                           on_batch=lambda b, n, prev: seen.append((b, n, len(prev))))
    with pytest.raises(Exception):
        P.drain(q)
    assert hook.fired
    q = run_reviews_stream(P.replay_source(spark, src, schema, max_files_per_trigger=1),
                           _upper_scorer, sink, ckpt, NOW, fail_hook=hook, keep=["doc_id"],
                           on_batch=lambda b, n, prev: seen.append((b, n, len(prev))))
    P.drain(q)
    out = spark.read.parquet(sink)
    batch = score_reviews(msgs, _upper_scorer, keep=["doc_id"])
    assert out.count() == batch.count() == docs.where("text is not null").count()
    assert out.select("doc_id").distinct().count() == out.count()          # no duplicates
    assert sorted(r.batch_id for r in out.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    diff = out.select(*batch.columns).exceptAll(batch)
    assert diff.count() == 0
    assert all(p <= 5 for _, _, p in seen)
    stored = {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert {b: n for b, n, _ in seen} == stored
    assert out.where("created_at is null").count() == 0
    assert out.select("stream_id", "batch_id", "row_in_batch").distinct().count() == out.count()
    prog = P.progress_frame(spark, q)
    assert prog.count() >= 1
    assert P.checkpoint_status(spark, ckpt).first()["exists"]


def test_frame_stream_routes_sources_in_one_write(spark, scratch, sf001):
    orders = spark.read.parquet(f"{sf001}/orders.parquet")
    frames = orders.select(F.when(F.col("o_orderkey") % 3 == 0, "video1").otherwise("video2")
                           .alias("source_video"), F.col("o_orderkey").cast("int").alias("frame_id"),
                           F.lit(0).alias("video_second"))
    src = os.path.join(scratch, "frames")
    schema = _split_copy(frames, src, 2)
    stream = P.replay_source(spark, src, schema, max_files_per_trigger=5)
    inference = F.struct(F.lit(1).alias("total_count"), F.lit('{"car": 1}').alias("class_counts"),
                         F.lit("[]").alias("boxes_json"), F.lit("abc").alias("annotated_b64")
                         ).cast(INFERENCE_RESULT)
    sink, ckpt = os.path.join(scratch, "sink"), os.path.join(scratch, "ckpt")
    blobs = os.path.join(scratch, "blobs")
    q = run_frames_stream(stream.withColumn("inference", inference), sink, ckpt,
                          image_dir="/shared/img", trigger=NOW, blob_path=blobs)
    P.drain(q)
    b = spark.read.parquet(blobs)
    assert b.count() == frames.count() and bytes(b.first().image) == b"i\xb7"
    out = spark.read.parquet(sink)
    assert out.count() == frames.count()
    assert sorted(p for p in os.listdir(sink) if not p.startswith("_")) == ["source_video=video1", "source_video=video2"]
    assert out.select("id").distinct().count() == out.count()
    r = out.where("source_video = 'video1'").first()
    assert r.image_path == f"/shared/img/video1_frame_{r.frame_id}.jpg"


def test_kafka_options():
    o = P.kafka_options("k:9092", "video1_topic,video2_topic", "latest", 10)
    assert o == {"kafka.bootstrap.servers": "k:9092", "subscribe": "video1_topic,video2_topic",
                 "startingOffsets": "latest", "maxOffsetsPerTrigger": "10"}


def test_vehicle_label_default(spark):
    df = spark.createDataFrame([(2,), (3,), (5,), (7,), (1,)], "c int")
    assert [r[0] for r in df.select(vehicle_label("c")).collect()] == [
        "car", "motorcycle", "bus", "truck", "unknown"]


def test_review_stream_with_trained_model_and_listener(spark, scratch):
    from aspectflow.ml import heads as H
    from aspectflow.operators import vocab as V

    rows = [(i, t, (i % 3) + 1, (i % 2) + 1) for i, t in enumerate(
        ["giao hàng nhanh", "giá rẻ", "chất lượng tệ", "đẹp lắm", "size nhỏ", "bình thường"] * 4)]
    train = spark.createDataFrame(rows, "doc_id long, ReviewText string, Price int, Quality int")
    model = H.train_heads(train, V.build_vocab(V.cleaned(train, "ReviewText"), 100),
                          ["Price", "Quality"], max_iter=10)
    msgs = review_messages(train.withColumnRenamed("ReviewText", "text"), text_col="text",
                           keep=["doc_id"])
    src = os.path.join(scratch, "src")
    schema = _split_copy(msgs, src, 3)
    collector = P.ProgressCollector(spark)
    try:
        scorer = H.stream_scorer(model)
        q = run_reviews_stream(P.replay_source(spark, src, schema), scorer,
                               os.path.join(scratch, "sink"), os.path.join(scratch, "ck"), NOW,
                               keep=["doc_id"])
        P.drain(q)
        out = spark.read.parquet(os.path.join(scratch, "sink"))
        batch = H.score(train, model, keep=["doc_id"])
        got = {r.doc_id: (r.Price, r.Quality) for r in out.collect()}
        assert got == {r.doc_id: (r.Price, r.Quality) for r in batch.collect()}
        import time
        for _ in range(50):
            if collector.frame().count() >= 3:
                break
            time.sleep(0.1)
        assert collector.frame().count() >= 3
    finally:
        collector.close()


def test_dead_letter_keeps_failed_batches(spark, scratch):
    src = os.path.join(scratch, "src")
    df = spark.range(20).select(F.col("id").alias("k"), (F.col("id") % 2).alias("v"))
    schema = _split_copy(df, src, 2)
    blocked = os.path.join(scratch, "blocked")
    with open(blocked, "w") as f:          # a file where the sink wants a folder: writes fail
        f.write("x")
    dead = os.path.join(scratch, "dead")
    sink = P.batch_sink(blocked, preview_rows=0, dead_letter_path=dead)
    q = P.run_stream(P.replay_source(spark, src, schema), sink, os.path.join(scratch, "ck"), NOW)
    P.drain(q)                              # no exception: failures were routed
    kept = spark.read.parquet(dead)
    assert kept.count() == 20 and kept.where("error is null").count() == 0
    q2 = P.run_stream(P.replay_source(spark, src, schema), P.batch_sink(blocked, preview_rows=0),
                      os.path.join(scratch, "ck2"), NOW)
    with pytest.raises(Exception):
        P.drain(q2)                         # default: re-raise, the batch is replayed later


def test_streaming_publish_needs_checkpoint(spark, scratch):
    df = spark.range(3).select(F.col("id").cast("string").alias("value"))
    src = os.path.join(scratch, "msgs")
    schema = _split_copy(df, src, 1)
    with pytest.raises(ValueError):
        P.publish_kafka(P.replay_source(spark, src, schema), "k:9092", "reviews")
