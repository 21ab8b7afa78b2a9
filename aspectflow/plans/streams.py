"""Registered stream queries: the driver tables replayed through the
streaming path (file source, availableNow), written by the replay-safe sink,
and read back as a table (without batch id and insertion time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.operators.aspects import predicted_labels
from aspectflow.operators.frames import _with_totals, count_per_frame, vehicle_label, vehicles_only
from aspectflow.plans.tables import load
from aspectflow.schemas import ASPECTS, INFERENCE_RESULT, VEHICLE_NAMES
from aspectflow.session import cut_lineage_columnar, shared_path
from aspectflow.sources.committed import compact as compact_committed
from aspectflow.sources.committed import read_committed, write_committed
from aspectflow.sources.io import ensure_table
from aspectflow.sources.limited import append_feed, feed_stream
from aspectflow.sources.messages import review_messages
from aspectflow.streaming.frames import run_frames_stream
from aspectflow.streaming.pipelines import batch_sink, drain, replay_source, run_stream
from aspectflow.streaming.reviews import run_reviews_stream
from aspectflow.streaming.state import current_grid, current_latest, run_latest_state, run_sentiment_state

AVAILABLE_NOW = {"availableNow": True}


REPLAY_BATCHES = 8         # micro-batches of a replayed table at most: each one meets its static side anew


def _replay(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, one file or a folder of files, through the streaming path."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    stored = spark.read.parquet(path)
    files = stored.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{table}.parquet") and files[0].split("/")[-2] != f"{table}.parquet":
        # a file source reads folders: the one file is picked from the folder it is in
        return replay_source(spark, sf_dir, stored.schema, file_glob=f"{table}.parquet")
    return replay_source(spark, path, stored.schema, max_files_per_trigger=max(1, -(-len(files) // REPLAY_BATCHES)))


def logits_scorer(logits: DataFrame, key: str = "doc_id"):
    """Scorer backed by a table of model logits (8 heads x 4 classes per
    review, e.g. produced by a batch scoring job): a stream-static join on
    the review key, then argmax -> label names.  Reviews without logits get
    NONE for every aspect (as the reference's default label)."""
    side = logits.select(F.col("vec_id").alias(key), "embedding")

    def score(reviews: DataFrame) -> DataFrame:
        joined = reviews.join(side, key, "left")
        return predicted_labels(joined, "embedding", keep=[key, "ReviewText"])

    return score


def q_stream_reviews(spark: SparkSession, d: str) -> DataFrame:
    docs = _replay(spark, d, "documents")
    messages = review_messages(docs, text_col="text", keep=["doc_id"])
    sink = shared_path(spark, "streams", "reviews", unique=True)
    q = run_reviews_stream(messages, logits_scorer(load(spark, d, "embeddings")),
                           sink + "/table", sink + "/checkpoint", AVAILABLE_NOW, keep=["doc_id"])
    drain(q)
    return spark.read.parquet(sink + "/table").select("doc_id", "ReviewText", *ASPECTS)


def q_stream_frames(spark: SparkSession, d: str) -> DataFrame:
    orders = _replay(spark, d, "orders")
    frames = orders.select(
        F.col("o_orderpriority").alias("source_video"), F.col("o_orderkey").alias("frame_id"),
        F.lit(0).alias("video_second"))
    li = load(spark, d, "lineitem")
    det = vehicles_only(li.select(F.col("l_orderkey").alias("frame_id"),
                                  F.col("l_linenumber").alias("class_id"))).withColumn(
        "label", vehicle_label("class_id"))
    # counted once, before the stream starts: a micro-batch only looks its frames up
    per_frame = cut_lineage_columnar(count_per_frame(det.select("frame_id").distinct(), det, "frame_id")
                                     .select("frame_id", *VEHICLE_NAMES), "frame_counts")
    joined = frames.join(per_frame, "frame_id", "left")          # stream-static join
    counted = _with_totals(joined.select(*frames.columns, *[F.coalesce(n, F.lit(0)).alias(n) for n in VEHICLE_NAMES]))
    inference = F.struct(F.col("total_count").cast("int").alias("total_count"),
                         F.col("class_counts"), F.lit("[]").alias("boxes_json"),
                         F.lit("").alias("annotated_b64")).cast(INFERENCE_RESULT)
    with_inf = counted.select("source_video", "frame_id", "video_second",
                              inference.alias("inference"))
    sink = shared_path(spark, "streams", "frames", unique=True)
    q = run_frames_stream(with_inf, sink + "/table", sink + "/checkpoint", trigger=AVAILABLE_NOW)
    drain(q)
    return spark.read.parquet(sink + "/table").select(
        "source_video", "frame_id", "video_second", "total_count", "class_counts", "image_path",
        "annotation_json")


def catalog_sink(spark: SparkSession, d: str, counted: DataFrame) -> DataFrame:
    """Append counted frames batch by batch through the sink, at the location of a catalog
    table, and read the table by its name."""
    root = shared_path(spark, "streams", "catalog", unique=True)
    orders = load(spark, d, "orders").select(F.col("o_orderpriority").alias("source_video"),
                                             F.col("o_orderkey").alias("frame_id"))
    rows = counted.join(orders, "frame_id").select("source_video", "frame_id", "total_count")
    rows.repartition(4).write.parquet(f"{root}/source")
    name = f"frame_results_{root.rsplit('/', 1)[-1]}"
    ensure_table(spark, name, "frame_id BIGINT, total_count INT, source_video STRING, stream_id STRING, batch_id BIGINT",
                 f"{root}/table", ["source_video", "stream_id", "batch_id"])
    stream = replay_source(spark, f"{root}/source", rows.schema, max_files_per_trigger=2)
    drain(run_stream(stream, batch_sink(f"{root}/table", ("source_video",), preview_rows=0, table=name),
                     f"{root}/checkpoint", AVAILABLE_NOW))
    return spark.table(name).select("source_video", "frame_id", "total_count")


def committed_frames(spark: SparkSession, d: str, counted: DataFrame) -> DataFrame:
    """SNK-1, SNK-2: counted frames appended to a table with commits, batch by batch in two runs, compacted in between."""
    root = shared_path(spark, "streams", "committed", unique=True)
    orders = load(spark, d, "orders").select(F.col("o_orderpriority").alias("source_video"), F.col("o_orderkey").alias("frame_id"))
    rows = counted.join(orders, "frame_id").select("source_video", "frame_id", "total_count")
    _in_two_runs(spark, rows, root, lambda s: write_committed(s, f"{root}/table", f"{root}/checkpoint", 2, "source_video", AVAILABLE_NOW))
    compact_committed(spark, f"{root}/table", rows.schema, 1, "source_video")
    return read_committed(spark, f"{root}/table", rows.schema)


def q_stream_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of one stream into one table, the second with a new checkpoint: both runs'
    rows stay.  The table's six files make three micro-batches a run."""
    root = shared_path(spark, "streams", "two_runs", unique=True)
    docs = load(spark, d, "documents").select("doc_id", "text")
    review_messages(docs, text_col="text", keep=["doc_id"]).repartition(6).write.parquet(f"{root}/source")
    schema = spark.read.parquet(f"{root}/source").schema
    scorer = logits_scorer(load(spark, d, "embeddings"))
    for run in (1, 2):
        messages = replay_source(spark, f"{root}/source", schema, max_files_per_trigger=2)
        drain(run_reviews_stream(messages, scorer, f"{root}/table", f"{root}/checkpoint_{run}", AVAILABLE_NOW, keep=["doc_id"]))
    stored = spark.read.parquet(f"{root}/table")
    return stored.groupBy("doc_id").agg(
        F.count("*").alias("n_rows"), F.count_distinct("stream_id").alias("n_streams"),
        F.count_distinct("ReviewText").alias("n_texts"), F.count_distinct("stream_id", "batch_id", "row_in_batch").alias("n_keys"),
        F.count("created_at").alias("n_times"))


def q_stream_batches(spark: SparkSession, d: str) -> DataFrame:
    """Micro-batches of a rate-limited replay: six files, two a batch."""
    root = shared_path(spark, "streams", "batches", unique=True)
    load(spark, d, "orders").select("o_orderkey").repartition(6).write.parquet(f"{root}/source")
    stream = replay_source(spark, f"{root}/source", spark.read.parquet(f"{root}/source").schema, max_files_per_trigger=2)
    drain(run_stream(stream, batch_sink(f"{root}/table", preview_rows=0), f"{root}/checkpoint", AVAILABLE_NOW))
    return spark.read.parquet(f"{root}/table").agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"),
                                                   F.count_distinct("batch_id").alias("n_batches"))


ROWS_A_BATCH = 40


def q_stream_row_limit(spark: SparkSession, d: str) -> DataFrame:
    """STM-4, STM-5: a table as a row-limited stream.  The first half is there when the stream starts; the second comes
    before it starts again from its checkpoint.  What each micro-batch held:"""
    root = shared_path(spark, "streams", "row_limit", unique=True)
    rows = load(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    half = rows.count() // 2
    first = rows.orderBy("s_suppkey").limit(half).agg(F.max("s_suppkey")).first()[0]
    for part in (rows.where(F.col("s_suppkey") <= first), rows.where(F.col("s_suppkey") > first)):
        append_feed(part, f"{root}/feed", ["s_suppkey"])
        stream = feed_stream(spark, f"{root}/feed", rows.schema, ROWS_A_BATCH, checkpoint=f"{root}/checkpoint")
        query = run_stream(stream, batch_sink(f"{root}/table", preview_rows=0, few=ROWS_A_BATCH), f"{root}/checkpoint",
                           {"processingTime": "0 seconds"})
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(f"{root}/table").groupBy("batch_id").agg(
        F.count("*").alias("n_rows"), F.min("s_suppkey").alias("first_key"), F.max("s_suppkey").alias("last_key"),
        F.sum("s_nationkey").cast("long").alias("nations"))


def _in_two_runs(spark: SparkSession, rows: DataFrame, root: str, start) -> None:
    """Feed ``rows`` as six files, two a micro-batch: four files to a first run, two more to a second one that goes on
    from its checkpoint."""
    rows.repartition(6, F.rand(3)).write.parquet(f"{root}/all")
    stored = spark.read.parquet(f"{root}/all")
    parts = stored.withColumn("_part", F.pmod(F.xxhash64(*stored.columns), F.lit(3)))
    for run, chosen in enumerate((parts.where("_part < 2"), parts.where("_part = 2"))):
        chosen.drop("_part").repartition(4 - 2 * run).write.mode("append").parquet(f"{root}/source")
        drain(start(replay_source(spark, f"{root}/source", rows.schema, max_files_per_trigger=2)))


def q_stream_grid_state(spark: SparkSession, d: str) -> DataFrame:
    """AGG-5, JOIN-5: the dashboard grid that a stream of scored reviews keeps, after two runs."""
    root = shared_path(spark, "streams", "grid_state", unique=True)
    labels = predicted_labels(load(spark, d, "embeddings"), "embedding", keep=["vec_id"])
    _in_two_runs(spark, labels, root, lambda s: run_sentiment_state(s, f"{root}/table", f"{root}/checkpoint", AVAILABLE_NOW))
    return current_grid(spark, f"{root}/table")


def q_stream_latest_state(spark: SparkSession, d: str) -> DataFrame:
    """TOP-3: the newest event of every type that a stream keeps, after two runs in random order."""
    root = shared_path(spark, "streams", "latest_state", unique=True)
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    events = load(spark, d, "events").select("event_type", "event_id", micros.alias("ts_us"), "value")
    _in_two_runs(spark, events, root, lambda s: run_latest_state(s, f"{root}/table", f"{root}/checkpoint", "event_type", "ts_us", "event_id",
                                                                AVAILABLE_NOW))
    return current_latest(spark, f"{root}/table", "event_type").select("event_type", "event_id", "ts_us", "value")


STREAM_QUERIES = {"stream_grid_state": q_stream_grid_state, "stream_latest_state": q_stream_latest_state, "stream_row_limit": q_stream_row_limit, "stream_two_runs": q_stream_two_runs, "stream_batches": q_stream_batches, "stream_reviews": q_stream_reviews, "stream_frames": q_stream_frames}


def stream_oracle_sql() -> dict[str, str]:
    from aspectflow.plans.oracle import _aspect_labels, _FRAME_COUNTS

    labels = _aspect_labels()
    return {
        "stream_two_runs": ("SELECT doc_id, 2 * count(*) AS n_rows, 2::BIGINT AS n_streams, count(DISTINCT text) AS n_texts, "
                            "2 * count(*) AS n_keys, 2 * count(*) AS n_times FROM documents WHERE text IS NOT NULL GROUP BY doc_id"),
        "stream_row_limit": (
            "WITH n AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () // 2 AS half FROM supplier), "
            f"b AS (SELECT *, CASE WHEN i < half THEN i // {ROWS_A_BATCH} ELSE ceil(half / {ROWS_A_BATCH}.0)::BIGINT "
            f"+ (i - half) // {ROWS_A_BATCH} END AS batch_id FROM n) SELECT batch_id::INTEGER AS batch_id, count(*) AS n_rows, min(s_suppkey) AS first_key, "
            "max(s_suppkey) AS last_key, sum(s_nationkey)::BIGINT AS nations FROM b GROUP BY batch_id"),
        "stream_batches": "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_orders, 3::BIGINT AS n_batches FROM orders",
        "stream_reviews": (
            f"WITH l AS ({labels}) SELECT d.doc_id, d.text AS ReviewText, "
            + ", ".join(f"coalesce(l.{a}, 'NONE') AS {a}" for a in ASPECTS)
            + " FROM documents d LEFT JOIN l ON d.doc_id = l.vec_id WHERE d.text IS NOT NULL"),
        "stream_frames": _FRAME_COUNTS.replace(
            "fc AS (SELECT o.o_orderkey AS frame_id,",
            "fc AS (SELECT o.o_orderpriority AS source_video, o.o_orderkey AS frame_id,")
        + ("SELECT source_video, frame_id, 0 AS video_second, total_count, "
           "printf('{\"car\": %d, \"motorcycle\": %d, \"bus\": %d, \"truck\": %d}', car, motorcycle, "
           "bus, truck) AS class_counts, '' AS image_path, '[]' AS annotation_json FROM fct"),
    }
