"""One key holding a third of all rows: results stay whole and exact, and
the aggregations combine map-side (partial aggregate before the exchange)."""

from pyspark.sql import functions as F

from aspectflow.operators import dashboard as D
from aspectflow.operators import frames as FR
from aspectflow.operators import vocab as V


def _partial_before_exchange(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "partial_" in plan


def test_hot_frame_counts(spark):
    n = 30000
    det = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("frame_id"),
        F.lit(2).alias("class_id"))
    det = det.withColumn("label", FR.vehicle_label("class_id"))
    frames = det.select("frame_id").distinct()
    out = FR.count_per_frame(frames, det, "frame_id")
    hot = out.where("frame_id = 0").first()
    assert hot.car == n // 3 and hot.total_count == n // 3
    assert out.agg(F.sum("total_count")).first()[0] == n
    assert _partial_before_exchange(out)


def test_hot_source_latest_row(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("src"),
        F.col("id").alias("t"))
    got = {r.src: r.t for r in D.latest_row(df, "t", by="src").collect()}
    assert got["hot"] == max(i for i in range(n) if i % 3 == 0)
    assert len(got) == 1 + len({i % 50 for i in range(n) if i % 3})


def test_hot_token_counts(spark):
    texts = [("the " * 200 + f"w{i} x{i % 7}") for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, clean_text string")
    counts = V.token_counts(V.token_positions(docs))
    got = {r.token: (r.cnt, r.first.doc, r.first.pos) for r in counts.collect()}
    assert got["the"] == (200 * 300, 0, 0)
    assert got["x3"][0] == len([i for i in range(300) if i % 7 == 3])
    assert _partial_before_exchange(counts)
