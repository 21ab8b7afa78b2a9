"""Tables kept by streams: late rows, replays and restarts equal a full recomputation."""

import pytest
from pyspark.sql import functions as F

from aspectflow.operators import dashboard as D
from aspectflow.schemas import ASPECTS
from aspectflow.streaming import pipelines as P
from aspectflow.streaming import state as S

NOW = {"availableNow": True}


def _reviews(spark, n):
    names = F.array(*[F.lit(x) for x in ("NONE", "NEG", "POS", "NEU")] + [F.lit(None)])
    # one cell that most rows share
    return spark.range(n).select("id", *[F.when(F.col("id") % 3 > 0, F.lit("POS")).otherwise(
        F.get(names, F.pmod(F.xxhash64("id", F.lit(a)), F.lit(5)).cast("int"))).alias(a) for a in ASPECTS])


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_grid_after_three_batches_and_a_replay(spark, scratch):
    rows = _reviews(spark, 300)
    for i in range(3):
        rows.where(F.col("id") % 3 == i).coalesce(1).write.mode("append").parquet(f"{scratch}/src")
    assert {r["Count"] for r in S.current_grid(spark, f"{scratch}/t").collect()} == {0}
    hook = P.FailOnce(1)
    run = lambda: P.drain(S.run_sentiment_state(P.replay_source(spark, f"{scratch}/src", rows.schema), f"{scratch}/t",
                                                f"{scratch}/ck", NOW, fail_hook=hook))
    with pytest.raises(Exception, match="test failure"):
        run()
    run()
    assert _sorted(S.current_grid(spark, f"{scratch}/t")) == _sorted(D.sentiment_counts(rows))
    late = _reviews(spark, 500).where("id >= 300")
    late.coalesce(1).write.mode("append").parquet(f"{scratch}/src")
    run()
    assert _sorted(S.current_grid(spark, f"{scratch}/t")) == _sorted(D.sentiment_counts(_reviews(spark, 500)))
    # a batch that was stored but not committed is stored again under its own id
    stored = spark.read.parquet(f"{scratch}/t")
    last = stored.agg(F.max("batch_id")).first()[0]
    again = stored.where(F.col("batch_id") == last)
    P.batch_sink(f"{scratch}/t", preview_rows=0)(
        spark.createDataFrame(again.drop("stream_id", "batch_id").collect(), "Aspect string, Sentiment string, Count long"),
        last, again.first()["stream_id"])
    assert _sorted(S.current_grid(spark, f"{scratch}/t")) == _sorted(D.sentiment_counts(_reviews(spark, 500)))


def test_newest_row_with_late_null_and_equal_times(spark, scratch):
    rows = [("a", 5, 1, "x"), ("a", 9, 2, "y"), ("b", None, 3, "n"), (None, 4, 4, "z"), ("a", 9, 7, "w"), ("b", 1, 5, "m"),
            ("a", 2, 6, "late"), (None, 3, 8, "late"), ("b", None, 9, "null")]
    schema = "cam string, at long, id long, v string"
    for i in range(0, 9, 3):
        spark.createDataFrame(rows[i:i + 3], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/src")
        source = P.replay_source(spark, f"{scratch}/src", spark.createDataFrame([], schema).schema)
        P.drain(S.run_latest_state(source, f"{scratch}/t", f"{scratch}/ck", "cam", "at", "id", NOW))
        have = spark.createDataFrame(rows[:i + 3], schema)
        want = D.latest_row(have, "at", by="cam", tie="id")
        key = lambda r: str(r)
        assert sorted((tuple(r) for r in S.current_latest(spark, f"{scratch}/t", "cam").select("cam", "at", "id", "v").collect()), key=key) \
            == sorted((tuple(r) for r in want.select("cam", "at", "id", "v").collect()), key=key)
    assert S.current_latest(spark, f"{scratch}/none", "cam") is None
