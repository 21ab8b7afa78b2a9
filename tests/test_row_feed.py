"""The row-limited stream source: batch sizes, restarts, start positions."""

import pytest
from pyspark.sql import functions as F

from aspectflow.sources import limited as L
from aspectflow.streaming import pipelines as P

SOON = {"processingTime": "0 seconds"}


def _run(spark, scratch, rows, limit, starting="earliest", chunk=7, name="t"):
    """Drain what the feed holds, then stop; the checkpoint and the table stay."""
    checkpoint = f"{scratch}/ck_{name}"
    stream = L.feed_stream(spark, f"{scratch}/feed", rows.schema, limit, starting, checkpoint, chunk)
    query = P.run_stream(stream, P.batch_sink(f"{scratch}/{name}", preview_rows=0), checkpoint, SOON)
    query.processAllAvailable()
    query.stop()


def _sizes(spark, scratch, name="t"):
    out = spark.read.parquet(f"{scratch}/{name}").groupBy("batch_id").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    return [(r["n"], r["a"], r["b"]) for r in out.orderBy("batch_id").collect()]


def test_ten_rows_a_batch_and_restart(spark, scratch):
    rows = spark.range(25).withColumn("text", F.concat(F.lit("r"), "id")).repartition(4)
    assert L.append_feed(rows, f"{scratch}/feed", ["id"], chunk=7) == 25
    _run(spark, scratch, rows, 10)
    assert _sizes(spark, scratch) == [(10, 0, 9), (10, 10, 19), (5, 20, 24)]
    _run(spark, scratch, rows, 10)                                  # nothing new: no batch, no row twice
    assert len(_sizes(spark, scratch)) == 3
    more = spark.range(25, 44).withColumn("text", F.lit(None).cast("string"))
    assert L.append_feed(more, f"{scratch}/feed", ["id"], chunk=7) == 44
    _run(spark, scratch, rows, 4)                                   # another limit from here on
    assert _sizes(spark, scratch)[3:] == [(4, 25, 28), (4, 29, 32), (4, 33, 36), (4, 37, 40), (3, 41, 43)]
    stored = spark.read.parquet(f"{scratch}/t")
    assert stored.count() == 44 and stored.select("id").distinct().count() == 44
    assert stored.where("text is null").count() == 19


def test_failed_batch_is_read_again(spark, scratch):
    rows = spark.range(30)
    L.append_feed(rows, f"{scratch}/feed", ["id"], chunk=7)
    checkpoint = f"{scratch}/ck"
    hook = P.FailOnce(1)

    def start():
        stream = L.feed_stream(spark, f"{scratch}/feed", rows.schema, 10, checkpoint=checkpoint, chunk=7)
        return P.run_stream(stream, P.batch_sink(f"{scratch}/t", preview_rows=0, fail_hook=hook), checkpoint, SOON)

    query = start()
    with pytest.raises(Exception, match="test failure"):
        query.awaitTermination(60)
    query = start()
    query.processAllAvailable()
    query.stop()
    assert _sizes(spark, scratch) == [(10, 0, 9), (10, 10, 19), (10, 20, 29)]


def test_latest_start_sees_only_what_comes_after(spark, scratch):
    rows = spark.range(12)
    L.append_feed(rows, f"{scratch}/feed", ["id"], chunk=7)
    checkpoint = f"{scratch}/ck_t"
    stream = L.feed_stream(spark, f"{scratch}/feed", rows.schema, 5, "latest", checkpoint, 7)
    query = P.run_stream(stream, P.batch_sink(f"{scratch}/t", preview_rows=0), checkpoint, SOON)
    query.processAllAvailable()
    L.append_feed(spark.range(12, 20), f"{scratch}/feed", ["id"], chunk=7)
    query.processAllAvailable()
    query.stop()
    assert _sizes(spark, scratch) == [(5, 12, 16), (3, 17, 19)]


def test_no_limit_empty_feed_and_bad_options(spark, scratch):
    rows = spark.range(0)
    assert L.append_feed(rows, f"{scratch}/feed", ["id"]) == 0
    assert L.append_feed(spark.range(40), f"{scratch}/feed", ["id"], chunk=7) == 40
    _run(spark, scratch, rows, None)
    assert _sizes(spark, scratch) == [(40, 0, 39)]
    with pytest.raises(FileNotFoundError):
        L.feed_stream(spark, f"{scratch}/nowhere", rows.schema)
    with pytest.raises(Exception, match="checkpointLocation|startingOffsets"):
        q = L.feed_stream(spark, f"{scratch}/feed", rows.schema, 5).writeStream.format("noop").option(
            "checkpointLocation", f"{scratch}/ck2").start()
        q.processAllAvailable()


def test_five_second_trigger(spark, scratch):
    """STM-1: under the default trigger, a batch after one that was in time starts at a multiple of five seconds."""
    from datetime import datetime

    L.append_feed(spark.range(18), f"{scratch}/feed", ["id"])
    checkpoint = f"{scratch}/ck"
    query = P.run_stream(L.feed_stream(spark, f"{scratch}/feed", spark.range(1).schema, 6, checkpoint=checkpoint),
                         P.batch_sink(f"{scratch}/t", preview_rows=0), checkpoint)
    query.processAllAvailable()
    query.stop()
    assert _sizes(spark, scratch) == [(6, 0, 5), (6, 6, 11), (6, 12, 17)]
    done = {p["batchId"]: (datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp(), p["durationMs"]["triggerExecution"] / 1000)
            for p in map(P._progress_dict, query.recentProgress) if p["numInputRows"]}
    due = {b: (done[b - 1][0] // 5 + 1) * 5 for b in (1, 2)}
    in_time = [b for b in due if done[b - 1][0] + done[b - 1][1] < due[b]]
    assert in_time and all(abs(done[b][0] - due[b]) < 0.5 for b in in_time)


def _medians(spark, scratch, name, few):
    """A run of 30 batches of 10 rows: medians in ms of the last 20 batches' whole time."""
    checkpoint = f"{scratch}/ck_{name}"
    stream = L.feed_stream(spark, f"{scratch}/feed", spark.range(1).schema, 10, checkpoint=checkpoint)
    query = P.run_stream(stream, P.batch_sink(f"{scratch}/{name}", preview_rows=0, few=few), checkpoint, SOON)
    query.processAllAvailable()
    query.stop()
    took = [p["durationMs"]["triggerExecution"] for p in map(P._progress_dict, query.recentProgress) if p["numInputRows"]]
    assert len(took) == 30
    return sorted(took[10:])[10]


def test_few_rows_a_batch_cost_less(spark, scratch):
    """a batch of a few rows is stored by the driver, in well under the time of a Spark write, and alike."""
    L.append_feed(spark.range(300), f"{scratch}/feed", ["id"])
    _medians(spark, scratch, "warm", 0)
    assert _medians(spark, scratch, "few", 10) < 0.7 * _medians(spark, scratch, "t", 0)
    assert _sizes(spark, scratch, "few") == _sizes(spark, scratch, "t") == [(10, 10 * b, 10 * b + 9) for b in range(30)]
    assert spark.read.parquet(f"{scratch}/few").schema == spark.read.parquet(f"{scratch}/t").schema


def test_few_rows_are_planned_with_the_trigger_and_many_by_tasks(spark, scratch):
    L.append_feed(spark.range(30), f"{scratch}/feed", ["id"], chunk=7)
    options = {"path": f"{scratch}/feed", "checkpointLocation": f"{scratch}/ck", "chunk": "7", "rowsPerTrigger": "10"}
    few = L.RowFeed(options)
    with pytest.raises(NotImplementedError):
        few.streamReader(spark.range(1).schema)
    reader = few.simpleStreamReader(spark.range(1).schema)
    got, at = [], reader.initialOffset()
    for _ in range(4):
        batches, at = reader.read(at)
        got.append([v for b in batches for v in b.column(0).to_pylist()])
    assert got == [list(range(10)), list(range(10, 20)), list(range(20, 30)), []] and at == {"offset": 30}
    again = reader.readBetweenOffsets({"offset": 5}, {"offset": 22})
    assert [v for b in again for v in b.column(0).to_pylist()] == list(range(5, 22))
    for limit in ("0", str(L.FEW + 1)):
        assert isinstance(L.RowFeed({**options, "rowsPerTrigger": limit}).streamReader(spark.range(1).schema), L._FeedReader)


def test_few_rows_are_stored_as_spark_would(spark, scratch):
    """Replays, more rows than expected, no rows, types and names, paths: the same table either way."""
    odd = spark.createDataFrame([(1, "ä\n", 1.5, True, bytearray(b"x")), (2, None, float("nan"), None, None)],
                                "id long, `a b` string, v float, ok boolean, b binary")
    dated = spark.sql("SELECT 7L AS id, DATE'1500-01-01' AS d, array(1, 2) AS l")
    batches = {"odd": odd, "dated": dated, "many": spark.range(25), "none": spark.range(0), "parts": spark.range(5).repartition(3)}
    for name, batch in batches.items():
        tables = f"{scratch}/a b%20ä/{name}_few", f"{scratch}/a b%20ä/{name}_spark"
        seen = []
        for path, few in zip(tables, (10, 0)):
            sink = P.batch_sink(path, preview_rows=2, few=few, on_batch=lambda *done: seen.append(done))
            for i in (0, 0, 1):
                sink(batch, i, "s=/1")
        assert len(seen) == 6 and [str(s) for s in seen[:3]] == [str(s) for s in seen[3:]] and seen[0][1] == batch.count()
        if name != "none":
            a, b = (spark.read.parquet(t) for t in tables)
            assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_few_rows_replace_an_earlier_try(spark, scratch):
    spark_sink, few_sink = (P.batch_sink(f"{scratch}/t", preview_rows=0, few=few) for few in (0, 9))
    for first, second in ((spark_sink, few_sink), (few_sink, spark_sink), (few_sink, few_sink)):
        first(spark.range(8).repartition(4), 3, "s")
        second(spark.range(100, 105), 3, "s")
        assert [r["id"] for r in spark.read.parquet(f"{scratch}/t").orderBy("id").collect()] == list(range(100, 105))


def test_few_rows_that_fail_are_dead_letters_or_raise(spark, scratch):
    with open(f"{scratch}/blocked", "w") as f:
        f.write("x")
    with pytest.raises(Exception):
        P.batch_sink(f"{scratch}/blocked", preview_rows=0, few=9)(spark.range(3), 0, "s")
    P.batch_sink(f"{scratch}/blocked", preview_rows=0, few=9, dead_letter_path=f"{scratch}/dead")(spark.range(3), 0, "s")
    kept = spark.read.parquet(f"{scratch}/dead")
    assert kept.count() == 3 and kept.where("length(error) > 0").count() == 3


def test_checkpoint_files_keep_a_named_manager(spark, scratch):
    key = "spark.sql.streaming.checkpointFileManagerClass"
    with P._checkpoint_files(spark, f"{scratch}/ck"):
        assert spark.conf.get(key).endswith("FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "some.Manager")
    try:
        with P._checkpoint_files(spark, f"{scratch}/ck"):
            assert spark.conf.get(key) == "some.Manager"
        assert spark.conf.get(key) == "some.Manager"
    finally:
        spark.conf.unset(key)
