"""Behaviour that the registered queries can't show: odd inputs of readers, sink, early stop and decoders."""

import base64
import json
import math
import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from aspectflow import jobs
from aspectflow.functions.codec import b64_decode
from aspectflow.operators import frames as FR
from aspectflow.operators import history as H
from aspectflow.operators import vocab as V
from aspectflow.sources import io as IO
from aspectflow.sources.messages import frame_messages, split_oversize
from aspectflow.streaming import pipelines as P

NOW = {"availableNow": True}


def _files(spark, path, n, files):
    spark.range(n).repartition(files).write.parquet(path)
    return spark.read.parquet(path).schema


def test_sink_keeps_rows_of_a_run_with_a_new_checkpoint(spark, scratch):
    schema = _files(spark, f"{scratch}/a", 30, 3)
    for run in (1, 2):
        P.drain(P.run_stream(P.replay_source(spark, f"{scratch}/a", schema), P.batch_sink(f"{scratch}/t", preview_rows=0),
                             f"{scratch}/ck{run}", NOW))
    out = spark.read.parquet(f"{scratch}/t")
    assert out.count() == 60 and out.select("stream_id").distinct().count() == 2
    assert {r["count"] for r in out.groupBy("id").count().collect()} == {2}


def test_replayed_batch_and_dead_letter_are_stored_once(spark, scratch):
    rows = spark.range(3)
    sink = P.batch_sink(f"{scratch}/t", preview_rows=0)
    for _ in range(2):
        sink(rows, 5, "s")
    assert spark.read.parquet(f"{scratch}/t").count() == 3
    with open(f"{scratch}/blocked", "w") as f:
        f.write("x")
    dead = P.batch_sink(f"{scratch}/blocked", preview_rows=0, dead_letter_path=f"{scratch}/dead")
    for _ in range(2):
        dead(rows, 5, "s")
    kept = spark.read.parquet(f"{scratch}/dead")
    assert kept.count() == 3 and kept.where("length(error) > 0").count() == 3


def test_progress_goes_to_a_table(spark, scratch):
    schema = _files(spark, f"{scratch}/a", 9, 3)
    collector = P.ProgressCollector(spark, f"{scratch}/progress", flush_every=2)
    try:
        P.drain(P.run_stream(P.replay_source(spark, f"{scratch}/a", schema), P.batch_sink(f"{scratch}/t"), f"{scratch}/ck", NOW))
        import time
        for _ in range(50):
            if collector.frame().where("input_rows > 0").count() >= 3:
                break
            time.sleep(0.1)
    finally:
        collector.close()
    assert spark.read.parquet(f"{scratch}/progress").where("input_rows > 0").select("batch_id").distinct().count() == 3


def test_progress_of_two_threads_is_stored_once(spark, scratch):
    """The listener's thread and the caller's add and flush at once: every event is stored exactly once."""
    from concurrent.futures import ThreadPoolExecutor

    collector = P.ProgressCollector(spark, f"{scratch}/progress", flush_every=7)
    try:
        def add(worker):
            for i in range(60):
                collector.add((f"q{worker}", i, 1, 1.0, 1.0))
                if i % 20 == 0:
                    collector.frame()
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(add, range(3)))
        out = collector.frame()
        assert out.count() == 180 and out.select("query_id", "batch_id").distinct().count() == 180
    finally:
        collector.close()


def test_events_of_a_failed_flush_are_kept(spark, scratch):
    with open(f"{scratch}/file", "w") as f:
        f.write("x")
    collector = P.ProgressCollector(spark, f"{scratch}/file/progress")
    try:
        collector.add(("q", 1, 1, 1.0, 1.0))
        with pytest.raises(Exception):
            collector.flush()
        assert [e[1] for e in collector.events] == [1]
        collector.path = f"{scratch}/progress"
        assert collector.frame().count() == 1
    finally:
        collector.close()


def test_failed_catalog_step_is_no_dead_letter(spark, scratch):
    sink = P.batch_sink(f"{scratch}/t", preview_rows=0, dead_letter_path=f"{scratch}/dead", table="no_such_table")
    for _ in range(2):          # the batch is replayed, and still stored once
        with pytest.raises(Exception, match="no_such_table"):
            sink(spark.range(3), 5, "s")
    assert spark.read.parquet(f"{scratch}/t").count() == 3 and not os.path.exists(f"{scratch}/dead")


def test_reset_empties_a_partitioned_table_whatever_the_overwrite_mode(spark, scratch):
    from aspectflow.sources import io as IO

    IO.ensure_table(spark, "reset_parts_t", "id BIGINT, k STRING", f"{scratch}/r", ["k"])
    spark.sql("INSERT INTO reset_parts_t VALUES (1, 'a'), (2, 'b')")
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        IO.reset_table(spark, "reset_parts_t")
        assert spark.table("reset_parts_t").count() == 0
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)
    spark.sql("INSERT INTO reset_parts_t VALUES (3, 'c')")
    assert [r["id"] for r in spark.table("reset_parts_t").collect()] == [3]


def test_compaction_keeps_rows(spark, scratch):
    sink = P.batch_sink(f"{scratch}/t", ("k",), preview_rows=0)
    for b in range(4):
        sink(spark.range(10).withColumn("k", F.col("id") % 2), b, "s")
    P.compact(spark, f"{scratch}/t", f"{scratch}/c", ("k",))
    assert spark.read.parquet(f"{scratch}/c").count() == 40
    assert len([f for d in os.listdir(f"{scratch}/c") if "=" in d for f in os.listdir(f"{scratch}/c/{d}") if f.endswith(".parquet")]) == 2


def test_review_csv_with_quotes_commas_and_lines(spark, scratch):
    os.mkdir(f"{scratch}/c")
    with open(f"{scratch}/c/a.csv", "w", encoding="utf-8") as f:
        f.write('Review,Other\n"He said ""hi, there"", ok",1\n"hai\ndòng",2\n,3\n')
    assert [r[0] for r in IO.read_review_csv(spark, f"{scratch}/c").collect()] == ['He said "hi, there", ok', "hai\ndòng", None]


def test_labelled_csv_numbers_rows_by_file(spark, scratch):
    os.mkdir(f"{scratch}/c")
    header = "Review," + ",".join(IO.ASPECTS)
    for name, n in (("b", 50), ("a", 3), ("c", 2)):
        with open(f"{scratch}/c/{name}.csv", "w", encoding="utf-8") as f:
            f.write(header + "\n" + "".join(f'"{name}\n{i}",' + ",".join("0" * len(IO.ASPECTS)) + "\n" for i in range(n)))
    got = sorted((r.row_id, r.Review) for r in IO.read_labelled_csv(spark, f"{scratch}/c").collect())
    assert got == list(enumerate([f"{f}\n{i}" for f, n in (("a", 3), ("b", 50), ("c", 2)) for i in range(n)]))


def test_frame_files_of_both_layouts(spark, scratch):
    for name in ("img/video1_frame_12.jpg", "img/cam_a_frame_3.jpg", "img/video2/7.jpg", "img/cover.jpg", "img/v_frame_99999999999999999999.jpg"):
        os.makedirs(os.path.dirname(f"{scratch}/{name}"), exist_ok=True)
        with open(f"{scratch}/{name}", "wb") as f:
            f.write(b"x")
    got = {(r.source_video, r.frame_id) for r in IO.read_frames(spark, f"{scratch}/img").collect()}
    assert got == {("video1", 12), ("cam_a", 3), ("video2", 7), (None, None), ("v", None)}


def test_models_are_folders_or_files(spark, scratch):
    os.makedirs(f"{scratch}/m/cnn_v2.pth/pipeline")
    open(f"{scratch}/m/cnn_v1.pth", "w").close()
    open(f"{scratch}/m/readme.txt", "w").close()
    assert sorted(r[0] for r in IO.list_models(spark, f"{scratch}/m").collect()) == ["cnn_v1.pth", "cnn_v2.pth"]


def test_unreadable_registry_is_an_error_and_a_missing_one_is_empty(spark, scratch):
    assert jobs.read_registry(spark, f"{scratch}/none").count() == 0
    with pytest.raises(Exception):
        jobs.read_registry(spark, "nosuchfs://host/registry").count()
    with pytest.raises(Exception):
        IO.read_vocab(spark, "nosuchfs://host/vocab").count()


def test_purge_escapes_names_and_reports(spark, scratch):
    spark.createDataFrame([("a b:c", 1), ("d", 2)], "s string, v int").write.partitionBy("s").parquet(f"{scratch}/p")
    assert IO.purge_partition(spark, f"{scratch}/p", "s", "a b:c") and not IO.purge_partition(spark, f"{scratch}/p", "s", "zz")
    assert [r.v for r in spark.read.parquet(f"{scratch}/p").collect()] == [2]


def test_oversize_messages_are_kept_apart(spark):
    frames = spark.createDataFrame([("v", 1, 0, b"x"), ("v", 2, 0, b"x" * 5000)],
                                   "source_video string, frame_id int, video_second int, image binary")
    fits, rejects = split_oversize(frame_messages(frames, max_bytes=1000))
    assert (fits.count(), rejects.count()) == (1, 1) and rejects.first().n_bytes > 5000


def _loop(losses, patience):
    best, at, streak = math.inf, None, 0
    for epoch, loss in enumerate(losses, 1):
        if loss is not None and loss < best:
            best, at, streak = loss, epoch, 0
        else:
            streak += 1
        if streak >= patience:
            return epoch, at, epoch
    return None, at, len(losses)


def test_early_stop_equals_a_plain_loop_on_odd_losses(spark):
    nan, inf = math.nan, math.inf
    runs = {1: [nan] * 6, 2: [nan, 3.0, 2.0, nan, inf, 2.5, 1.0], 3: [inf, inf, 1.0, 0.5], 4: [None, 2.0, None, None, None],
            5: [3.0, 2.0, 1.0], 6: [1.0, 2.0, 3.0, 0.5], 7: [inf]}
    rows = [(r, i, v) for r, ls in runs.items() for i, v in enumerate(ls, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, val_loss double")
    for stop in (H.early_stop, H.early_stop_scan):
        got = {r.run: (r.stop_epoch, r.best_epoch, r.epochs_run) for r in stop(df, 3).collect()}
        assert got == {r: _loop(ls, 3) for r, ls in runs.items()}, stop.__name__


def test_epochs_are_numbered_without_a_window_over_a_run(spark):
    df = spark.createDataFrame([(i % 3, 100 - i) for i in range(90)], "run long, t long")
    out = H.numbered_epochs(df, "run", ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(run" not in plan.split("Window")[0] or "Window [" not in plan
    got = {}
    for r in out.collect():
        got.setdefault(r.run, []).append((r.epoch, r.t))
    assert all([e for e, _ in sorted(v)] == list(range(1, 31)) and [t for _, t in sorted(v)] == sorted(t for _, t in v) for v in got.values())


def test_both_encoders_agree_on_nulls_repeats_and_kept_columns(spark):
    docs = spark.createDataFrame([(1, "a b zz", 5), (1, "a b zz", 6), (2, None, 7), (3, "", 8), (None, "b", 9)],
                                 "doc_id long, clean_text string, lab int")
    vocab = spark.createDataFrame([("<PAD>", 0), ("<UNK>", 1), ("a", 2), ("b", 3)], "token string, id int")
    arrow = V.encode(docs, vocab, keep=["lab"])
    join = V.encode(docs, vocab, engine="join", keep=["lab"])
    assert arrow.schema.simpleString() == join.schema.simpleString()
    rows = lambda df: sorted((r.lab, r.doc_id, r.ids) for r in df.collect())
    assert rows(arrow) == rows(join) == [(5, 1, [2, 3, 1]), (6, 1, [2, 3, 1]), (7, 2, None), (8, 3, []), (9, None, [3])]
    with pytest.raises(ValueError):
        V.encode(docs, vocab, engine="other")


def test_wrapped_junk_and_null_base64(spark):
    raw = bytes(range(256))
    texts = [base64.b64encode(raw).decode(), base64.encodebytes(raw).decode(), base64.b64encode(raw).decode() + "\r\n", "@@@", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [None if r[0] is None else bytes(r[0]) for r in df.select(b64_decode("t")).collect()] == [raw] * 3 + [None] * 2
    infer = FR.inference_udf(lambda image: [{"cls": 2, "conf": 0.5, "xyxy": [0, 0, 1, len(image)]}] * 2)
    got = df.select(infer("t").alias("i")).select("i.*").collect()
    assert [r.total_count for r in got] == [2, 2, 2, None, None]
    assert json.loads(got[1].boxes_json)[0] == {"label": "car", "conf": 0.5, "xyxy": [0.0, 0.0, 1.0, 256.0]}
    assert json.loads(got[0].class_counts) == {"car": 2, "motorcycle": 0, "bus": 0, "truck": 0}


def test_latest_row_is_a_hash_aggregate_with_a_tie_break(spark):
    from aspectflow.operators import dashboard as D
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), (None, 5, 5)], "s string, t int, id int")
    out = D.latest_row(df, "t", by="s", tie="id")
    assert {(r.s, r.id) for r in out.collect()} == {("a", 3), ("b", 4), (None, 5)}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def _plain(text):
    return unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", text) if not "\u0300" <= x <= "\u036f"))


def test_tone_removal_over_all_of_unicode(spark):
    from random import Random

    from aspectflow.functions.text import remove_tone
    texts = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    rnd = Random(1)
    some = [c for c in texts if unicodedata.normalize("NFD", c) != c or unicodedata.combining(c)] + list("aeouAEd가ᄀ ")
    texts += ["".join(rnd.choice(some) for _ in range(rnd.randint(2, 6))) for _ in range(20000)]
    texts += [unicodedata.normalize("NFD", t) for t in ("tiếng Việt đẹp", "한국어", "é가")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    wrong = [(ascii(texts[r.i]), ascii(r.p)) for r in df.select("i", remove_tone("c").alias("p")).collect() if r.p != _plain(texts[r.i])]
    assert not wrong, (len(wrong), wrong[:20])


def test_unset_checkpoint_folder_is_an_error_on_a_cluster_only(monkeypatch):
    from types import SimpleNamespace

    from aspectflow import session as S

    made = {}
    spark = SimpleNamespace(
        sparkContext=SimpleNamespace(master="local[4]", setCheckpointDir=lambda d: made.update(ctx=d)),
        conf=SimpleNamespace(get=lambda k: "file:/w", set=lambda k, v: made.update({k: v})))
    monkeypatch.setattr(S, "checkpoint_root", lambda s: None)
    assert S._root(spark).startswith("file:/w/") and made["ctx"] == made["spark.checkpoint.dir"]
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,1000]", "k8s://x"):
        spark.sparkContext.master = master
        with pytest.raises(RuntimeError):
            S._root(spark)
