import os


from aspectflow.operators.vocab import build_vocab
from aspectflow.sources import io as IO
from aspectflow.sources.messages import frame_messages, parse_frames, parse_reviews, review_messages
from aspectflow.sources.tables import dataset_shape, union_sources


def test_labelled_csv_multiline(spark, scratch):
    path = os.path.join(scratch, "train.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Review,Price,Shipping,Outlook,Quality,Size,Shop_Service,General,Others\n")
        f.write('"Giày đẹp, giao nhanh",1,1,-1,-1,-1,-1,1,-1\n')
        f.write('"dòng một\ndòng hai",0,-1,-1,2,-1,-1,-1,-1\n')
    df = IO.read_labelled_csv(spark, path).orderBy("row_id").collect()
    assert len(df) == 2 and df[1].Review == "dòng một\ndòng hai" and df[1].Quality == 2
    first = IO.read_review_csv(spark, path).collect()
    assert first[0].Review == "Giày đẹp, giao nhanh"


def test_vocab_roundtrip_and_fallback(spark, scratch):
    docs = spark.createDataFrame([(0, "a b a")], "doc_id long, clean_text string")
    IO.save_vocab(build_vocab(docs, 10), os.path.join(scratch, "vocab"))
    got = {r.token: r.id for r in IO.read_vocab(spark, os.path.join(scratch, "vocab")).collect()}
    assert got == {"<PAD>": 0, "<UNK>": 1, "a": 2, "b": 3}
    miss = {r.token: r.id for r in IO.read_vocab(spark, os.path.join(scratch, "nope")).collect()}
    assert miss == {"<PAD>": 0, "<UNK>": 1}


def test_metrics_and_encoded_roundtrip(spark, scratch):
    m = spark.createDataFrame([(0.5, 0.25)], "macro_f1 double, balanced_acc double")
    IO.save_metrics(m, os.path.join(scratch, "metrics"))
    assert IO.read_metrics(spark, os.path.join(scratch, "metrics")).first().macro_f1 == 0.5
    enc = spark.createDataFrame([(1, [2, 3], "train"), (2, [4], "val")], "id long, ids array<int>, split string")
    IO.save_encoded(enc, os.path.join(scratch, "enc"), partition_by=["split"])
    assert IO.read_encoded(spark, os.path.join(scratch, "enc")).where("split = 'val'").count() == 1


def test_tables_create_reset_purge(spark, scratch):
    loc = os.path.join(scratch, "reg")
    IO.ensure_table(spark, "registry_t", IO.REGISTRY_DDL, loc)
    IO.ensure_table(spark, "registry_t", IO.REGISTRY_DDL, loc)   # idempotent
    spark.createDataFrame([(1, "cnn_v1.pth", 0.5, 0.5, None)], spark.table("registry_t").schema) \
        .write.insertInto("registry_t")
    assert spark.table("registry_t").count() == 1
    IO.reset_table(spark, "registry_t")
    assert spark.table("registry_t").count() == 0
    res = os.path.join(scratch, "res")
    spark.createDataFrame([("v1", 1), ("v2", 2)], "source_video string, frame_id int") \
        .write.partitionBy("source_video").parquet(res)
    IO.purge_partition(spark, res, "source_video", "v1")
    assert [r.source_video for r in spark.read.parquet(res).collect()] == ["v2"]


def test_frames_and_models_listing(spark, scratch):
    for src, n in [("video1", 2), ("video2", 1)]:
        os.makedirs(os.path.join(scratch, "frames", src))
        for i in range(n):
            with open(os.path.join(scratch, "frames", src, f"{i * 30}.jpg"), "wb") as f:
                f.write(b"\xff\xd8" + bytes([i]))
    fr = IO.read_frames(spark, os.path.join(scratch, "frames")).collect()
    assert sorted((r.source_video, r.frame_id) for r in fr) == [("video1", 0), ("video1", 30), ("video2", 0)]
    os.makedirs(os.path.join(scratch, "models"))
    with open(os.path.join(scratch, "models", "cnn_v3.pth"), "wb") as f:
        f.write(b"weights")
    assert [r.model_name for r in IO.list_models(spark, os.path.join(scratch, "models")).collect()] == ["cnn_v3.pth"]
    assert IO.list_models(spark, os.path.join(scratch, "none")).count() == 0


def test_messages_roundtrip_and_permissive(spark):
    df = spark.createDataFrame([(1, "xin chào"), (2, None)], "id int, Review string")
    msgs = review_messages(df, keep=["id"])
    junk = spark.createDataFrame([(3, "{not json"), (4, '{"id": "x"}'), (5, '{"review": 12, "extra": 1}')],
                                 "id int, value string")
    got = {r.id: r.ReviewText for r in parse_reviews(msgs.unionByName(junk), keep=["id"]).collect()}
    assert got == {1: "xin chào", 5: "12"}
    frames = spark.createDataFrame([(0, 0, bytearray(b"\x01\x02"), "video1_topic")],
                                   "frame_id int, video_second int, image binary, topic string")
    fm = frame_messages(frames, topic_col="topic")
    back = parse_frames(fm).first()
    assert back.source_video == "video1" and back.image_b64 == "AQI="
    small = frame_messages(frames, topic_col="topic", max_bytes=10)
    assert small.count() == frames.count() and small.where("within_limit").count() == 0
    frac = spark.createDataFrame([('{"frame_id": 1.5, "source_video": "v"}',)], "value string")
    assert parse_frames(frac).first().frame_id is None


def test_union_and_shape(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    u = union_sources({"video1": a, "video2": b}, "source_video")
    assert sorted((r.source_video, r.x) for r in u.collect()) == [("video1", 1), ("video2", 2), ("video2", 3)]
    s = {r.table_name: (r.n_rows, r.n_cols) for r in dataset_shape({"a": a, "b": b}).collect()}
    assert s == {"a": (1, 1), "b": (2, 1)}


def test_jdbc_target_options():
    t = IO.JdbcTarget("jdbc:postgresql://db/x", "review_results", "org.postgresql.Driver",
                      {"user": "u"})
    assert t.options() == {"url": "jdbc:postgresql://db/x", "dbtable": "review_results", "user": "u",
                           "driver": "org.postgresql.Driver"}


def test_route_by_source_one_write_per_source(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(IO, "write_jdbc", lambda df, target, mode="append": calls.append(
        (target.table, df.count(), tuple(df.columns))))
    batch = spark.createDataFrame([("video1", 1), ("video1", 2), ("video2", 3)] * 50,
                                  "source_video string, frame_id int")
    sources = IO.route_by_source_jdbc(batch, lambda s: IO.JdbcTarget("jdbc:x", f"frame_results_{s}"))
    assert sorted(sources) == ["video1", "video2"]
    assert sorted(calls) == [("frame_results_video1", 100, ("frame_id",)),
                             ("frame_results_video2", 50, ("frame_id",))]
