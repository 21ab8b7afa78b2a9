import base64
import json

from pyspark.sql import functions as F

from aspectflow.functions.codec import b64_decode, b64_encode, counts_from_json, proportional_height
from aspectflow.operators import frames as FR
from aspectflow.operators import registry as RG
from aspectflow.schemas import DETECTIONS


def test_sample_frames_fps(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "frame_id")
    got = FR.sample_frames(df, 29.97).collect()
    assert [(r.frame_id, r.video_second) for r in got] == [(0, 0), (29, 1), (58, 2), (87, 3)]
    assert FR.sample_frames(df, 0.5).count() == 100      # fps < 1 -> every frame, no div by 0


def test_source_from_topic(spark):
    df = spark.createDataFrame([("video1_topic",), ("cam",)], "t string")
    assert [r[0] for r in df.select(FR.source_from_topic("t")).collect()] == ["video1", "cam"]


def test_count_per_frame_zero_fill_unknown(spark):
    frames = spark.createDataFrame([(1,), (2,), (3,)], "frame_id int")
    det = spark.createDataFrame([(1, 2), (1, 2), (1, 7), (1, 9), (2, 3), (2, 5)], "frame_id int, class_id int")
    det = det.withColumn("label", FR.vehicle_label("class_id"))
    got = {r.frame_id: r for r in FR.count_per_frame(frames, det, "frame_id").collect()}
    assert (got[1].car, got[1].truck, got[1].total_count) == (2, 1, 3)   # unknown not counted
    assert (got[2].motorcycle, got[2].bus, got[2].total_count) == (1, 1, 2)
    assert got[3].total_count == 0
    assert json.loads(got[3].class_counts) == {"car": 0, "motorcycle": 0, "bus": 0, "truck": 0}
    assert got[1].class_counts == '{"car": 2, "motorcycle": 0, "bus": 0, "truck": 1}'
    assert FR.vehicles_only(det).count() == 5


def test_count_boxes_hof(spark):
    box = lambda label: {"label": label, "conf": 0.5, "xyxy": [0.0, 0.0, 1.0, 1.0]}
    df = spark.createDataFrame([("v1", 1, [box("car"), box("bus"), box("unknown")]), ("v1", 2, []),
                                ("v1", 3, None)], DETECTIONS)
    got = {r.frame_id: r.total_count for r in FR.count_boxes(df).collect()}
    assert got == {1: 2, 2: 0, 3: 0}


def test_boxes_per_frame_order(spark):
    det = spark.createDataFrame([(1, "car", 0.2), (1, "bus", 0.9), (1, "car", 0.9)],
                                "frame_id int, label string, conf double")
    det = det.withColumn("box", FR.box_struct("label", "conf", F.array(F.lit(1.0))))
    r = FR.boxes_per_frame(det, "frame_id").first()
    assert [(b.label, b.conf) for b in r.boxes] == [("bus", 0.9), ("car", 0.9), ("car", 0.2)]


def test_counts_from_json_defaults(spark):
    df = spark.createDataFrame([('{"car": 2, "bus": 1}',), ("not json",), ("{}",), (None,)], "j string")
    got = [tuple(r[0]) for r in df.select(counts_from_json("j")).collect()]
    assert got == [(2, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_base64_and_fallback(spark):
    raw = "xin chào " * 20
    df = spark.createDataFrame([(raw, "%%%not b64"), ("", "")], "t string, junk string")
    r = df.select(b64_encode(F.encode("t", "UTF-8")).alias("b"), b64_decode("junk").alias("j")).collect()
    assert r[0].b == base64.b64encode(raw.encode()).decode()   # one line, no MIME wrapping
    assert r[0].j is None


def test_inference_defaults_and_udf(spark):
    def detect(img: bytes):
        if img == b"boom":
            raise ValueError("bad image")
        return [{"cls": 2, "conf": 0.9, "xyxy": [1, 2, 3, 4]}, {"cls": 1, "conf": 0.3, "xyxy": [0, 0, 1, 1]}]

    udf = FR.inference_udf(detect)
    df = spark.createDataFrame([("v1", 1, 0, base64.b64encode(b"img").decode()),
                                ("v1", 2, 1, base64.b64encode(b"boom").decode()),
                                ("v1", 3, 2, "@@@")], "source_video string, frame_id int, video_second int, image_b64 string")
    out = FR.frame_results(df.withColumn("inference", udf("image_b64")), image_dir="/shared/frames")
    got = {r.frame_id: r for r in out.collect()}
    assert got[1].total_count == 1 and json.loads(got[1].annotation_json)[1]["label"] == "unknown"
    assert got[1].image_path == "/shared/frames/v1_frame_1.jpg"
    assert (got[2].total_count, got[2].class_counts, got[2].annotation_json, got[2].image_path) == (0, "{}", "[]", "")
    assert got[3].total_count == 0


def test_proportional_height(spark):
    df = spark.createDataFrame([(1920, 1080), (0, 10), (3, 7)], "w int, h int")
    assert [r[0] for r in df.select(proportional_height("w", "h")).collect()] == [
        int(1080 * (640 / 1920)), None, int(7 * (640 / 3))]


def _reg(spark, rows):
    return spark.createDataFrame(rows, "id long, model_name string, macro_f1 double, balanced_acc double, created_at timestamp")


def test_registry_promotion_rules(spark):
    empty = RG.empty_registry(spark)
    assert RG.current_best(empty).first().best_f1 == 0.0
    cands = spark.createDataFrame([(1, 0.5, 0.4), (2, 0.5, 0.9), (3, 0.4, 0.9), (4, 0.6, 0.1), (5, 0.0, 0.0)],
                                  "run int, macro_f1 double, balanced_acc double")
    out = RG.promote_candidates(empty, cands, "run").collect()
    assert [(r.id, r.model_name, r.macro_f1) for r in out] == [(1, "cnn_v1.pth", 0.5), (2, "cnn_v2.pth", 0.6)]
    reg = _reg(spark, [(7, "cnn_v7.pth", 0.55, 0.5, None)])
    out2 = RG.promote_candidates(reg, cands, "run").collect()
    assert [(r.id, r.macro_f1) for r in out2] == [(8, 0.6)]       # equal or worse leaves no trace


def test_best_model_and_resolution(spark):
    reg = _reg(spark, [(1, "cnn_v1.pth", 0.7, 0.5, None), (2, "cnn_v2.pth", 0.7, 0.4, None),
                       (3, "cnn_v3.pth", 0.6, 0.9, None)])
    assert RG.best_model(reg).first().id == 2                      # same score, later id
    files = spark.createDataFrame([("file:/m/cnn_v2.pth",), ("file:/m/cnn_v1.pth",)], "path string")
    assert RG.resolve_model(reg, RG.artefact_names(files)).first().model_name == "cnn_v2.pth"
    missing = spark.createDataFrame([("file:/m/cnn_v1.pth",)], "path string")
    assert RG.resolve_model(reg, RG.artefact_names(missing)).first().model_name == "cnn_best.pth"
    assert RG.resolve_model(RG.empty_registry(spark), RG.artefact_names(files)).first().model_name == "cnn_best.pth"


def test_counts_map_column(spark):
    frames = spark.createDataFrame([(1,)], "frame_id int")
    det = spark.createDataFrame([(1, "car"), (1, "bus")], "frame_id int, label string")
    r = FR.count_per_frame(frames, det, "frame_id").first()
    assert r.counts == {"car": 1, "motorcycle": 0, "bus": 1, "truck": 0}


def test_sample_frames_fps_column(spark):
    df = spark.createDataFrame([("a", i, 2.5) for i in range(6)] + [("b", i, 0.4) for i in range(3)],
                               "source_video string, frame_id int, fps double")
    got = sorted((r.source_video, r.frame_id, r.video_second)
                 for r in FR.sample_frames(df, "fps").collect())
    assert got == [("a", 0, 0), ("a", 2, 1), ("a", 4, 2), ("b", 0, 0), ("b", 1, 1), ("b", 2, 2)]
