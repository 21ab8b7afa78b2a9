import os

from pyspark.sql import functions as F

from aspectflow import jobs
from aspectflow.ml import heads as H
from aspectflow.schemas import ASPECTS

TEXTS = ["giao hàng nhanh", "giá rẻ quá", "chất lượng tệ", "size nhỏ", "đẹp lắm", "bình thường"]


def _frame(spark, n=30, shift=0):
    rows = []
    for i in range(n):
        t = TEXTS[i % len(TEXTS)]
        labels = [((i + k + shift) % 4) - 1 for k in range(len(ASPECTS))]
        rows.append((t, *labels))
    schema = "Review string, " + ", ".join(f"{a} int" for a in ASPECTS)
    return spark.createDataFrame(rows, schema)


def test_retrain_promote_and_resolve(spark, scratch):
    reg, models = os.path.join(scratch, "registry"), os.path.join(scratch, "models")
    assert jobs.resolve(spark, reg, models) == "cnn_best.pth"        # empty registry -> default
    first = jobs.retrain(spark, _frame(spark), _frame(spark), reg, models, max_iter=10)
    assert first.promoted and first.model_name == "cnn_v1.pth"
    again = jobs.retrain(spark, _frame(spark), _frame(spark), reg, models, max_iter=10)
    assert not again.promoted                                          # equal score: no trace
    assert spark.read.parquet(reg).count() == 1
    assert jobs.resolve(spark, reg, models) == "cnn_v1.pth"
    model = H.load_model(spark, os.path.join(models, "cnn_v1.pth"))
    assert model.aspects == ASPECTS and len(model.words) > 0
    scored = H.score(spark.createDataFrame([("giá rẻ quá",)], "ReviewText string"), model).first()
    assert scored.Price in ("NONE", "NEG", "POS", "NEU")


def test_preprocess_writes_vocab_and_encoded(spark, scratch):
    cleaned, vocab = jobs.preprocess(_frame(spark, 12), out_dir=scratch)
    assert spark.read.parquet(os.path.join(scratch, "vocab")).count() == vocab.count()
    enc = spark.read.parquet(os.path.join(scratch, "encoded"))
    assert enc.count() == 12 and "ids" in enc.columns
    assert enc.agg(F.min("Price"), F.max("Price")).first() == (0, 3)
