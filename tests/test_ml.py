import numpy as np
from pyspark.sql import functions as F

from aspectflow.functions.text import clean
from aspectflow.ml import heads as H
from aspectflow.operators import history
from aspectflow.operators import vocab as V

ROWS = [
    ("giao hàng nhanh giá rẻ", 2, 1), ("giao hàng chậm quá", 1, 1), ("giá đắt chất lượng tệ", 1, 1),
    ("chất lượng tốt giá rẻ", 2, 2), ("size nhỏ không vừa", 0, 3), ("đẹp lắm shop ơi", 2, 2),
    ("", 0, 0), ("tệ tệ tệ", 1, 1), ("bình thường", 3, 3), ("giá ổn", 3, 0),
]


def _train(spark):
    df = spark.createDataFrame([(i, t, a, b) for i, (t, a, b) in enumerate(ROWS)],
                               "doc_id long, ReviewText string, Price int, Quality int")
    voc = V.build_vocab(V.cleaned(df, "ReviewText", keep=["doc_id"]), 50)
    return df, H.train_heads(df, voc, ["Price", "Quality"], max_iter=30)


def test_native_and_udf_scoring_agree(spark):
    df, model = _train(spark)
    native = {r.doc_id: (r.Price, r.Quality) for r in H.score(df, model, keep=["doc_id"]).collect()}
    udf = H.scoring_udf(model)(clean(F.col("ReviewText")))
    via_udf = {r.doc_id: tuple(r.u) for r in df.select("doc_id", udf.alias("u")).collect()}
    assert native == via_udf
    assert all(v in ("NONE", "NEG", "POS", "NEU") for pair in native.values() for v in pair)


def test_every_head_has_four_classes_and_empty_text_scores_intercept(spark):
    df, model = _train(spark)
    w, b = H.head_weights(model)
    assert w.shape[:2] == (2, 4) and b.shape == (2, 4)
    empty = H.score(spark.createDataFrame([("",)], "ReviewText string"), model).first()
    names = ["NONE", "NEG", "POS", "NEU"]
    assert (empty.Price, empty.Quality) == (names[int(np.argmax(b[0]))], names[int(np.argmax(b[1]))])


def test_scoring_is_row_local(spark):
    df, model = _train(spark)
    alone = H.score_adhoc(spark, ["giao hàng nhanh giá rẻ"], model).first()
    together = H.score_adhoc(spark, ["giao hàng nhanh giá rẻ", "x " * 300], model).first()
    assert (alone.Price, alone.Quality) == (together.Price, together.Quality)


def test_evaluate_and_history(spark):
    df, model = _train(spark)
    m = H.evaluate(model, df, "doc_id").first()
    assert 0.0 <= m.macro_f1 <= 1.0 and 0.0 <= m.balanced_acc <= 1.0
    hist = H.training_history(model)
    stop = {r.run: r for r in history.early_stop(hist, patience=3).collect()}
    assert set(stop) == {"Price", "Quality"}
