from pyspark.sql import functions as F

from aspectflow.functions.scores import argmax, label_name
from aspectflow.operators import aspects as A
from aspectflow.operators import dashboard as D
from aspectflow.schemas import ASPECTS


def test_argmax_ties_negatives_last(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],), ([-5.0, -1.0, -2.0, -1.0],),
                                ([0.0, 0.0, 0.0, 9.0],)], "a array<double>")
    assert [r[0] for r in df.select(argmax("a")).collect()] == [1, 1, 3]


def test_label_name_default(spark):
    df = spark.createDataFrame([(0,), (3,), (7,), (None,)], "i int")
    assert [r[0] for r in df.select(label_name("i")).collect()] == ["NONE", "NEU", "NONE", "NONE"]


def test_predicted_labels_heads(spark):
    logits = [0.0] * 32
    logits[4 * 2 + 2] = 1.0   # head 2 -> POS
    logits[4 * 7 + 3] = 1.0   # head 7 -> NEU
    df = spark.createDataFrame([(1, logits)], "id int, e array<float>")
    r = A.predicted_labels(df, "e", keep=["id"]).first()
    assert r["Outlook"] == "POS" and r["Others"] == "NEU" and r["Price"] == "NONE"


def test_spread_shift_unpivot(spark):
    df = spark.createDataFrame([(1, ["NEG", "POS"])], "id int, p array<string>")
    s = A.spread_aspects(df, "p", keep=["id"]).first()
    assert s["Price"] == "NEG" and s["Shipping"] == "POS" and s["Outlook"] is None
    raw = spark.createDataFrame([(1, -1, 2)], "id int, Price int, Size int")
    sh = A.shift_labels(raw, ["Price", "Size"]).first()
    assert (sh.Price, sh.Size) == (0, 3)
    u = A.unpivot_aspects(raw, ["id"]).collect()  # missing aspects skipped
    assert sorted((r.aspect, r.value) for r in u) == [("Price", -1), ("Size", 2)]


def test_sentiment_counts_dense(spark):
    rows = [("POS",) + ("NONE",) * 7, ("NEG",) + ("NONE",) * 7, ("POS",) + ("NONE",) * 7]
    df = spark.createDataFrame(rows, ", ".join(f"{a} string" for a in ASPECTS))
    c = {(r.Aspect, r.Sentiment): r.Count for r in D.sentiment_counts(df).collect()}
    assert len(c) == 24
    assert c[("Price", "POS")] == 2 and c[("Price", "NEG")] == 1 and c[("Price", "NEU")] == 0
    assert c[("Others", "POS")] == 0  # only NONE -> three zero cells remain
    t = {r.Sentiment: r.Count for r in D.sentiment_totals(D.sentiment_counts(df)).collect()}
    assert t == {"POS": 2, "NEG": 1, "NEU": 0}


def test_sentiment_counts_missing_column_and_empty(spark):
    df = spark.createDataFrame([], "Price string, Size string")
    c = D.sentiment_counts(df).collect()
    assert len(c) == 6 and all(r.Count == 0 for r in c)


def test_random_sample_and_preview(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert D.random_sample(df, 300, seed=1).count() == 300
    assert D.random_sample(df.limit(10), 300).count() == 10
    assert [r.k for r in D.preview(df, 3, "k").collect()] == [0, 1, 2]
    assert [r.k for r in D.preview(df, 2, "k", ascending=False).collect()] == [999, 998]


def test_leaderboard_order_and_display(spark):
    reg = spark.createDataFrame(
        [(1, "a", 0.5, 0.4, "2024-01-01 00:00:00"), (2, "b", None, 0.9, "2024-01-02 00:00:00"),
         (3, "c", 0.5, 0.12345, "2024-01-03 00:00:00"), (4, "d", 0.7, 0.1, "2024-01-04 00:00:00")],
        "id long, model_name string, macro_f1 double, balanced_acc double, created_at string"
    ).withColumn("created_at", F.to_timestamp("created_at"))
    top = D.leaderboard(reg, 3, display=True).collect()
    assert [r["ID"] for r in top] == [4, 3, 1]
    assert top[1]["Balanced Acc"] == 0.1234 or top[1]["Balanced Acc"] == 0.1235
    assert "Macro F1" in top[0].asDict()


def test_latest_row_per_group(spark):
    df = spark.createDataFrame([("v1", 1, 10), ("v1", 2, 30), ("v2", 3, 20)],
                               "src string, frame int, t int")
    got = {r.src: r.frame for r in D.latest_row(df, "t", by="src").collect()}
    assert got == {"v1": 2, "v2": 3}
    assert D.latest_row(df, "t").first().frame == 2
