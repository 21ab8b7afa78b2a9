"""Epoch training against a plain numpy loop, and the registry under concurrent promoters."""

import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from aspectflow import jobs
from aspectflow.ml import epochs as E
from aspectflow.ml import heads as H
from aspectflow.operators import history
from aspectflow.operators import vocab as V
from aspectflow.schemas import ASPECTS, LABEL_NAMES
from aspectflow.sources.registry_log import RegistryLog

WORDS = ["hay", "tot", "xau", "re", "dat"]


def _rows(spark, n, seed=0, gap=0):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [WORDS[j] for j in rnd.integers(0, len(WORDS), rnd.integers(0, 9))]
        a = words.count("tot") > words.count("xau")
        rows.append((i + gap, " ".join(words) if i % 13 else None, 2 if a else 1, int(rnd.integers(0, 4)) if i % 17 else None))
    return spark.createDataFrame(rows, "id long, clean_text string, A int, B int").repartition(5), rows


def _plain(rows, ids, epochs, rate, batch=64):
    """Full-batch steps written out row by row: losses per epoch over the training rows, and the weights."""
    rows = sorted(r for r in rows if r[2] is not None and r[3] is not None)
    x = np.zeros((len(rows), len(ids) + 2))
    for i, r in enumerate(rows):
        words = [w for w in (r[1] or "").split() if w in ids]
        for w in words:
            x[i, ids[w]] += 1 / len(words)
    y = np.array([r[2:] for r in rows])
    per = np.array([1 / (min(batch, len(rows) - i // batch * batch) * 2 * -(-len(rows) // batch)) for i in range(len(rows))])
    w, b, losses = np.zeros((2, 4, len(ids) + 2)), np.zeros((2, 4)), []
    for _ in range(epochs):
        z = np.einsum("nv,hcv->nhc", x, w) + b
        p = np.exp(z - z.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        own = np.take_along_axis(p, y[:, :, None], 2)[:, :, 0]
        losses.append(float((per[:, None] * -np.log(own)).sum()))
        p[np.arange(len(rows))[:, None], [0, 1], y] -= 1
        p *= per[:, None, None]
        w, b = w - rate * np.einsum("nhc,nv->hcv", p, x), b - rate * p.sum(0)
    return losses, w, b


def test_epochs_equal_a_plain_loop(spark):
    df, rows = _rows(spark, 150)
    vocab = V.build_vocab(df, 4, id_col="id")
    ids = {r["token"]: r["id"] for r in vocab.collect() if r["id"] >= 2}
    heads, losses = E.train_epochs(df, df, vocab, ["A", "B"], "id", epochs=5, rate=3.0, adam=False, evaluate_every=2)
    want, w, b = _plain(rows, ids, 6, 3.0)
    got = losses.orderBy("epoch").collect()
    assert np.allclose([r["train_loss"] for r in got], want[:5], rtol=1e-12)
    assert np.allclose([r["val_loss"] for r in got], want[1:], rtol=1e-12)      # the same rows after each update
    assert [r["macro_f1"] is not None for r in got] == [False, True, False, True, False]
    assert np.allclose(heads.weights, _plain(rows, ids, 5, 3.0)[1]) and np.allclose(heads.bias, _plain(rows, ids, 5, 3.0)[2])


def test_steps_of_an_epoch_cover_every_batch(spark):
    df, _ = _rows(spark, 150)
    vocab = V.build_vocab(df, 4, id_col="id")
    rows, batches = E.prepared(df, vocab, ["A", "B"], "id", batch_size=16)
    zero = E.LinearHeads.zeros(H.vocab_words(vocab), ["A", "B"])
    whole = E.gradient(rows, zero)
    parts = [E.gradient(rows.where(F.col("batch") % 3 == s), zero) for s in range(3)]
    for k in range(3):
        assert np.allclose(whole[k], sum(p[k] for p in parts))
    _, losses = E.train_epochs(df, df, vocab, ["A", "B"], "id", epochs=2, steps=3, batch_size=16)
    assert losses.first()["val_loss"] < np.log(4)


def test_run_stops_early_and_keeps_the_best(spark):
    df, _ = _rows(spark, 120)
    vocab = V.build_vocab(df, 5, id_col="id")
    other, _ = _rows(spark, 60, seed=5, gap=1000)
    heads, losses = E.train_epochs(df, other, vocab, ["A", "B"], "id", epochs=30, patience=2, rate=1.5)
    stop = history.early_stop(losses.select("run", "epoch", "val_loss"), 2).first()
    assert stop["stop_epoch"] == losses.agg(F.max("epoch")).first()[0] < 30
    rows, _ = E.prepared(other, vocab, ["A", "B"], "id")
    assert abs(E.judged(rows, heads)[0] - stop["best_loss"]) < 1e-12


def test_training_without_rows_and_odd_losses(spark):
    df, _ = _rows(spark, 40)
    vocab = V.build_vocab(df, 5, id_col="id")
    heads, losses = E.train_epochs(df, df.where("false"), vocab, ["A", "B"], "id", epochs=9, patience=2)
    assert losses.count() == 2 and not heads.weights.any()                 # NaN is no improvement
    heads, losses = E.train_epochs(df.where("false"), df, vocab, ["A", "B"], "id", epochs=2)
    assert not heads.weights.any() and losses.count() == 2


def test_heads_are_stored_and_score_any_rows(spark, scratch):
    df, _ = _rows(spark, 60)
    vocab = V.build_vocab(df, 5, id_col="id")
    heads, _ = E.train_epochs(df, df, vocab, ["A", "B"], "id", epochs=3, rate=2.0)
    E.save(heads, spark, f"{scratch}/m")
    back = H.load_model(spark, f"{scratch}/m")
    assert back.words == heads.words and back.aspects == heads.aspects
    assert np.array_equal(back.weights, heads.weights) and np.array_equal(back.bias, heads.bias)
    texts = spark.createDataFrame([((1 << 60) + 1, "tot tot TOT!"), (None, None), (3, ""), (3, "unknown")], "id long, ReviewText string")
    rows = H.score(texts, back).collect()
    assert {r["id"] for r in rows} == {(1 << 60) + 1, None, 3} and len(rows) == 4
    assert all(r["A"] in ("NONE", "NEG", "POS", "NEU") for r in rows)
    at = back.words.index("tot") + 2
    assert rows[0]["A"] == LABEL_NAMES[int((back.weights[0, :, at] + back.bias[0]).argmax())]


def test_scores_equal_the_metrics_operator(spark):
    from aspectflow.operators import metrics

    rnd = np.random.default_rng(3)
    pairs = [("A", int(t), int(p)) for t, p in rnd.integers(0, 3, (200, 2))]
    df = spark.createDataFrame(pairs, "aspect string, truth int, pred int")
    want = metrics.classification_metrics(df).first()
    got = E.scores(df.groupBy("aspect", "truth", "pred").agg(F.count("*").alias("cnt")))
    assert np.allclose(got, (want["macro_f1"], want["balanced_acc"]))


# --- registry

def test_promoters_at_once_leave_one_row_per_id(spark, scratch):
    offers = [round(0.1 + 0.07 * ((7 * i) % 11), 3) for i in range(11)]
    with ThreadPoolExecutor(3) as pool:
        won = list(pool.map(lambda k: [f for f in offers[k:] + offers[:k] if RegistryLog(spark, f"{scratch}/r").promote(f, 0.5)], range(3)))
    rows = RegistryLog(spark, f"{scratch}/r").rows()
    assert [r["id"] for r in rows] == list(range(1, len(rows) + 1)) and sum(map(len, won)) == len(rows)
    f1 = [r["macro_f1"] for r in rows]
    assert f1 == sorted(set(f1)) and f1[-1] == max(offers)
    table = spark.read.parquet(f"{scratch}/r")                              # the same rows for other readers
    assert sorted((r["id"], r["macro_f1"]) for r in table.collect()) == [(r["id"], r["macro_f1"]) for r in rows]


def test_loser_of_a_commit_is_judged_anew(spark, scratch):
    log = RegistryLog(spark, f"{scratch}/r")
    read, calls = log.rows, []

    def stale():                    # another promoter commits between this one's look and its commit
        rows = read()
        if not calls:
            calls.append(1)
            assert RegistryLog(spark, f"{scratch}/r").promote(0.9, 0.5)["id"] == 1
        return rows

    log.rows = stale
    assert log.promote(0.8, 0.5) is None                                    # beaten by the faster one
    assert log.promote(0.95, 0.5)["id"] == 2
    assert [r["macro_f1"] for r in read()] == [0.9, 0.95]


def test_winner_that_dies_before_naming_its_model_is_settled(spark, scratch):
    log, models = RegistryLog(spark, f"{scratch}/r"), f"{scratch}/models"
    os.makedirs(f"{models}/_staged/x/weights")
    assert log.promote(0.5, 0.5, f"{models}/_staged/x") is not None         # no folder given: the name is still to come
    assert not os.path.exists(f"{models}/cnn_v1.pth")
    assert jobs.resolve(spark, f"{scratch}/r", models) == "cnn_v1.pth"
    assert os.path.exists(f"{models}/cnn_v1.pth/weights")


def test_registry_kept_before_the_log_is_adopted(spark, scratch):
    from aspectflow.schemas import REGISTRY

    old = spark.createDataFrame([(1, "cnn_v1.pth", 0.4, 0.4, None), (2, "cnn_v2.pth", 0.6, 0.5, None)], REGISTRY)
    old.write.parquet(f"{scratch}/r")
    assert RegistryLog(spark, f"{scratch}/r").promote(0.55, 0.5) is None
    assert RegistryLog(spark, f"{scratch}/r").promote(0.7, 0.5)["id"] == 3
    assert [r["id"] for r in jobs.read_registry(spark, f"{scratch}/r").orderBy("id").collect()] == [1, 2, 3]


def test_version_that_never_fills_is_an_error(spark, scratch, monkeypatch):
    from aspectflow.sources import registry_log

    monkeypatch.setattr(registry_log, "PARTIAL_LOOKS", 2)
    log = RegistryLog(spark, f"{scratch}/r")
    assert log._create("000000000001.json", b'{"id": 1, "macro')
    assert not log._create("000000000001.json", b"{}")
    with pytest.raises(RuntimeError, match="never filled"):
        log.rows()


def test_retrain_stops_early_and_judges_on_other_rows(spark, scratch):
    texts = ["giao hàng nhanh", "giá rẻ quá", "chất lượng tệ", "size nhỏ", "đẹp lắm", "bình thường"]
    rows = [(texts[i % 6], *[((i + k) % 4) - 1 for k in range(len(ASPECTS))]) for i in range(60)]
    df = spark.createDataFrame(rows, "Review string, " + ", ".join(f"{a} int" for a in ASPECTS))
    out = jobs.retrain(spark, df, df.limit(20), f"{scratch}/r", f"{scratch}/m", max_iter=40, patience=2, rate=0.5,
                       history_path=f"{scratch}/h")
    epochs = spark.read.parquet(f"{scratch}/h")
    stop = history.early_stop(epochs.select("run", "epoch", "val_loss"), 2).first()
    assert out.promoted and epochs.count() == stop["epochs_run"] and epochs.where("epoch % 10 = 0 and macro_f1 is null").count() == 0
    assert jobs.resolve(spark, f"{scratch}/r", f"{scratch}/m") == "cnn_v1.pth"
