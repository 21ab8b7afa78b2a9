import math
import random

import numpy as np

from aspectflow.operators import history as H
from aspectflow.operators import metrics as M
from aspectflow.operators.ordering import batch_number, with_row_index
from tests import pyref


def _pairs(spark, truth, pred, aspect="x"):
    return spark.createDataFrame([(aspect, t, p) for t, p in zip(truth, pred)],
                                 "aspect string, truth int, pred int")


CASES = [
    ([0, 1, 1, 2], [0, 1, 2, 2]),          # class 3 absent from both
    ([1, 1, 1, 1], [1, 1, 1, 1]),          # perfect, single class
    ([0, 0, 1, 1], [3, 3, 3, 3]),          # pred class absent from truth
    ([2, 2, 3], [0, 1, 2]),                # truth class absent from pred
]


def test_macro_f1_and_balanced_accuracy(spark):
    for truth, pred in CASES:
        fixed = M.classification_metrics(_pairs(spark, truth, pred)).first()
        assert math.isclose(fixed.macro_f1, pyref.f1_macro(truth, pred, [0, 1, 2, 3]))
        assert math.isclose(fixed.balanced_acc, pyref.balanced_accuracy(truth, pred))
        pres = M.classification_metrics(_pairs(spark, truth, pred), f1_average="present").first()
        assert math.isclose(pres.macro_f1, pyref.f1_macro(truth, pred))


def test_metrics_random(spark):
    rnd = random.Random(3)
    truth = [rnd.randrange(4) for _ in range(300)]
    pred = [rnd.randrange(3) for _ in range(300)]
    m = M.classification_metrics(_pairs(spark, truth, pred)).first()
    assert math.isclose(m.macro_f1, pyref.f1_macro(truth, pred, [0, 1, 2, 3]))
    assert math.isclose(m.balanced_acc, pyref.balanced_accuracy(truth, pred))


def test_empty_population_is_zero(spark):
    m = M.classification_metrics(spark.createDataFrame([], "truth int, pred int")).first()
    assert m.macro_f1 == 0.0 and m.balanced_acc == 0.0


def test_pair_rows_and_aspect_metrics(spark):
    truth = spark.createDataFrame([(1, 0, 2), (2, 1, 2), (3, 3, 0)], "id int, a int, b int")
    pred = spark.createDataFrame([(1, 0, 2), (2, 0, 2), (3, 3, 1), (4, 1, 1)], "id int, a int, b int")
    pairs = M.pair_rows(pred, truth, "id", ["a", "b"])
    assert pairs.count() == 6
    am = {r.aspect: r for r in M.aspect_metrics(pairs, ["a", "b"]).collect()}
    assert math.isclose(am["a"].f1, pyref.f1_macro([0, 1, 3], [0, 0, 3]))
    assert math.isclose(am["b"].bal_acc, pyref.balanced_accuracy([2, 2, 0], [2, 2, 1]))
    conf = {(r.aspect, r.truth, r.pred): r.cnt for r in M.confusion(pairs, ["aspect"]).collect()}
    assert conf[("a", 0, 0)] == 1 and conf[("b", 2, 2)] == 2


def test_validation_loss_two_level_mean(spark):
    rnd = np.random.default_rng(0)
    n, heads = 150, 2                       # last batch has 22 rows
    logits = rnd.normal(size=(n, heads * 4))
    labels = rnd.integers(0, 4, size=(n, heads))
    rows = [(i, [float(x) for x in logits[i]], int(labels[i, 0]), int(labels[i, 1])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, lg array<double>, t0 int, t1 int")
    got = M.validation_loss(df, "lg", ["t0", "t1"], "id").first()
    ce = np.zeros((n, heads))
    for h in range(heads):
        z = logits[:, 4 * h:4 * h + 4]
        m = z.max(axis=1, keepdims=True)
        lse = (m + np.log(np.exp(z - m).sum(axis=1, keepdims=True)))[:, 0]
        ce[:, h] = lse - z[np.arange(n), labels[:, h]]
    batch_means = [ce[i:i + 64].mean() for i in range(0, n, 64)]
    assert got.n_batches == 3
    assert math.isclose(got.val_loss, float(np.mean(batch_means)), rel_tol=1e-12)
    assert not math.isclose(got.val_loss, float(ce.mean()), rel_tol=1e-9)


def test_row_index_dense_and_ordered(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").repartition(7)
    got = with_row_index(df, "k", "ri", num_partitions=5).orderBy("k").collect()
    assert [r.ri for r in got] == list(range(len(got)))
    b = batch_number(df, "k", 64).groupBy("batch").count().orderBy("batch").collect()
    assert all(r["count"] == 64 for r in b[:-1])


HISTORIES = {
    "equal_loss": [1.0, 1.0, 1.0, 1.0],                       # no improvement on equal
    "late_improvement": [1.0, 2, 2, 0.5, 2, 2, 2],            # improves just before patience
    "better_after_stop": [1.0, 2, 2, 2, 0.1],                 # must not win
    "never_stops": [3.0, 2.0, 1.0, 0.5],
}


def test_early_stop_matches_loop(spark):
    rows = [(run, e + 1, float(x)) for run, losses in HISTORIES.items() for e, x in enumerate(losses)]
    df = spark.createDataFrame(rows, "run string, epoch int, val_loss double")
    got = {r.run: r for r in H.early_stop(df, patience=3).collect()}
    for run, losses in HISTORIES.items():
        stop, best_epoch, best = pyref.early_stop(losses, 3)
        assert got[run].stop_epoch == stop, run
        assert got[run].best_epoch == best_epoch, run
        assert got[run].best_loss == best, run
    assert got["equal_loss"].stop_epoch == 4 and got["better_after_stop"].best_epoch == 1


def test_early_stop_random(spark):
    rnd = random.Random(11)
    runs = {f"r{i}": [rnd.choice([0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) for _ in range(rnd.randrange(1, 40))]
            for i in range(30)}
    rows = [(r, e + 1, x) for r, ls in runs.items() for e, x in enumerate(ls)]
    df = spark.createDataFrame(rows, "run string, epoch int, val_loss double")
    got = {r.run: r for r in H.early_stop(df, patience=5).collect()}
    for run, losses in runs.items():
        stop, best_epoch, best = pyref.early_stop(losses, 5)
        assert (got[run].stop_epoch, got[run].best_epoch, got[run].best_loss) == (stop, best_epoch, best)


def test_early_stop_scan_matches_loop_across_partitions(spark):
    rnd = random.Random(5)
    runs = {f"r{i}": [rnd.choice([0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) for _ in range(rnd.randrange(1, 60))]
            for i in range(12)}
    runs["hot"] = [1.0 / (1 + (i % 37)) + (i // 37) * 0.001 for i in range(2000)]   # one long run
    runs.update({k: v for k, v in HISTORIES.items()})
    rows = [(r, e + 1, float(x)) for r, ls in runs.items() for e, x in enumerate(ls)]
    df = spark.createDataFrame(rows, "run string, epoch int, val_loss double")
    for patience in (3, 5):
        got = {r.run: r for r in H.early_stop_scan(df, patience, num_partitions=7).collect()}
        win = {r.run: r for r in H.early_stop(df, patience).collect()}
        for run, losses in runs.items():
            stop, best_epoch, best = pyref.early_stop(losses, patience)
            g = got[run]
            assert (g.stop_epoch, g.best_epoch, g.best_loss) == (stop, best_epoch, best), (run, patience)
            assert g.epochs_run == win[run].epochs_run, run
