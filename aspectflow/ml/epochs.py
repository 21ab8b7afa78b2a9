"""Epoch training of the aspect heads by distributed gradient steps (ML-1, ML-3, ML-4).

The rows are encoded once and numbered into batches.  Every step broadcasts the weights, each task adds up the
gradient of its rows, and two levels of grouped sums (a tree whose groups hold about the square root of the number
of tasks) bring the totals to the driver, whose share is the model's size.  After each epoch the validation loss
decides whether the weights are kept, and ``patience`` epochs without a better one end the run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.functions.batches import pieces
from aspectflow.operators import vocab as V
from aspectflow.operators.ordering import batch_number
from aspectflow.schemas import BATCH_SIZE, LABEL_NAMES, NUM_CLASSES, PAD_ID, UNK_ID
from aspectflow.session import cut_lineage_columnar

HISTORY = "run string, epoch int, train_loss double, val_loss double, macro_f1 double, balanced_acc double"


@dataclass
class LinearHeads:
    """Softmax heads over relative word frequencies: weights (heads x classes x vocabulary ids), bias (heads x classes)."""

    words: list[str]             # by id, from id 2 on
    aspects: list[str]
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def zeros(cls, words: list[str], aspects: list[str], classes: int = NUM_CLASSES) -> LinearHeads:
        return cls(list(words), list(aspects), np.zeros((len(aspects), classes, len(words) + 2)), np.zeros((len(aspects), classes)))

    def vocab(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(w, i + 2) for i, w in enumerate(self.words)], "token string, id int")

    def score(self, df: DataFrame, text_col: str = "ReviewText", keep=None, cleaned: bool = False) -> DataFrame:
        """ML-2: ``keep`` columns and one label name per aspect; the first class wins a tie, null text scores as empty."""
        keep = list(df.columns) if keep is None else list(keep)
        base = df if cleaned else V.cleaned(df, text_col, out="_clean", keep=df.columns)
        text = F.coalesce(F.col(text_col if cleaned else "_clean"), F.lit(""))
        enc = V.encode(base.withColumn("_text", text).withColumn("_none", F.lit(0)), self.vocab(df.sparkSession), "_none", "_text",
                       "_ids", keep=keep)
        sent, names, aspects = _sent(df.sparkSession, self), list(LABEL_NAMES), self.aspects

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (piece for b in batches for piece in pieces(b, "_ids")):
                ids, owner, counts = _known(batch["_ids"])
                best = _logits(*sent.value, ids, owner, counts).argmax(axis=2)
                labels = [pa.array([names[c] for c in best[:, h]], pa.string()) for h in range(len(aspects))]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *labels], names=[*keep, *aspects])

        kept = enc.select(*keep).schema
        for a in aspects:
            kept = kept.add(a, "string")
        return enc.select(*keep, "_ids").mapInArrow(run, kept)


def _sent(spark: SparkSession, heads: LinearHeads):
    return spark.sparkContext.broadcast((heads.weights, heads.bias))


def _known(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary ids, row of each, ids per row) of a list column, without padding and unknown words."""
    ids = np.asarray(column.flatten(), dtype=np.int64)
    owner = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths().fill_null(0), dtype=np.int64))
    keep = (ids != PAD_ID) & (ids != UNK_ID)
    ids, owner = ids[keep], owner[keep]
    return ids, owner, np.bincount(owner, minlength=len(column))


def _logits(weights: np.ndarray, bias: np.ndarray, ids: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """rows x heads x classes: the mean weight of a row's words, plus the bias."""
    heads, classes, _ = weights.shape
    out = np.empty((len(counts), heads, classes))
    for h in range(heads):
        for c in range(classes):
            out[:, h, c] = np.bincount(owner, weights=weights[h, c, ids], minlength=len(counts)) / np.maximum(counts, 1)
    return out + bias


def _softmax_loss(logits: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, summed cross-entropy of a row's heads)."""
    shifted = logits - logits.max(axis=2, keepdims=True)
    total = np.exp(shifted).sum(axis=2)
    own = np.take_along_axis(shifted, labels[:, :, None], 2)[:, :, 0]
    return np.exp(shifted) / total[:, :, None], (np.log(total) - own).sum(axis=1)


def prepared(rows: DataFrame, vocab: DataFrame, aspects: list[str], key: str, text_col: str = "clean_text",
             batch_size: int = BATCH_SIZE, name: str = "epoch_rows") -> tuple[DataFrame, int]:
    """(stored rows (ids, labels, batch, weight), number of batches): batches of ``batch_size`` in ``key`` order.

    A row's weight makes sums over rows the mean over batches of a batch's mean over rows and heads.  Rows with a
    null label are left out; null text has no words.
    """
    usable = rows.where(" and ".join(f"`{a}` is not null" for a in aspects))
    enc = V.encode(usable.withColumn(text_col, F.coalesce(text_col, F.lit(""))), vocab, key, text_col, "ids", keep=list(aspects))
    numbered = batch_number(enc.select(key, "ids", F.array(*[F.col(a).cast("int") for a in aspects]).alias("labels")), key, batch_size)
    stored = cut_lineage_columnar(numbered.select("ids", "labels", "batch"), name)
    total = stored.count()
    batches = -(-total // batch_size)
    last = total - (batches - 1) * batch_size
    size = F.when(F.col("batch") == batches - 1, F.lit(last)).otherwise(F.lit(batch_size))
    return stored.withColumn("weight", F.lit(1.0) / (size * F.lit(len(aspects) * max(batches, 1)))), batches


def gradient(rows: DataFrame, heads: LinearHeads) -> tuple[np.ndarray, np.ndarray, float]:
    """(gradient of the weights, of the bias, loss) over all ``rows``, weighted."""
    spark, (h, c, v) = rows.sparkSession, heads.weights.shape
    sent = _sent(spark, heads)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        total, loss = np.zeros((h, c, v + 1)), 0.0
        for batch in (piece for b in batches for piece in pieces(b, "ids")):
            ids, owner, counts = _known(batch["ids"])
            labels = np.asarray(batch["labels"].flatten()).reshape(-1, h)
            w = np.asarray(batch["weight"])
            p, losses = _softmax_loss(_logits(weights, bias, ids, owner, counts), labels)
            loss += float(w @ losses)
            np.put_along_axis(p, labels[:, :, None], np.take_along_axis(p, labels[:, :, None], 2) - 1, 2)
            p *= w[:, None, None]
            total[:, :, v] += p.sum(axis=0)
            p /= np.maximum(counts, 1)[:, None, None]
            for i in range(h):
                for j in range(c):
                    total[i, j, :v] += np.bincount(ids, weights=p[owner, i, j], minlength=v)
        blobs = [x.tobytes() for x in total.reshape(h * c, v + 1)] + [np.array([loss]).tobytes()]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(h * c + 1), pa.int32()), pa.array([task] * len(blobs), pa.int32()),
                                          pa.array(blobs, pa.binary())], names=["slot", "task", "total"])

    def add(group: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(b.as_py()) for b in group["total"][1:]), np.frombuffer(group["total"][0].as_py()))
        return pa.table({"slot": group["slot"].slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("ids", "labels", "weight").mapInArrow(part, "slot int, task int, total binary")
    fan = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    first = parts.groupBy("slot", F.pmod("task", F.lit(fan)).alias("fan")).applyInArrow(add, "slot int, total binary")
    totals = {r["slot"]: np.frombuffer(bytes(r["total"])) for r in first.groupBy("slot").applyInArrow(add, "slot int, total binary").collect()}
    if not totals:
        return np.zeros((h, c, v)), np.zeros((h, c)), 0.0
    grid = np.stack([totals[i] for i in range(h * c)]).reshape(h, c, v + 1)
    return grid[:, :, :v], grid[:, :, v], float(totals[h * c][0])


def judged(rows: DataFrame, heads: LinearHeads) -> tuple[float, DataFrame]:
    """(loss, confusion counts (aspect, truth, pred, cnt)) over all ``rows``; loss is NaN without rows."""
    spark, (h, c, _) = rows.sparkSession, heads.weights.shape
    sent = _sent(spark, heads)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, loss, seen = np.zeros((h, c, c), np.int64), 0.0, 0
        for batch in (piece for b in batches for piece in pieces(b, "ids")):
            ids, owner, sizes = _known(batch["ids"])
            labels = np.asarray(batch["labels"].flatten()).reshape(-1, h)
            logits = _logits(*sent.value, ids, owner, sizes)
            loss += float(np.asarray(batch["weight"]) @ _softmax_loss(logits, labels)[1])
            seen += len(labels)
            for i in range(h):
                np.add.at(counts[i], (labels[:, i], logits[:, i].argmax(axis=1)), 1)
        i, t, p = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(t, 0), pa.int32()), pa.array(np.append(p, 0), pa.int32()),
             pa.array(np.append(counts[i, t, p], seen), pa.int64()), pa.array(np.append(np.zeros(len(i)), loss))],
            names=["head", "truth", "pred", "cnt", "loss"])

    found = (rows.select("ids", "labels", "weight").mapInArrow(part, "head int, truth int, pred int, cnt long, loss double")
             .groupBy("head", "truth", "pred").agg(F.sum("cnt").alias("cnt"), F.sum("loss").alias("loss")).collect())
    counts = [(heads.aspects[r["head"]], r["truth"], r["pred"], r["cnt"]) for r in found if r["head"] >= 0]
    loss = next((r["loss"] for r in found if r["head"] == -1 and r["cnt"]), float("nan"))
    return loss, spark.createDataFrame(counts, "aspect string, truth int, pred int, cnt long")


def scores(confusion: DataFrame, classes: int = NUM_CLASSES) -> tuple[float, float]:
    """AGG-9/10 from confusion counts: macro-F1 over all classes (0 where a class has neither truth nor prediction)
    and balanced accuracy over the classes that occur; 0 without rows."""
    grid = np.zeros((classes, classes))
    for r in confusion.groupBy("truth", "pred").agg(F.sum("cnt").alias("cnt")).collect():
        grid[r["truth"], r["pred"]] = r["cnt"]
    hit, truth, pred = np.diag(grid), grid.sum(axis=1), grid.sum(axis=0)
    f1 = np.divide(2 * hit, truth + pred, out=np.zeros(classes), where=truth + pred > 0)
    recall = hit[truth > 0] / truth[truth > 0]
    return float(f1.mean()), float(recall.mean()) if len(recall) else 0.0


class Optimizer:
    """Adam as usually stated, or plain steps (``adam=False``)."""

    def __init__(self, rate: float, adam: bool = True):
        self.rate, self.adam, self.t, self.state = rate, adam, 0, {}

    def step(self, name: str, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
        if not self.adam:
            return value - self.rate * grad
        m, s = self.state.get(name, (np.zeros_like(grad), np.zeros_like(grad)))
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        self.state[name] = m, s
        return value - self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(s / (1 - 0.999**self.t)) + 1e-8)


def train_epochs(train: DataFrame, val: DataFrame, vocab: DataFrame, aspects: list[str], key: str, text_col: str = "clean_text",
                 epochs: int = 50, patience: int = 10, rate: float = 0.05, adam: bool = True, steps: int = 1,
                 evaluate_every: int = 10, start: LinearHeads | None = None, run: str = "heads",
                 batch_size: int = BATCH_SIZE) -> tuple[LinearHeads, DataFrame]:
    """(heads after the best epoch, history) of a run over cleaned, labelled rows.

    An epoch takes ``steps`` gradient steps, step s over the batches whose number is s modulo ``steps``.  The history
    has a row per epoch: training loss (before each step's update, averaged over the steps), validation loss after the
    epoch, and every ``evaluate_every``-th epoch macro-F1 and balanced accuracy of the validation rows.  A loss that is
    NaN is no improvement; without any improvement the heads are those of the start.
    """
    from aspectflow.ml.heads import vocab_words

    spark = train.sparkSession
    heads = start or LinearHeads.zeros(vocab_words(vocab), aspects)
    rows, batches = prepared(train, vocab, aspects, key, text_col, batch_size)
    held, _ = prepared(val, vocab, aspects, key, text_col, batch_size)
    opt, best, least, streak, history = Optimizer(rate, adam), heads, float("inf"), 0, []
    for epoch in range(1, epochs + 1):
        losses = []
        for s in range(min(steps, max(batches, 1))):
            share = len(range(s, batches, steps)) / max(batches, 1) or 1.0
            some = rows.where(F.col("batch") % steps == s) if steps > 1 else rows
            dw, db, loss = gradient(some, heads)
            opt.t += 1
            heads = LinearHeads(heads.words, heads.aspects, opt.step("w", heads.weights, dw / share), opt.step("b", heads.bias, db / share))
            losses.append(loss / share)
        val_loss, confusion = judged(held, heads)
        f1, acc = scores(confusion) if epoch % evaluate_every == 0 else (None, None)
        history.append((run, epoch, float(np.mean(losses)), val_loss, f1, acc))
        if val_loss < least:
            best, least, streak = heads, val_loss, 0
        else:
            streak += 1
            if streak >= patience:
                break
    return best, spark.createDataFrame(history, HISTORY)


def save(heads: LinearHeads, spark: SparkSession, path: str) -> None:
    """The heads as one table, a row per aspect and vocabulary id (the bias under id -1), in id order."""
    rows = [(a, h, i + 2, w, [float(x) for x in heads.weights[h, :, i + 2]])
            for h, a in enumerate(heads.aspects) for i, w in enumerate(heads.words)]
    rows += [(a, h, -1, None, [float(x) for x in heads.bias[h]]) for h, a in enumerate(heads.aspects)]
    (spark.createDataFrame(rows, "aspect string, head int, id int, token string, weights array<double>")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/weights"))


def load(spark: SparkSession, path: str) -> LinearHeads:
    rows = spark.read.parquet(f"{path}/weights").collect()
    words = [r["token"] for r in sorted((r for r in rows if r["head"] == 0 and r["id"] >= 0), key=lambda r: r["id"])]
    aspects = [r["aspect"] for r in sorted((r for r in rows if r["id"] == -1), key=lambda r: r["head"])]
    heads = LinearHeads.zeros(words, aspects, len(rows[0]["weights"]))
    for r in rows:
        if r["id"] < 0:
            heads.bias[r["head"]] = r["weights"]
        else:
            heads.weights[r["head"], :, r["id"]] = r["weights"]
    return heads
