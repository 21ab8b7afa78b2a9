"""Evaluation metrics as aggregates (JOIN-4, AGG-8..12, MATH-3, WIN-4, TOP-8).

Every metric is one grouped aggregate of conditional sums over the
(truth, prediction) pairs: partial per task, so the shuffle carries one row
per task and group, never the pairs themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.scores import cross_entropy, head_logits
from aspectflow.operators.aspects import present_aspects
from aspectflow.operators.ordering import batch_number
from aspectflow.schemas import ASPECTS, BATCH_SIZE, NUM_CLASSES

CLASSES = list(range(NUM_CLASSES))


def pair_rows(pred: DataFrame, truth: DataFrame, key, aspects=ASPECTS, carry=()) -> DataFrame:
    """JOIN-4 + SET-3: pair predictions with truth on the row key (an equi
    join: positions do not exist in Spark), then flatten N x aspects into
    (key, aspect, truth, pred) rows.  ``carry`` columns of ``pred`` ride along."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [a for a in present_aspects(truth, aspects) if a in pred.columns]
    t = truth.select(*keys, *[F.col(a).alias(f"t_{a}") for a in cols])
    p = pred.select(*keys, *carry, *[F.col(a).alias(f"p_{a}") for a in cols])
    return _flatten(t.join(p, keys, "inner"), keys + list(carry), cols)


def pairs_in_row(df: DataFrame, keep, truth_cols: dict, pred_cols: dict) -> DataFrame:
    """SET-3 when truth and prediction already sit in the same row (no join):
    ``truth_cols``/``pred_cols`` map aspect -> column."""
    cols = [a for a in truth_cols if a in pred_cols]
    staged = df.select(*keep, *[F.col(truth_cols[a]).alias(f"t_{a}") for a in cols],
                       *[F.col(pred_cols[a]).alias(f"p_{a}") for a in cols])
    return _flatten(staged, list(keep), cols)


def _flatten(df: DataFrame, keep: list, cols: list) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(a).alias("aspect"), F.col(f"t_{a}").alias("truth"),
                               F.col(f"p_{a}").alias("pred")) for a in cols])
    return df.select(*keep, F.inline(pairs))


def confusion(pairs: DataFrame, by=(), truth: str = "truth", pred: str = "pred") -> DataFrame:
    """AGG-8: counts per (truth, pred) [per group]."""
    return pairs.groupBy(*by, truth, pred).agg(F.count(F.lit(1)).alias("cnt"))


def _class_sums(truth: Column, pred: Column, classes) -> list[Column]:
    aggs = []
    for c in classes:
        aggs += [
            F.sum(F.when((truth == c) & (pred == c), 1).otherwise(0)).alias(f"tp{c}"),
            F.sum(F.when(truth == c, 1).otherwise(0)).alias(f"sup{c}"),
            F.sum(F.when(pred == c, 1).otherwise(0)).alias(f"np{c}"),
        ]
    return aggs


def _f1(c) -> Column:
    den = F.col(f"sup{c}") + F.col(f"np{c}")
    return F.when(den > 0, 2.0 * F.col(f"tp{c}") / den).otherwise(F.lit(0.0))


def _mean(values: list[Column], mask: list[Column] | None) -> Column:
    if mask is None:
        return sum(values[1:], values[0]) / F.lit(float(len(values)))
    num = sum([F.when(m, v).otherwise(F.lit(0.0)) for v, m in zip(values, mask)][1:],
              F.when(mask[0], values[0]).otherwise(F.lit(0.0)))
    den = sum([F.when(m, 1).otherwise(0) for m in mask][1:], F.when(mask[0], 1).otherwise(0))
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metric_columns(classes=CLASSES, f1_average: str = "fixed") -> list[Column]:
    """Macro-F1 and balanced accuracy over per-class sums.

    ``f1_average='fixed'``: mean over all listed classes, 0 for an undefined
    class (labels fixed, zero_division=0).  ``'present'``: mean over classes
    present in truth or prediction.  Balanced accuracy: mean recall over
    classes present in truth.  An empty population gives 0.0.
    """
    f1s = [_f1(c) for c in classes]
    present = [(F.col(f"sup{c}") + F.col(f"np{c}")) > 0 for c in classes]
    f1 = _mean(f1s, None if f1_average == "fixed" else present)
    recalls = [F.when(F.col(f"sup{c}") > 0, F.col(f"tp{c}") / F.col(f"sup{c}")) for c in classes]
    bal = _mean([F.coalesce(r, F.lit(0.0)) for r in recalls],
                [F.col(f"sup{c}") > 0 for c in classes])
    return [f1.alias("macro_f1"), bal.alias("balanced_acc")]


def classification_metrics(pairs: DataFrame, by=(), truth: str = "truth", pred: str = "pred",
                           classes=CLASSES, f1_average: str = "fixed") -> DataFrame:
    """AGG-9/10/11: macro-F1 and balanced accuracy [per group]."""
    sums = pairs.groupBy(*by).agg(*_class_sums(F.col(truth), F.col(pred), classes))
    return sums.select(*by, *metric_columns(classes, f1_average))


def aspect_metrics(pairs: DataFrame, aspects=ASPECTS, classes=CLASSES) -> DataFrame:
    """AGG-11 + TOP-8: per-aspect F1 (classes present) and balanced accuracy,
    ranked worst to best (ties by aspect order)."""
    m = classification_metrics(pairs, by=["aspect"], classes=classes, f1_average="present")
    order = F.array_position(F.array(*[F.lit(a) for a in aspects]), F.col("aspect"))
    return m.select("aspect", F.col("macro_f1").alias("f1"), F.col("balanced_acc").alias("bal_acc"),
                    order.cast("int").alias("aspect_index"))


def rank_aspects(metrics: DataFrame) -> DataFrame:
    """TOP-8 ordering: F1 ascending, aspect order breaks ties (<= #aspects rows)."""
    return metrics.orderBy(F.col("f1").asc(), F.col("aspect_index").asc())


def validation_loss(df: DataFrame, logits_col: str, label_cols: list[str], order_col,
                    batch_size: int = BATCH_SIZE, num_classes: int = NUM_CLASSES) -> DataFrame:
    """AGG-12: cross-entropy per (row, head), averaged per batch of ``batch_size``
    rows in ``order_col`` order, then the unweighted mean of the batch means.

    Batches come from a distributed dense row index (no single-task window);
    the two-level mean is a partial aggregate by batch then a global one.
    """
    heads = len(label_cols)
    ce = [cross_entropy(head_logits(logits_col, i, num_classes), F.col(c))
          for i, c in enumerate(label_cols)]
    row_loss = sum(ce[1:], ce[0])
    batched = batch_number(df.select(order_col, row_loss.alias("_row_ce")),
                           order_col, batch_size, "batch")
    per_batch = batched.groupBy("batch").agg(
        (F.sum("_row_ce") / (F.count(F.lit(1)) * heads)).alias("batch_loss"))
    return per_batch.agg(F.avg("batch_loss").alias("val_loss"),
                         F.count(F.lit(1)).alias("n_batches"))
