"""Logit arithmetic as native higher-order functions (MATH-2/3, JOIN-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aspectflow.schemas import DEFAULT_LABEL, LABEL_NAMES, NUM_CLASSES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def head_logits(flat, head: int, num_classes: int = NUM_CLASSES) -> Column:
    """Logits of head ``head`` from a flat ``array`` (heads x classes)."""
    return F.slice(_c(flat), head * num_classes + 1, num_classes)


def argmax(arr) -> Column:
    """MATH-2: 0-based index of the first maximum (ties -> first)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def label_name(idx, names=LABEL_NAMES, default: str = DEFAULT_LABEL) -> Column:
    """JOIN-3: class index -> name, unknown index -> default."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.get(arr, _c(idx)), F.lit(default))


def logsumexp(arr) -> Column:
    a = F.transform(_c(arr), lambda x: x.cast("double"))
    m = F.array_max(a)
    return m + F.log(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))


def cross_entropy(logits, label) -> Column:
    """MATH-3: -log softmax(logits)[label] in double precision."""
    return logsumexp(logits) - F.get(_c(logits), _c(label)).cast("double")
