"""Aspect label operators: decode heads, spread, shift, unpivot (PRJ-4/5/9/11, SET-2/3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.scores import argmax, head_logits, label_name
from aspectflow.schemas import ASPECTS, LABEL_NAMES, NUM_CLASSES


def predicted_indices(df: DataFrame, logits_col: str, aspects=ASPECTS,
                      num_classes: int = NUM_CLASSES, keep=()) -> DataFrame:
    """Flat logits (heads x classes) -> one argmax index column per aspect."""
    return df.select(*keep, *[
        argmax(head_logits(logits_col, i, num_classes)).alias(a) for i, a in enumerate(aspects)
    ])


def predicted_labels(df: DataFrame, logits_col: str, aspects=ASPECTS,
                     num_classes: int = NUM_CLASSES, keep=()) -> DataFrame:
    """MATH-2 + JOIN-3 + PRJ-4: flat logits -> one label-name column per aspect,
    all in one projection (no per-aspect withColumn chain)."""
    return df.select(*keep, *[
        label_name(argmax(head_logits(logits_col, i, num_classes))).alias(a)
        for i, a in enumerate(aspects)
    ])


def spread_aspects(df: DataFrame, array_col: str, aspects=ASPECTS, keep=()) -> DataFrame:
    """PRJ-4: array position i -> aspect column i (null when the array is short)."""
    return df.select(*keep, *[F.get(F.col(array_col), i).alias(a) for i, a in enumerate(aspects)])


def shift_labels(df: DataFrame, label_cols, offset: int = 1) -> DataFrame:
    """PRJ-9: raw labels (-1..2) -> stored labels (0..3)."""
    label_cols = list(label_cols)
    return df.select(*[(F.col(c) + offset).alias(c) if c in label_cols else F.col(c)
                       for c in df.columns])


def name_labels(df: DataFrame, label_cols, names=LABEL_NAMES, suffix: str = "") -> DataFrame:
    """JOIN-3 on stored label indices."""
    label_cols = list(label_cols)
    return df.select(*[label_name(F.col(c), names).alias(c + suffix) if c in label_cols else F.col(c)
                       for c in df.columns])


def present_aspects(df: DataFrame, aspects=ASPECTS) -> list[str]:
    """PRJ-11: the wanted aspects that exist in ``df`` (missing ones are skipped)."""
    return [a for a in aspects if a in df.columns]


def unpivot_aspects(df: DataFrame, ids, aspects=ASPECTS, name: str = "aspect",
                    value: str = "value") -> DataFrame:
    """SET-2/3: wide aspect columns -> (ids..., aspect, value) rows."""
    cols = present_aspects(df, aspects)
    return df.unpivot(list(ids), cols, name, value)
