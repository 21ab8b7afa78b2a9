"""Vectors as rows: validity, packing into bytes, and cutting large groups into bounded blocks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers, and not the zero vector."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0), F.lit(False))


def stacked(vectors: Iterable) -> np.ndarray:
    """Rows of equal length as one matrix in double precision."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def in_blocks(rows: DataFrame, key: str, member: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` dealt to pairs of blocks, so that any two rows of a ``key`` meet in a group of bounded size.

    Adds ``_blk`` (the row's block), ``_nb`` (blocks of its key) and the group's ``_i`` <= ``_j``.  A key of one
    block is one group; a larger key's rows are repeated once for every other block.
    """
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_nb")).withColumnRenamed(key, "_key")
    cut = (rows.join(sizes, F.col(key) == F.col("_key")).drop("_key")
           .withColumn("_blk", F.pmod(F.xxhash64(member), F.col("_nb")).cast("int")))
    others = F.when(F.col("_nb") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("_nb") - 1), lambda x: x != F.col("_blk")))
    return (cut.withColumn("_o", F.explode(others))
            .withColumn("_i", F.least("_blk", "_o")).withColumn("_j", F.greatest("_blk", "_o")).drop("_o"))


def counted_here(block: int, i: int, j: int, blocks: int) -> bool:
    """Whether the group of blocks (i, j) is the one that counts the pairs inside ``block``."""
    return blocks == 1 or (block == i and j == i + 1) or (block == j == blocks - 1 and i == 0)


def unscaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component near 1: exact, so that squares of very large or
    very small components neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
