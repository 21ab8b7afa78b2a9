"""Table-level helpers: union of same-schema sources, dataset shape (SET-1, AGG-14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(tables: dict[str, DataFrame], source_col: str = "source") -> DataFrame:
    """SET-1: one logical feed from same-schema tables, tagged by name.
    Each input keeps its own scan, filters and pruning (Union is narrow)."""
    parts = [df.select(F.lit(name).alias(source_col), *df.columns) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def dataset_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-14: row and column count per table (counts need no column reads)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows",
                     F.lit(len(df.columns)).cast("long").alias("n_cols"))
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
