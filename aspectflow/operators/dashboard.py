"""Dashboard queries (AGG-5/6, JOIN-5, TOP-3/4/6/7, PRJ-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.operators.aspects import present_aspects
from aspectflow.schemas import ASPECTS, DASHBOARD_SENTIMENTS


def sentiment_counts(df: DataFrame, aspects=ASPECTS,
                     sentiments=DASHBOARD_SENTIMENTS) -> DataFrame:
    """AGG-5 + JOIN-5: dense (Aspect, Sentiment, Count) grid.

    Every (present aspect, sentiment) cell appears, with 0 when empty; other
    values (NONE, nulls) are not counted.  Expressed as one global aggregate
    of conditional counts (partial per task, one tiny final merge), so there
    is neither an unpivot of N x aspects rows nor a grid join.
    """
    cols = present_aspects(df, aspects)
    cells = [(a, s) for a in cols for s in sentiments]
    counts = df.agg(*[F.count_if(F.col(a) == F.lit(s)).alias(f"c{i}")
                      for i, (a, s) in enumerate(cells)])
    if not cells:
        return counts.sparkSession.createDataFrame([], "Aspect string, Sentiment string, Count bigint")
    grid = F.array(*[
        F.struct(F.lit(a).alias("Aspect"), F.lit(s).alias("Sentiment"), F.col(f"c{i}").alias("Count"))
        for i, (a, s) in enumerate(cells)
    ])
    return counts.select(F.inline(grid))


def sentiment_totals(counts: DataFrame) -> DataFrame:
    """AGG-6: totals of the dense grid by sentiment."""
    return counts.groupBy("Sentiment").agg(F.sum("Count").cast("bigint").alias("Count"))


def random_sample(df: DataFrame, n: int = 300, seed: int | None = None) -> DataFrame:
    """TOP-6: uniform sample of exactly min(n, rows) rows.

    ``orderBy(rand).limit`` plans as TakeOrderedAndProject: each task keeps
    its n smallest keys, so only n x tasks rows ever leave the executors.
    """
    key = F.rand(seed) if seed is not None else F.rand()
    return df.withColumn("_k", key).orderBy("_k").limit(n).drop("_k")


def bottom_k(df: DataFrame, n: int, key, seed: int = 0) -> DataFrame:
    """TOP-6 as a mergeable sketch: the ``n`` rows whose ``key`` columns have the smallest seeded hash, with that hash
    in ``sample_hash``.

    Every distinct key is as likely as any other.  The sample is a function of the rows alone, whatever their
    partitions, and ``bottom_k(bottom_k(a) union bottom_k(b))`` is ``bottom_k(a union b)``: see :func:`merged_samples`.
    A key that several rows share is sampled once (any of its rows; nulls are a key too).
    """
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("~")) for k in keys])
    hashed = df.drop("sample_hash").withColumn("sample_hash", F.md5(text.cast("binary")))
    return hashed.dropDuplicates(keys).orderBy("sample_hash").limit(n)


def merged_samples(samples: DataFrame, n: int, key) -> DataFrame:
    """The sample of all rows from samples of their parts (of size ``n`` each), e.g. one per batch."""
    keys = [key] if isinstance(key, str) else list(key)
    return samples.dropDuplicates(keys).orderBy("sample_hash").limit(n)


def preview(df: DataFrame, n: int = 5, order_by=None, ascending: bool = True) -> DataFrame:
    """TOP-7: head (or, with ``ascending=False``, tail) under an explicit order."""
    if order_by is None:
        return df.limit(n)
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in cols]
    return df.orderBy(*keys).limit(n)


def leaderboard(registry: DataFrame, k: int = 20, display: bool = False) -> DataFrame:
    """TOP-4: macro_f1 desc nulls last, then created_at desc, top k."""
    top = registry.orderBy(F.col("macro_f1").desc_nulls_last(), F.col("created_at").desc()).limit(k)
    return display_registry(top) if display else top


def display_registry(df: DataFrame) -> DataFrame:
    """PRJ-10: display names, scores rounded half-even to 4 places."""
    out = df.select(
        *[(F.bround(F.col(c).cast("double"), 4) if c in ("macro_f1", "balanced_acc") else F.col(c))
          .alias(c) for c in df.columns])
    return out.withColumnsRenamed({
        "macro_f1": "Macro F1", "balanced_acc": "Balanced Acc", "model_name": "Model Name",
        "created_at": "Created At", "id": "ID"})


def latest_row(df: DataFrame, order_col: str = "created_at", by=None, tie: str | None = None) -> DataFrame:
    """TOP-3: newest row, overall or per ``by`` group; of equally new rows the one
    with the largest ``tie`` (a unique column makes the result unique).

    Per group the newest time, then the largest ``tie`` at that time, are hash
    aggregates with map-side combine on fixed-width values (a hot group costs
    one row per task before the shuffle), joined back to the rows; a null time
    is older than any.
    """
    if by is None:
        order = [F.col(order_col).desc_nulls_last()] + ([F.col(tie).desc()] if tie else [])
        return df.orderBy(*order).limit(1)
    keys = [by] if isinstance(by, str) else list(by)
    out = df
    for column in [order_col] + ([tie] if tie else []):
        best = out.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(column).alias("_best"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(column).eqNullSafe(F.col("_best"))]
        out = out.join(best, same, "left_semi")
    return out if tie else out.dropDuplicates(keys)
