"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Law ``rows``: shard sizes differ by one row at most.  Rows are dealt to source lots by a hash (a lot is a bounded
group); the matrix of how many rows each lot sends to each shard is drawn exactly as a uniformly random permutation
would have it (a multivariate hypergeometric row per lot); inside a lot a random order decides which rows go where
(first permutation); after the exchange every shard is put into a random order again (second permutation).
All of it is a function of the row and the seed, so a lost executor's work is redone with the same result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.llm.stored import numbered

SHARDS = 24
SEED = 20240
ROWS_PER_LOT = 1024
MAX_LOTS = 1 << 16     # the matrix, MAX_LOTS x shards numbers at most, is drawn by the driver and broadcast


def hash62(seed: int, *cols) -> Column:
    """Uniform non-negative long below 2^62 from a seed and columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 2)


NUMPY_ROWS = 10**9      # numpy draws from fewer rows than this


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without replacement from ``good`` + ``bad`` are good, for any numbers.

    Inversion over the values within 12 standard deviations (and 20) of the mean, beyond which less than 2^-53 lies;
    their probabilities come from the ratios of neighbours.
    """
    total = good + bad
    mean = n * (good / total)
    spread = int(12 * math.sqrt(max(mean * (bad / total), 0.0))) + 20
    low, high = max(0, n - bad, int(mean) - spread), min(good, n, int(mean) + spread)
    k = np.arange(low, high, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1))])
    upto = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def communication_matrix(rows_per_lot: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows each lot (line) sends to each shard (column), distributed as under a uniformly random permutation.

    Lot by lot, a multivariate hypergeometric draw from what room the shards have left.
    """
    total = sum(rows_per_lot)
    room = np.full(shards, total // shards, dtype=np.int64)
    room[: total % shards] += 1
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(rows_per_lot), shards), dtype=np.int64)
    for i, n in enumerate(rows_per_lot):
        if total < NUMPY_ROWS:
            matrix[i] = rng.multivariate_hypergeometric(room, n, method="marginals")
        else:                      # shard by shard, each against all that follow
            left = int(room.sum())
            for j, here in enumerate(room.tolist()):
                left -= here
                matrix[i, j] = hypergeometric(rng, here, left, n) if here and n else 0
                n -= int(matrix[i, j])
        room -= matrix[i]
    return matrix


def sharded(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_lot: int = ROWS_PER_LOT) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Every input row appears once; repeated rows are rows of their own; nulls hash like any value; an empty input
    gives an empty result.  Input columns of the names ``shard`` and ``slot`` are replaced.  Rows that equal each
    other in every column are interchangeable.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    every = [F.col(f"`{c}`") for c in rows.columns]
    total = rows.count()
    # the number of lots follows the data; the matrix (lots x shards) is what the driver draws
    lots = max(1, min(MAX_LOTS, -(-total // rows_per_lot)))
    keyed = rows.withColumn("__shuffle_h", hash62(seed, *every)).withColumn("__shuffle_from", F.pmod("__shuffle_h", F.lit(lots)).cast("int"))
    counts = dict(keyed.groupBy("__shuffle_from").count().collect())
    sent = communication_matrix([counts.get(i, 0) for i in range(lots)], shards, seed)
    upto = spark.createDataFrame([(i, [int(x) for x in np.cumsum(line)]) for i, line in enumerate(sent)],
                                 "__shuffle_from int, __shuffle_upto array<long>")
    # first permutation: a random order within the lot decides the shard
    order = Window.partitionBy("__shuffle_from").orderBy(hash62(seed + 1, "__shuffle_h"), "__shuffle_h")
    ranked = keyed.withColumn("__shuffle_rank", F.row_number().over(order)).join(F.broadcast(upto), "__shuffle_from")
    dealt = ranked.withColumn("shard", F.size(F.filter("__shuffle_upto", lambda u: u < F.col("__shuffle_rank"))).cast("int"))
    # exchange, second permutation
    dealt = dealt.withColumn("__shuffle_h2", hash62(seed + 2, "__shuffle_h"))
    out = numbered(dealt.drop("__shuffle_rank", "__shuffle_upto", "__shuffle_from"), [F.col("__shuffle_h2"), F.col("__shuffle_h")], "slot", ["shard"])
    return out.select(*every, "shard", "slot")
