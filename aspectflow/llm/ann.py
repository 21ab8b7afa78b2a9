"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables cuts K random (Gaussian, hence 2-stable) projections into slots; a bucket is a tuple of slots.
A query visits its own bucket and perturbed ones in the order of their estimated success: the smaller the sum of squared
distances to the slot borders crossed, the sooner.  Buckets hand on the nearest vectors that they hold; these are merged
over tables and ranked by exact distance.  A query that has found too few is compared with all rows, block by block.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.llm.stored import stored
from aspectflow.llm.vectors import stacked, usable

NEIGHBOURS = 10
TABLES = 8
FUNCTIONS = 6
WIDTH = 2.0       # slot width as a multiple of the vectors' root mean square norm
PROBES = 24
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
SEED = 23
FOUND = "query_id long, vec_id long, score double"


def perturbations(into_slot: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
    """The first ``probes`` sets of slot moves for one query, best first; the empty set is its own bucket.

    ``into_slot`` is where in its slot (0 to 1) each projection lies.  Sets come from a heap by shifting or
    extending their last element; a set that moves one projection both ways is passed over.
    """
    moves = sorted([(f * f, k, -1) for k, f in enumerate(into_slot)] + [((1 - f) ** 2, k, 1) for k, f in enumerate(into_slot)])
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(moves[0][0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        if len({moves[i][1] for i in chosen}) == len(chosen):
            out.append(tuple((moves[i][1], moves[i][2]) for i in chosen))
        following = chosen[-1] + 1
        if following < len(moves):
            heapq.heappush(heap, (score - moves[chosen[-1]][0] + moves[following][0], (*chosen[:-1], following)))
            heapq.heappush(heap, (score + moves[following][0], (*chosen, following)))
    return out


def nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of ``rows`` for each of ``queries`` (its own row apart) by exact Euclidean distance; ties to vec_id."""
    q, x = stacked(queries["embedding"]), stacked(rows["embedding"])
    ids = rows["vec_id"].to_numpy()
    # far from the origin the rough distances lose digits: centred they keep most, and the slack bounds what is lost
    centre = x.mean(0)
    qc, xc = q - centre, x - centre
    q2, x2 = (qc * qc).sum(1), (xc * xc).sum(1)
    rough = np.maximum(q2[:, None] + x2[None, :] - 2 * (qc @ xc.T), 0)
    eps, dim = np.finfo(float).eps, q.shape[1]
    # sums of dim products err by dim x eps x their size; centring errs by eps x the coordinates, relative to their distance
    far = float(np.abs(x).max(initial=0)) + float(np.abs(q).max(initial=0))
    out = []
    for line, size, vector, own in zip(rough, q2, q, queries["query_id"]):
        most = size + float(x2.max(initial=0))
        slack = 8 * (dim + 8) * eps * most + 8 * dim * eps * far * (np.sqrt(most) + eps * far)
        line = np.where(ids == own, np.inf, line)
        limit = np.partition(line, min(k, len(line)) - 1)[min(k, len(line)) - 1]
        at = np.flatnonzero(line <= (limit + slack if np.isfinite(limit) else 1e300))
        exact = np.sqrt(((x[at] - vector) ** 2).sum(1))
        best = np.lexsort((ids[at], exact))[:k]
        out.append(pd.DataFrame({"query_id": own, "vec_id": ids[at][best], "score": exact[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS, tables: int = TABLES, functions: int = FUNCTIONS,
           width: float = WIDTH, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the k nearest found for every row where ``is_query`` holds.

    Candidates are all rows but the query's own; a query with fewer than k other rows of its length gets them all.
    Vectors that are null, empty, zero or hold null or non-finite components, and rows without vec_id, take no part.
    Rows that repeat vec_id and vector count once.  Columns beyond vec_id and embedding are not looked at.
    """
    good = stored(vectors.select("vec_id", "embedding").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
                  .dropDuplicates(["vec_id", "embedding"]), "vectors")
    norm = good.agg(F.sqrt(F.avg(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()[0]
    slot = width * (norm or 1.0)

    def hashed(probing: bool):
        def run(batches):
            for batch in batches:
                pdf = batch.to_pandas()
                for _, part in pdf.groupby(pdf["embedding"].map(len)):
                    x = stacked(part["embedding"])
                    rng = np.random.default_rng([seed, x.shape[1]])
                    ids, buckets = [], []
                    for t in range(tables):
                        place = (x @ rng.normal(size=(x.shape[1], functions)) + rng.uniform(0, slot, functions)) / slot
                        weights = rng.integers(1, 1 << 62, functions, dtype=np.int64) | 1
                        home = np.floor(place).astype(np.int64)
                        code = home @ weights + np.int64(t * 7919 + x.shape[1])
                        if not probing:
                            ids.append(part["vec_id"].to_numpy())
                            buckets.append(code)
                            continue
                        for own, at, c in zip(part["vec_id"], place - home, code):
                            sets = perturbations(at, probes)
                            ids.append(np.full(len(sets), own))
                            buckets.append(np.array([_wrapped(int(c) + sum(int(weights[f]) * d for f, d in s))
                                                     for s in sets], np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids).astype(np.int64)), pa.array(np.concatenate(buckets))],
                                                     names=["vec_id", "bucket"])
        return run

    schema = "vec_id long, bucket long"
    asked = good.where(is_query)
    entries = good.mapInArrow(hashed(False), schema)
    visits = stored(asked.mapInArrow(hashed(True), schema).withColumnRenamed("vec_id", "query_id").distinct(), "visits")
    # both sides of a bucket are cut into blocks, and every block of one meets every block of the other
    sizes = (entries.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("nb"))
             .join(visits.groupBy("bucket").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("nq")), "bucket"))
    rows = (entries.join(sizes, "bucket").withColumn("s", F.pmod(F.xxhash64("vec_id"), F.col("nb")))
            .withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq") - 1))).join(good, "vec_id")
            .select("bucket", "s", "r", "vec_id", "embedding"))
    queries = (visits.join(sizes, "bucket").withColumn("r", F.pmod(F.xxhash64("query_id"), F.col("nq")))
               .withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
               .join(asked.withColumnRenamed("vec_id", "query_id"), "query_id")
               .select("bucket", "s", "r", "query_id", "embedding"))

    def rank(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat([nearest(q[q["embedding"].map(len) == n], part, k) for n, part in x.groupby(x["embedding"].map(len))
                          if (q["embedding"].map(len) == n).any()])

    def met(q_rows: DataFrame, x_rows: DataFrame, keys: list[str]) -> DataFrame:
        return q_rows.groupBy(*keys).cogroup(x_rows.groupBy(*keys)).applyInPandas(rank, FOUND)

    found = stored(_top(met(queries, rows, ["bucket", "s", "r"]), k), "found")
    # exact way for the rest: who found fewer than k is held against all rows, in blocks
    few = (asked.join(found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")), "vec_id", "left")
           .where(F.coalesce("n", F.lit(0)) < k).select(F.col("vec_id").alias("query_id"), "embedding"))
    few = stored(few, "few")
    n_few = few.count()
    if n_few:
        blocks, parts = -(-good.count() // BLOCK_ROWS), -(-n_few // QUERY_ROWS)
        numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        all_rows = good.withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn("r", numbers(parts))
        rest = few.withColumn("r", F.pmod(F.xxhash64("query_id"), F.lit(parts))).withColumn("s", numbers(blocks))
        exact = _top(met(rest, all_rows, ["s", "r"]), k)
        found = found.join(few.select("query_id"), "query_id", "left_anti").unionByName(exact)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _wrapped(x: int) -> int:
    """A Python integer as a signed 64-bit one."""
    return ((x + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)
