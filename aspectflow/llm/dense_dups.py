"""Embedding near-duplicates by lattice hashing.

Several tables of random projections to two 8-dimensional subspaces; each projection is decoded to its nearest point of
the lattice E8, and the pair of lattice points (with the label) is a bucket.  A vector enters its own bucket and probes
the neighbouring ones in order of distance.  Vectors that meet are compared by exact cosine in double precision.

A bucket hands on only a spanning forest of its links, so a crowded bucket's output is linear in its rows; connected
components of those links are the classes.  Links are then counted inside each class, block against block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.llm.stored import connected_components, stored
from aspectflow.llm.vectors import counted_here, in_blocks, stacked, unscaled, usable

THRESHOLD = 0.98
TABLES = 8
PROBES = 6
SCALE = 0.6       # a pair at cosine 0.98 of unit vectors is then about 0.34 apart in each subspace; cells are 1 in volume
SEED = 11
_CHOICES = ((), (0, 1), (0, 2), (1, 2), (0, 3)), ((0,), (1,), (2,), (3,), (0, 1, 2))


def near_e8(x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` nearest found E8 points of each line of ``x`` (doubled, so integers) and their squared distances.

    E8 is D8 (integers with even sum) and D8 shifted by a half.  In either coset the nearest point rounds every
    coordinate and, if the sum is odd, moves the least certain one to its other side; runners-up move the next
    least certain ones, keeping the sum even.
    """
    points, dists = [], []
    rows = np.arange(len(x))[:, None]
    for shift in (0.0, 0.5):
        y = x - shift
        base = np.rint(y)
        err = y - base
        order = np.argsort(-np.abs(err), axis=1, kind="stable")
        odd = (base.sum(1).astype(np.int64) & 1).astype(bool)
        step = np.where(err >= 0, 1.0, -1.0)
        for even_move, odd_move in zip(*_CHOICES):
            p = base.copy()
            for which, move in ((~odd, even_move), (odd, odd_move)):
                for m in move:
                    at = order[:, m:m + 1]
                    p[rows[which], at[which]] += step[rows[which], at[which]]
            points.append(np.rint(2 * (p + shift)).astype(np.int64))
            dists.append(((x - p - shift) ** 2).sum(1))
    d = np.stack(dists, axis=1)
    best = np.argsort(d, axis=1, kind="stable")[:, :keep]
    return np.stack(points, axis=1)[rows, best], np.take_along_axis(d, best, axis=1)


def lattice_cells(unit: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """(vectors x tables x probes) bucket numbers; the first probe is the vector's own bucket."""
    n, dim = unit.shape
    rng = np.random.default_rng([seed, dim])
    out = np.empty((n, tables, probes), np.int64)
    side = min(4, probes)
    for t in range(tables):
        halves = []
        for _ in range(2):
            a, b = rng.normal(size=(dim, 8)) * scale, rng.uniform(0, 2, 8)
            halves.append(near_e8(unit @ a + b, side))
        (p1, d1), (p2, d2) = halves
        total = (d1[:, :, None] + d2[:, None, :]).reshape(n, -1)
        order = np.argsort(total, axis=1, kind="stable")[:, :probes]
        weights = rng.integers(1, 1 << 62, size=16, dtype=np.int64) | 1
        key1, key2 = p1 @ weights[:8], p2 @ weights[8:]       # wraps around: a hash of the 16 coordinates
        i, j = order // side, order % side
        r = np.arange(n)[:, None]
        cell = (key1[r, i] ^ (key2[r, j] * np.int64(0x5851F42D4C957F2D))) * np.int64(2 * t + 1)
        out[:, t, :order.shape[1]] = cell
        out[:, t, order.shape[1]:] = cell[:, :1]
    return out


def cosine_links(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of pairs with cosine at or above the threshold, in double precision, without the diagonal."""
    vectors = unscaled(vectors)
    norms = np.sqrt((vectors * vectors).sum(1))
    linked = (vectors @ vectors.T) / np.outer(norms, norms) >= threshold
    np.fill_diagonal(linked, False)
    return linked


def spanning_links(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """One link per vector that joins it to its class's first member found (a forest, not all links)."""
    left, out = np.ones(len(ids), bool), []
    for start in range(len(ids)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & left)
            left[found] = False
            queue.extend(found.tolist())
            out.extend((int(ids[start]), int(ids[f])) for f in found)
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES,
                    scale: float = SCALE, seed: int = SEED) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Links join vectors of one label (not null) and one length.  A vector that is null, empty, zero or holds a null or
    non-finite component links with nothing, and neither does one without vec_id.  Rows that repeat vec_id, label and
    vector are one vector, reported once per row.  Columns beyond the three are not looked at.
    """
    cols = vectors.select("vec_id", "embedding", "label")
    good = stored(cols.where(usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
                  .dropDuplicates(["vec_id", "label", "embedding"]), "vectors")

    def hashed(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            for _, part in pdf.groupby(pdf["embedding"].map(len)):
                x = unscaled(stacked(part["embedding"]))
                cells = lattice_cells(x / np.sqrt((x * x).sum(1, keepdims=True)), tables, probes, scale, seed)
                # the label and the length are part of the bucket
                salt = (part["label"].to_numpy(np.int64) * 1_000_003 + x.shape[1]) * np.int64(0x2545F4914F6CDD1D)
                cells ^= salt[:, None, None]
                n = cells.shape[1] * cells.shape[2]
                own = np.zeros(cells.shape, bool)
                own[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part["vec_id"].to_numpy(), n)), pa.array(cells.ravel()), pa.array(own.ravel())],
                    names=["vec_id", "cell", "own"])

    entries = (good.mapInArrow(hashed, "vec_id long, cell long, own boolean")
               .groupBy("cell", "vec_id").agg(F.max("own").alias("own")))
    entries = stored(entries, "cells")
    # only cells that somebody owns and somebody else enters carry vectors
    busy = entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("own").alias("o")).where("n > 1 and o").select("cell")
    members = in_blocks(entries.join(busy, "cell", "left_semi").select("cell", "vec_id"), "cell", "vec_id")

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby(["label", pdf["embedding"].map(len)], sort=False):   # a cell's hash may collide
            out += spanning_links(part["vec_id"].to_numpy(), cosine_links(stacked(part["embedding"]), threshold))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    links = (members.select("cell", "_i", "_j", "vec_id").join(good, "vec_id")
             .groupBy("cell", "_i", "_j").applyInPandas(forest, "a long, b long").distinct())
    classes = stored(connected_components(links), "classes")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, blocks = int(pdf["_i"].iloc[0]), int(pdf["_j"].iloc[0]), int(pdf["_nb"].iloc[0])
        linked = np.zeros((len(pdf), len(pdf)), bool)
        for _, at in pdf.groupby([pdf["label"], pdf["embedding"].map(len)], sort=False).indices.items():
            linked[np.ix_(at, at)] = cosine_links(stacked(pdf["embedding"].iloc[at]), threshold)
        block = pdf["_blk"].to_numpy()
        here = {int(b): counted_here(int(b), i, j, blocks) for b in set(block.tolist())}
        same = block[:, None] == block[None, :]
        linked &= ~same | np.array([here[int(b)] for b in block])[:, None]
        return pd.DataFrame({"vec_id": pdf["vec_id"], "n": linked.sum(1)})

    in_class = in_blocks(classes.withColumnRenamed("node", "vec_id"), "component", "vec_id")
    counts = (in_class.join(good, "vec_id").groupBy("component", "_i", "_j").applyInPandas(count, "vec_id long, n long")
              .groupBy("vec_id").agg(F.sum("n").alias("n_links")))
    found = classes.withColumnRenamed("node", "vec_id").join(counts, "vec_id")
    return (cols.select("vec_id").join(found, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"),
                    F.coalesce("component", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept")))
