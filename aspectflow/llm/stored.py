"""Intermediate tables in the shared folder, connected components, and gapless numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a recomputation.
    """
    path = shared_path(df.sparkSession, name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the undirected ``links``; component is the smallest node reachable.

    Alternating large-star and small-star steps: every node's larger (smaller) neighbours are linked to its
    smallest neighbour, until nothing changes.  Each step is two aggregations with map-side combine, so a node
    with very many links needs no list of them; the number of steps grows with the logarithm of the diameter.
    Self-links are ignored; nodes without links do not appear.
    """
    a_, b_ = F.col(a), F.col(b)
    edges = stored(links.where(a_ != b_).select(F.greatest(a_, b_).alias("hi"), F.least(a_, b_).alias("lo"))
                   .distinct(), "links")
    while True:
        # large-star: neighbours above a node go to the smallest of the node and its neighbours
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .where("hi != lo").distinct())
        # small-star: a node and its smaller neighbours go to the smallest of them
        least2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least2, "hi")
                 .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").where("hi != lo").distinct())
        new = stored(small, "links")
        changed = (new.select("hi", "lo", F.lit(1).alias("w"))
                   .union(edges.select("hi", "lo", F.lit(-1).alias("w")))
                   .groupBy("hi", "lo").agg(F.sum("w").alias("w")).where("w != 0").limit(1).count())
        edges = new
        if not changed:
            break
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)


def numbered(df: DataFrame, order: list, into: str, within: list[str] | None = None, lots: int = 64) -> DataFrame:
    """Gapless numbers from 0, over all rows or ``within`` each key, in the order of a hash column.

    ``order[0]`` must be a non-negative long that is uniform over [0, 2^62); its high bits cut every key into
    ``lots`` ranges.  Rows are numbered inside a range (a bounded group, however hot the key) and the ranges'
    row counts, summed up in order, give the offset of each range.
    """
    keys = list(within or [])
    lot = F.shiftright(order[0], 48) * lots
    df = df.withColumn("__lot", F.shiftright(lot, 14).cast("int"))
    local = Window.partitionBy(*keys, "__lot").orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(local))
    sizes = df.groupBy(*keys, "__lot").agg(F.count("*").alias("__n"))
    running = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__lot")
    # lots rows per key: the caller's keys must be few (shards), so this is broadcast
    offsets = sizes.withColumn("__before", F.sum("__n").over(running) - F.col("__n")).select(*keys, "__lot", "__before")
    out = ranked.join(F.broadcast(offsets), [*keys, "__lot"])
    return out.withColumn(into, F.col("__before") + F.col("__rank") - 1).drop("__lot", "__rank", "__before")
