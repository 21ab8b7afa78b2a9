"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

The mean repetition rate of a source is what brings it to its target share.  Every document gets a uniform number
from a seeded hash of its content; the Poisson distribution function of its source's rate, inverted at that number,
is its number of copies.  Copies are exploded and the whole is shuffled globally by a hash of (document, copy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7
TEMPERATURE = 0.5
SPAN = float(1 << 52)
RATES_BYTES = 64 << 20      # distributions of all sources up to this size go to every task
DIRECT = 700.0              # up to this rate exp(-rate) is a number to start from


def uniform(seed: int, *cols) -> Column:
    """Uniform in [0, 1) from the first 13 hex digits of an MD5 over the seed and the columns as text."""
    text = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) if isinstance(c, str) else c
                                                for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(SPAN)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None,
                 temperature: float = TEMPERATURE, epochs: float = 1.0) -> DataFrame:
    """(source, n_docs, n_bytes, weight, rate): how often a document of each source shall appear on average.

    A source's amount is its UTF-8 bytes.  ``weights`` gives target shares (a source it does not name gets none);
    without it the share is amount ** temperature.  The mix as a whole has ``epochs`` times the input's bytes.
    A source without any bytes has rate 1: it can't change the mix and its rows stay as they are.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    per = docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(size).cast("double").alias("n_bytes"))
    if weights is None:
        per = per.withColumn("weight", F.pow("n_bytes", F.lit(temperature)))
    else:
        given = F.lit(0.0)
        for name, w in weights.items():
            given = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(given)
        per = per.withColumn("weight", given)
    total = per.agg(F.sum("n_bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    rate = F.when(F.col("n_bytes") > 0, F.lit(float(epochs)) * F.col("all_bytes") * F.col("weight")
                  / F.col("all_weight") / F.col("n_bytes")).otherwise(F.lit(1.0))
    return (per.join(F.broadcast(total)).select("source", "n_docs", F.col("n_bytes").cast("long").alias("n_bytes"),
                                   (F.col("weight") / F.col("all_weight")).alias("weight"), rate.alias("rate")))


def poisson_thresholds(rate: Column) -> Column:
    """Struct (first, cdf): the distribution function of Poisson(rate) at first, first + 1, ... up to where it is 1.

    Terms follow p(k) = p(k - 1) * rate / k.  12 standard deviations and 40 more leave less than 2^-53 beyond.  Up to a
    rate of ``DIRECT`` they start from exp(-rate) at 0.  Above it, where exp(-rate) comes near 0, they start as far below
    the mean, from 1, and are divided by their sum, so that the function is the same for every rate.
    """
    last = (F.ceil(rate + 12 * F.sqrt(rate)) + 40).cast("int")
    low = F.when(rate > DIRECT, (F.floor(rate - 12 * F.sqrt(rate)) - 40).cast("int")).otherwise(F.lit(0))
    start = F.when(rate > DIRECT, F.lit(1.0)).otherwise(F.exp(-rate))
    zero = F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("all"))
    grown = F.aggregate(F.sequence(low + 1, last), zero, lambda s, k: F.struct(
        (s["p"] * rate / k).alias("p"), (s["c"] + s["p"] * rate / k).alias("c"),
        F.concat(s["all"], F.array(s["c"] + s["p"] * rate / k)).alias("all")),
        lambda s: F.when(rate > DIRECT, F.transform(s["all"], lambda c: c / s["c"])).otherwise(s["all"]))
    return F.struct(low.alias("first"), grown.alias("cdf"))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE,
          epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` with ``copies``, ``copy_no`` (from 0), ``rate`` and ``mix_key``, globally shuffled.

    Every rate gives rows.  A document with 0 copies does not appear.  The draw depends on doc_id and text only, so repeated rows get equal
    numbers of copies each.  A null source is a source of its own; null text has no bytes.  The rates (one row per
    source) travel to the documents by a join that Spark may broadcast by size; a hot source needs no shuffle of
    its own, as documents are never grouped by source, and the shuffle is by the uniform ``mix_key``, a hash of doc_id,
    copy number and text.  Equal rows are interchangeable; rows of one doc_id with other texts, null among them, are
    spread like any others.  An empty table gives an empty result.  Input columns with the added names are replaced.
    """
    docs = docs.drop("copies", "copy_no", "rate", "mix_key")
    rates = source_rates(docs, weights, temperature, epochs)
    rates = rates.select(F.col("source").alias("__mix_source"), "rate", poisson_thresholds(F.col("rate")).alias("__mix_cdf"))
    draw = uniform(seed, "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    # one distribution per source, longer for larger rates: sent while small
    size = rates.agg(F.sum(F.size("__mix_cdf.cdf"))).first()[0] or 0
    sources = F.broadcast(rates) if size * 8 <= RATES_BYTES else rates
    out = (docs.join(sources, F.col("source").eqNullSafe(F.col("__mix_source")))
           .withColumn("copies", (F.col("__mix_cdf.first") + F.size(F.filter("__mix_cdf.cdf", lambda c: c <= draw))).cast("int"))
           .withColumn("copy_no", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1))
                                            .otherwise(F.array().cast("array<int>"))))
           .drop("__mix_source", "__mix_cdf"))
    key = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(f"mix{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("~")),
                                               F.col("copy_no").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))
                                               ).cast("binary")), 1, 13), 16, 10).cast("long")
    return out.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key", "doc_id", "copy_no")
