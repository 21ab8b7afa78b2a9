"""Training-history operators (WIN-2, ML-3).

A history is (run, epoch, loss).  One run holds at most ``epochs`` rows
(50 or 100 in practice), so a window partitioned by run is bounded per task
(``early_stop``).  ``early_stop_scan`` gives the same result for runs of any
length with a parallel segmented scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered_epochs(events: DataFrame, run: str, order: list[str], epoch: str = "epoch") -> DataFrame:
    """Number each run's rows from 1 in ``order`` without gathering a run: a dense index over
    all rows in (run, order), less the index of the run's first row (one partial minimum)."""
    from aspectflow.operators.ordering import with_row_index

    indexed = with_row_index(events, [run, *order], "_at")
    first = indexed.groupBy(F.col(run).alias("_run")).agg(F.min("_at").alias("_first"))
    return (indexed.join(first, F.col(run).eqNullSafe(F.col("_run")))
            .withColumn(epoch, (F.col("_at") - F.col("_first") + 1).cast("int")).drop("_at", "_run", "_first"))


def _comparable(loss) -> Column:
    """A loss as the training loop compares it: NaN and null are no improvement on anything."""
    loss = F.col(loss) if isinstance(loss, str) else loss
    return F.when(loss.isNull() | F.isnan(loss), F.lit(float("inf"))).otherwise(loss.cast("double"))


def improvement_flags(history: DataFrame, run="run", epoch="epoch", loss="val_loss") -> DataFrame:
    """Mark strict improvements (loss < best so far, which starts at infinity:
    a NaN, null or infinite loss never improves) and the streak of epochs since
    the last improvement, or since the start if there was none."""
    w = Window.partitionBy(run).orderBy(epoch)
    value = _comparable(loss)
    prior = F.min(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = history.withColumn("improved", value < F.coalesce(prior, F.lit(float("inf"))))
    last = F.max(F.when(F.col("improved"), F.col(epoch))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn("streak", F.coalesce(F.col(epoch) - last, F.row_number().over(w)).cast("int"))


def early_stop(history: DataFrame, patience: int, run="run", epoch="epoch",
               loss="val_loss") -> DataFrame:
    """WIN-2 + ML-3 per run: the epoch training stops at (first epoch whose
    streak without improvement reaches ``patience``; null if never), and the
    kept parameters = the last improvement at or before the stop."""
    flagged = improvement_flags(history, run, epoch, loss)
    # Epochs after the stop are dropped with a running flag ("did an earlier
    # epoch already reach the patience?") on the same ordered window: every
    # frame is a running one, so rows stream through and share one shuffle
    # and sort; nothing buffers a whole run.
    hit = F.when(F.col("streak") >= patience, 1).otherwise(0)
    earlier = F.max(hit).over(Window.partitionBy(run).orderBy(epoch)
                              .rowsBetween(Window.unboundedPreceding, -1))
    seen = flagged.withColumn("_earlier_stop", F.coalesce(earlier, F.lit(0))) \
        .where(F.col("_earlier_stop") == 0)
    return seen.groupBy(run).agg(
        F.min(F.when(F.col("streak") >= patience, F.col(epoch))).alias("stop_epoch"),
        F.max_by(F.col(epoch), F.when(F.col("improved"), F.col(epoch))).alias("best_epoch"),
        F.max_by(F.col(loss), F.when(F.col("improved"), F.col(epoch))).alias("best_loss"),
        F.count(F.lit(1)).alias("epochs_run"),
    )


def early_stop_scan(history: DataFrame, patience: int, run="run", epoch="epoch",
                    loss="val_loss", num_partitions: int | None = None) -> DataFrame:
    """WIN-2 + ML-3 for histories of any size per run (epochs 1..N per run).

    A parallel segmented scan instead of one window per run: rows are range-
    partitioned on (run, epoch), so a very long run spans many tasks.  Each
    chunk (partition, run) computes its running minimum and last improvement
    locally; the carries from earlier chunks of the same run - at most one
    chunk per partition continues a run, so the carry tables are bounded by
    the partition count and broadcast - complete them.  The per-run result is
    one partial aggregate, using that at the first stop the last
    improvement is exactly ``patience`` epochs back.
    """
    from aspectflow.session import cut_lineage

    spark = history.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(history.select(F.col(run).alias("_run"), F.col(epoch).alias("_ep"),
                                      _comparable(loss).alias("_loss"))
                       .repartitionByRange(n, "_run", "_ep")
                       .withColumn("_part", F.spark_partition_id()))
    chunk = Window.partitionBy("_part", "_run").orderBy("_ep")
    before = chunk.rowsBetween(Window.unboundedPreceding, -1)
    upto = chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier_chunks = Window.partitionBy("_run").orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)

    # carry 1: minimum loss of the run's earlier chunks
    stats = rows.groupBy("_part", "_run").agg(F.min("_loss").alias("_cmin"))
    carry_min = stats.select("_part", "_run", F.min("_cmin").over(earlier_chunks).alias("_carry_min")) \
        .where(F.col("_carry_min").isNotNull())
    flagged = rows.join(F.broadcast(carry_min), ["_part", "_run"], "left")
    prior = F.coalesce(F.least(F.min("_loss").over(before), F.col("_carry_min")), F.lit(float("inf")))
    # stored once: both carries and the streaks read these rows
    flagged = cut_lineage(flagged.withColumn("_prior", prior).withColumn("_improved", F.col("_loss") < F.col("_prior")))

    # carry 2: last improvement epoch of the run's earlier chunks
    last_in_chunk = flagged.groupBy("_part", "_run").agg(
        F.max(F.when(F.col("_improved"), F.col("_ep"))).alias("_clast"))
    carry_last = last_in_chunk.select("_part", "_run",
                                      F.max("_clast").over(earlier_chunks).alias("_carry_last")) \
        .where(F.col("_carry_last").isNotNull())
    scanned = flagged.join(F.broadcast(carry_last), ["_part", "_run"], "left")
    last = F.coalesce(F.greatest(F.max(F.when(F.col("_improved"), F.col("_ep"))).over(upto),
                                 F.col("_carry_last")), F.lit(0))       # epochs count from 1
    scanned = scanned.withColumn("_streak", (F.col("_ep") - last).cast("int"))

    hit = F.when(F.col("_streak") >= patience, F.col("_ep"))
    per_run = scanned.groupBy("_run").agg(
        F.min(hit).alias("stop_epoch"),
        F.min_by("_prior", hit).alias("_loss_before_stop"),
        F.max(F.when(F.col("_improved"), F.col("_ep"))).alias("_last_improved"),
        F.min("_loss").alias("_min_loss"),
        F.count(F.lit(1)).alias("_n"))
    stopped = F.col("stop_epoch").isNotNull()
    at_stop = F.col("stop_epoch") - patience
    best = F.when(stopped, F.when(at_stop > 0, at_stop)).otherwise(F.col("_last_improved"))
    return per_run.select(
        F.col("_run").alias(run), "stop_epoch", best.cast("int").alias("best_epoch"),
        F.when(best.isNotNull(), F.when(stopped, F.col("_loss_before_stop")).otherwise(F.col("_min_loss")))
        .alias("best_loss"),
        F.when(stopped, F.col("stop_epoch")).otherwise(F.col("_n")).cast("long").alias("epochs_run"))
