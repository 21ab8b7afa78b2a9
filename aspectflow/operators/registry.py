"""Model registry: promote-if-better, best model, resolution (WIN-3, AGG-13,
TOP-5, JOIN-6, ML-5, ML-6).

The registry holds one row per promoted model, so it grows with the number
of retraining runs (hourly), not with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aspectflow.schemas import DEFAULT_MODEL_NAME, MODEL_NAME_FORMAT, REGISTRY


def empty_registry(spark) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def current_best(registry: DataFrame) -> DataFrame:
    """AGG-13: best macro-F1 so far, 0.0 for an empty registry."""
    return registry.agg(F.coalesce(F.max("macro_f1"), F.lit(0.0)).alias("best_f1"))


def best_model(registry: DataFrame) -> DataFrame:
    """TOP-5: macro_f1 desc, id desc, first row."""
    return registry.orderBy(F.col("macro_f1").desc(), F.col("id").desc()).limit(1)


def model_name(id_col) -> F.Column:
    """STR-6: model artefact name for a registry id."""
    return F.format_string(MODEL_NAME_FORMAT, F.col(id_col) if isinstance(id_col, str) else id_col)


def promote_candidates(registry: DataFrame, candidates: DataFrame, order_col: str,
                       created_at=None) -> DataFrame:
    """ML-5 over a sequence of candidates (macro_f1, balanced_acc) in
    ``order_col`` order, each checked against the registry as it stands.

    Candidate i is promoted iff its F1 is strictly greater than the best of the
    registry and of every earlier candidate (every earlier candidate that beat
    the best was promoted, so the running maximum is the registry's best).
    Ids continue the registry's serial; a rejected candidate leaves no trace.
    Returns the rows to append.
    """
    best = registry.agg(F.coalesce(F.max("macro_f1"), F.lit(0.0)).alias("_best"),
                        F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("_max_id"))
    before = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    scored = candidates.withColumn("_prior", F.max("macro_f1").over(before))
    # registry stats are a single row; attach them as literals of one scalar job
    stats = best.first()
    reg_best, reg_max_id = float(stats["_best"]), int(stats["_max_id"])
    threshold = F.greatest(F.lit(reg_best), F.coalesce(F.col("_prior"), F.lit(reg_best)))
    promoted = scored.where(F.col("macro_f1") > threshold)
    numbered = promoted.withColumn(
        "id", (F.row_number().over(Window.orderBy(order_col)) + F.lit(reg_max_id)).cast("long"))
    ts = created_at if created_at is not None else F.current_timestamp()
    return numbered.select(
        "id", model_name("id").alias("model_name"),
        F.col("macro_f1").cast("double").alias("macro_f1"),
        F.col("balanced_acc").cast("double").alias("balanced_acc"),
        (ts(F.col("id")) if callable(ts) else ts).alias("created_at"))


def artefact_names(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Model file names from a ``binaryFile``-style listing."""
    return listing.select(F.regexp_extract(F.col(path_col), r"([^/]+)$", 1).alias("model_name"))


def resolve_model(registry: DataFrame, artefacts: DataFrame,
                  default: str = DEFAULT_MODEL_NAME) -> DataFrame:
    """ML-6 + JOIN-6: the top registry row's model if its artefact exists,
    else the default model - never the second best."""
    top = best_model(registry).select("model_name")
    present = top.join(artefacts.select("model_name").distinct(), "model_name", "left_semi")
    return present.agg(F.coalesce(F.max("model_name"), F.lit(default)).alias("model_name"))
