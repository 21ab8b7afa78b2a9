"""Entry point C: retrain -> evaluate -> promote-if-better, and model
resolution for the scoring stream (ML-1/4/5/6, SNK-7/8/9, SRC-5/6/9)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.ml import epochs as EP
from aspectflow.operators import registry as RG
from aspectflow.operators import vocab as V
from aspectflow.schemas import ASPECTS, DEFAULT_MODEL_NAME, MAX_VOCAB, REGISTRY
from aspectflow.session import cut_lineage_columnar
from aspectflow.sources import io as IO
from aspectflow.sources.registry_log import RegistryLog


@dataclass
class RetrainResult:
    macro_f1: float
    balanced_acc: float
    promoted: bool
    model_name: str | None


def preprocess(train: DataFrame, text_col: str = "Review", aspects=ASPECTS,
               max_vocab: int = MAX_VOCAB, out_dir: str | None = None):
    """Clean, build the vocabulary on the training texts, shift labels to
    0..3 (PRJ-9).  With ``out_dir``, persist vocabulary and encoded rows."""
    key = "row_id" if "row_id" in train.columns else None
    base = train.withColumn("row_id", F.monotonically_increasing_id()) if key is None else train
    shifted = base.select("row_id", text_col,
                          *[(F.col(a) + 1).cast("int").alias(a) for a in aspects])
    cleaned = V.cleaned(shifted, text_col, keep=["row_id", *aspects])
    vocab = V.build_vocab(cleaned, max_vocab, id_col="row_id")
    if out_dir:
        IO.save_vocab(vocab, f"{out_dir}/vocab")
        IO.save_encoded(V.encode(cleaned, vocab, id_col="row_id", keep=list(aspects)),
                        f"{out_dir}/encoded")
    return cleaned, vocab


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry; empty only if its folder isn't there (first run).  Any other
    trouble is raised: a registry that can't be read must not look empty.  Where a
    commit log is kept, that is what counts."""
    log = RegistryLog(spark, path)
    if log.exists():
        return log.frame()
    return spark.read.schema(REGISTRY).parquet(path) if IO.path_exists(spark, path) else RG.empty_registry(spark)


CHOOSING = 5         # one training row in five is not trained on: it chooses the epoch


def retrain(spark: SparkSession, train: DataFrame, val: DataFrame, registry_path: str,
            models_dir: str, text_col: str = "Review", aspects=ASPECTS,
            max_vocab: int = MAX_VOCAB, max_iter: int = 50, patience: int = 10, rate: float = 0.05,
            history_path: str | None = None) -> RetrainResult:
    """Train by epochs, at most ``max_iter`` of them, stopped early by the loss of a fifth of the training
    rows (by a hash) that are not trained on; then score the validation rows, which had no part in that
    choice, and promote the model only if its macro-F1 is strictly better than the registry's best.

    A promoted model is saved as ``cnn_v<id>.pth`` (with its vocabulary); the registry row is committed
    against the version that the decision was made on, and made anew if another promoter was faster.  A
    worse or equal model leaves no trace.  ``history_path`` keeps the run's losses."""
    cleaned, vocab = preprocess(train, text_col, aspects, max_vocab)
    cleaned = cut_lineage_columnar(cleaned, "retrain_rows")
    choosing = F.pmod(F.xxhash64("row_id", "clean_text"), F.lit(CHOOSING)) == 0
    held, rest = cleaned.where(choosing), cleaned.where(~choosing)
    if not held.limit(1).count() or not rest.limit(1).count():      # too few rows to part
        held = rest = cleaned
    vocab = cut_lineage_columnar(vocab, "retrain_vocab")
    model, history = EP.train_epochs(rest, held, vocab, list(aspects), "row_id", epochs=max_iter, patience=patience, rate=rate)
    if history_path:
        history.coalesce(1).write.mode("overwrite").parquet(history_path)
    val_rows = V.cleaned(val.withColumn("_vid", F.monotonically_increasing_id()).select(
        "_vid", text_col, *[(F.col(a) + 1).cast("int").alias(a) for a in aspects]),
        text_col, keep=["_vid", *aspects])
    _, confusion = EP.judged(EP.prepared(val_rows, vocab, list(aspects), "_vid")[0], model)
    macro_f1, balanced_acc = EP.scores(confusion)
    log = RegistryLog(spark, registry_path)
    staged = f"{models_dir.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    EP.save(model, spark, staged)
    row = log.promote(macro_f1, balanced_acc, staged, models_dir)
    return RetrainResult(macro_f1, balanced_acc, row is not None, row and row["model_name"])


def resolve(spark: SparkSession, registry_path: str, models_dir: str,
            default: str = DEFAULT_MODEL_NAME) -> str:
    """ML-6: the best registry model if its artefact exists, else the default."""
    RegistryLog(spark, registry_path).settle(models_dir)
    registry = read_registry(spark, registry_path)
    names = _model_dirs(spark, models_dir)
    return RG.resolve_model(registry, names, default).first().model_name


def _model_dirs(spark: SparkSession, models_dir: str) -> DataFrame:
    """Saved model folders (each holds ``pipeline/`` or ``weights/``), names only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(models_dir)
    fs = root.getFileSystem(conf)
    names = []
    if fs.exists(root):
        for st in fs.listStatus(root):
            if st.isDirectory() and any(fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), x)) for x in ("pipeline", "weights")):
                names.append((st.getPath().getName(),))
    return spark.createDataFrame(names, "model_name string")
