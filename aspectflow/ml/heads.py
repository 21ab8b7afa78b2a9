"""One 4-class head per aspect over a shared bag-of-words.

Re-aimed from the reference's single-machine convolutional trainer: the
vocabulary (WIN-1) fixes the feature space through
``CountVectorizerModel.from_vocabulary``; each aspect gets a multinomial
``LogisticRegression`` trained by distributed L-BFGS (tree aggregation of
gradients, so no task ever holds the data set).  Scoring is row-local:
a review's labels never depend on the other rows of its batch (Q5).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aspectflow.functions.scores import label_name
from aspectflow.functions.text import tokenize_clean
from aspectflow.operators import metrics
from aspectflow.schemas import ASPECTS, LABEL_NAMES, NUM_CLASSES, PAD_TOKEN, UNK_TOKEN

TOKENS = "_tokens"
FEATURES = "_features"
N_TOKENS = "_n_tokens"
PARTITION_TOKENS = 4_000_000        # of a partition of cached features: 48 MB at 12 bytes each, less where words repeat


@dataclass
class AspectModel:
    pipeline: PipelineModel
    aspects: list[str]
    words: list[str]

    def head(self, aspect: str):
        return self.pipeline.stages[1 + self.aspects.index(aspect)]


def _nominal(col: str, n: int = NUM_CLASSES) -> F.Column:
    """Label column with nominal metadata, so every head has all n classes
    even when the training data lacks one."""
    return F.col(col).cast("double").alias(
        col, metadata={"ml_attr": {"type": "nominal", "num_vals": n, "name": col}})


def vocab_words(vocab: DataFrame) -> list[str]:
    """Vocabulary words in id order, without <PAD>/<UNK> (bounded: <= max_vocab)."""
    rows = vocab.where(~F.col("token").isin(PAD_TOKEN, UNK_TOKEN)).orderBy("id").collect()
    return [r.token for r in rows]


def with_tokens(df: DataFrame, text_col: str = "ReviewText", cleaned: bool = False) -> DataFrame:
    """Add the token column; raw text is cleaned first by the table-level
    cleaner (RE2 whitelist pass in Arrow), all other columns pass through."""
    if cleaned:
        base, text = df, F.col(text_col)
    else:
        from aspectflow.operators.vocab import cleaned as clean_table

        base = clean_table(df, text_col, out="_clean_text",
                           keep=[c for c in df.columns if c != "_clean_text"])
        text = F.col("_clean_text")
    out = base.withColumn(TOKENS, F.coalesce(tokenize_clean(text), F.array().cast("array<string>")))
    return out if cleaned else out.drop("_clean_text")


def train_heads(train: DataFrame, vocab: DataFrame, aspects=ASPECTS, text_col: str = "ReviewText",
                cleaned: bool = False, reg_param: float = 0.01, max_iter: int = 50,
                parallelism: int = 8, partitions: int | None = None) -> AspectModel:
    """ML-1: fit the heads.  ``train`` holds the text and one stored label
    (0..3) per aspect.  ``partitions`` coalesces the cached features (an
    iterative job over many tiny partitions pays for tasks, not for data), to
    more partitions where one would hold over ``PARTITION_TOKENS`` tokens.  The
    features are persisted once, without texts and tokens, and shared by all
    heads instead of being recomputed per head."""
    words = vocab_words(vocab)
    cv = CountVectorizerModel.from_vocabulary(words, inputCol=TOKENS, outputCol=FEATURES)
    heads = [LogisticRegression(family="multinomial", featuresCol=FEATURES, labelCol=a,
                                predictionCol=f"{a}_pred", rawPredictionCol=f"{a}_raw",
                                probabilityCol=f"{a}_prob", regParam=reg_param, maxIter=max_iter)
             for a in aspects]
    data = with_tokens(train.select(text_col, *[_nominal(a) for a in aspects]), text_col, cleaned)
    sized = cv.transform(data).withColumn(N_TOKENS, F.size(TOKENS))
    cached = sized.select(FEATURES, *[F.col(a) for a in aspects], N_TOKENS).persist()
    n_tokens = cached.agg(F.sum(N_TOKENS)).first()[0] or 0      # materialises the features with full parallelism
    feats = cached.coalesce(max(partitions, -(-n_tokens // PARTITION_TOKENS))) if partitions else cached
    try:
        # Heads are independent: fit them concurrently.  Each L-BFGS step is
        # a small tree-aggregate job, so running the heads' jobs side by side
        # keeps the executors busy instead of waiting on one head at a time.
        with ThreadPoolExecutor(max_workers=max(1, min(len(heads), parallelism))) as pool:
            fitted = list(pool.map(lambda lr: lr.fit(feats), heads))
    finally:
        cached.unpersist()
    model = PipelineModel(stages=[cv, *fitted])
    return AspectModel(model, list(aspects), words)


def score(df: DataFrame, model: AspectModel, text_col: str = "ReviewText", keep=None,
          cleaned: bool = False) -> DataFrame:
    """ML-2: 8 label names per text, native (JVM) scoring; heads of epoch training score themselves."""
    if not isinstance(model, AspectModel):
        return model.score(df, text_col, keep, cleaned)
    keep = list(df.columns) if keep is None else list(keep)
    out = model.pipeline.transform(with_tokens(df, text_col, cleaned))
    return out.select(*keep, *[label_name(F.col(f"{a}_pred").cast("int")).alias(a)
                               for a in model.aspects])


def stream_scorer(model: AspectModel, all_aspects=ASPECTS):
    """Scorer for ``run_reviews_stream``: native scoring, and every aspect the
    model has no head for is NONE."""
    def _score(reviews: DataFrame) -> DataFrame:
        scored = score(reviews, model)
        missing = [F.lit("NONE").alias(a) for a in all_aspects if a not in model.aspects]
        return scored.select("*", *missing)

    return _score


def head_weights(model: AspectModel) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (heads x classes x words) and intercepts (heads x classes)."""
    w = np.stack([model.head(a).coefficientMatrix.toArray() for a in model.aspects])
    b = np.stack([model.head(a).interceptVector.toArray() for a in model.aspects])
    return w, b


def scoring_udf(model: AspectModel, names=LABEL_NAMES):
    """UDF-1/UDF-3: the same linear heads as an Arrow UDF (clean text in,
    array of label names out).  Weights and vocabulary are broadcast once per
    executor.  Per batch everything is vectorised: split, ``index_in`` on the
    vocabulary, then per (head, class) one weighted ``bincount`` over the
    tokens - memory grows with the batch's tokens, never rows x vocabulary.
    For streams that must run Python scoring; ``score`` is the native path."""
    return linear_udf(model.words, *head_weights(model), names)


def linear_udf(words: list[str], weights: np.ndarray, bias: np.ndarray, names=LABEL_NAMES):
    """The Arrow UDF behind ``scoring_udf``: weights (heads x classes x words) and
    bias (heads x classes); the first class wins a tie."""
    import pyarrow as pa

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    bc = spark.sparkContext.broadcast((weights, bias, pa.array(words, pa.string())))
    label_array = np.array(list(names), dtype=object)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _score(texts: pd.Series) -> pd.Series:
        import pyarrow.compute as pc

        weights, bias, vocab_tokens = bc.value
        n = len(texts)
        arr = pa.array(texts, type=pa.string(), from_pandas=True)
        lists = pc.split_pattern(pc.fill_null(arr, ""), " ")
        idx = pc.index_in(pc.list_flatten(lists), value_set=vocab_tokens)
        known = pc.is_valid(idx)
        words = pc.filter(idx, known).to_numpy(zero_copy_only=False)
        owners = pc.filter(pc.list_parent_indices(lists), known).to_numpy(zero_copy_only=False)
        logits = np.repeat(bias[None, :, :], n, axis=0)
        for h in range(weights.shape[0]):
            for c in range(weights.shape[1]):
                logits[:, h, c] += np.bincount(owners, weights=weights[h, c, words], minlength=n)
        pred = logits.argmax(axis=2)            # first index on ties
        return pd.Series(label_array[np.minimum(pred, len(label_array) - 1)].tolist())

    return _score


def evaluate(model: AspectModel, val: DataFrame, key: str, text_col: str = "ReviewText",
             cleaned: bool = False) -> DataFrame:
    """ML-4: macro-F1 (fixed four classes) and balanced accuracy over all
    aspects of the validation rows."""
    scored = model.pipeline.transform(with_tokens(val, text_col, cleaned))
    # truth and prediction are in the same scored row: no join back
    typed = scored.select(key, *[F.col(a).cast("int").alias(f"_t_{a}") for a in model.aspects],
                          *[F.col(f"{a}_pred").cast("int").alias(f"_p_{a}") for a in model.aspects])
    pairs = metrics.pairs_in_row(typed, [key], {a: f"_t_{a}" for a in model.aspects},
                                 {a: f"_p_{a}" for a in model.aspects})
    return metrics.classification_metrics(pairs)


def validation_loss(model: AspectModel, val: DataFrame, text_col: str = "ReviewText", cleaned: bool = False) -> float:
    """Mean cross-entropy of the heads over the validation rows and aspects (AGG-12's measure)."""
    scored = model.pipeline.transform(with_tokens(val, text_col, cleaned))
    rows = [-F.log(F.greatest(F.get(vector_to_array(f"{a}_prob"), F.col(a).cast("int")), F.lit(1e-15))) for a in model.aspects]
    return float(scored.agg(F.avg(sum(rows[1:], rows[0]) / len(rows))).first()[0])


def train_with_validation(train: DataFrame, val: DataFrame, vocab: DataFrame, aspects=ASPECTS, reg_params=(1.0, 0.1, 0.01, 0.001),
                          patience: int = 2, **options) -> tuple[AspectModel, DataFrame]:
    """ML-3: candidates of falling regularisation, one after the other, each judged by its loss on the validation
    rows, until ``patience`` in a row are no better; the best one is kept.  Returns it and the history (run, epoch,
    val_loss), which :func:`aspectflow.operators.history.early_stop` reads to the same end."""
    best, least, streak, rows = None, float("inf"), 0, []
    for i, reg in enumerate(reg_params, 1):
        model = train_heads(train, vocab, aspects, reg_param=reg, **options)
        loss = validation_loss(model, val, options.get("text_col", "ReviewText"), options.get("cleaned", False))
        rows.append(("heads", i, loss))
        if loss < least:
            best, least, streak = model, loss, 0
        else:
            streak += 1
        if streak >= patience:
            break
    return best, train.sparkSession.createDataFrame(rows, "run string, epoch int, val_loss double")


def training_history(model: AspectModel) -> DataFrame:
    """Objective per L-BFGS iteration and head, in the (run, epoch, loss)
    shape the early-stop operator reads (bounded by maxIter per head)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = [(a, i + 1, float(v)) for a in model.aspects
            for i, v in enumerate(model.head(a).summary.objectiveHistory)]
    return spark.createDataFrame(rows, "run string, epoch int, val_loss double")


def score_adhoc(spark, texts: list[str], model: AspectModel) -> DataFrame:
    """ML-7: score a handful of literal texts."""
    df = spark.createDataFrame([(t,) for t in texts], "ReviewText string")
    return score(df, model)


def save_model(model: AspectModel, path: str) -> None:
    """ML-5 artefact: the fitted pipeline plus its own vocabulary, versioned
    together (the reference could pair a model with another vocabulary: Q8)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    meta = spark.createDataFrame([(i, w) for i, w in enumerate(model.words)], "pos int, token string")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/words")
    spark.createDataFrame([(i, a) for i, a in enumerate(model.aspects)], "pos int, aspect string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/aspects")


def load_model(spark, path: str):
    """The model stored at ``path``: a fitted pipeline, or the heads of epoch training."""
    from aspectflow.ml import epochs
    from aspectflow.sources.io import path_exists

    if path_exists(spark, f"{path}/weights"):
        return epochs.load(spark, path)
    pipeline = PipelineModel.load(f"{path}/pipeline")
    words = [r.token for r in spark.read.parquet(f"{path}/words").orderBy("pos").collect()]
    aspects = [r.aspect for r in spark.read.parquet(f"{path}/aspects").orderBy("pos").collect()]
    return AspectModel(pipeline, aspects, words)
