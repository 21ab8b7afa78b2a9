"""Registered model queries.

Learned weights have no SQL form; what must hold of any of them has: how many rows are
trained on, held out and scored, that both scoring paths agree, and that metrics are
metrics.  Scores themselves are compared for a head whose integer weights follow from the
vocabulary ids, in SQL, natively and through the Arrow UDF.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.ml import epochs as E
from aspectflow.ml import heads as H
from aspectflow.operators import history
from aspectflow.operators import vocab as V
from aspectflow.plans.tables import METRIC_ASPECTS, load
from aspectflow.schemas import LABEL_NAMES, MAX_VOCAB, NUM_CLASSES
from aspectflow.session import cut_lineage_columnar, shared_path
from aspectflow.sources.messages import review_messages
from aspectflow.streaming.pipelines import drain, replay_source
from aspectflow.streaming.reviews import run_reviews_stream

FOLDS = 5
SOURCE_BYTES = 32 << 20         # of texts in a file of the replayed reviews


def _holdout() -> F.Column:
    """One in five documents, by a hash of its id that SQL has too, is never trained on."""
    return F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % FOLDS == 0


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """The texts over as many tasks as a shuffle has (the table may be one row group)."""
    return load(spark, d, "documents", partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stored_clean_docs(spark: SparkSession, d: str) -> DataFrame:
    return cut_lineage_columnar(V.cleaned(_documents(spark, d), keep=["doc_id"]), "clean_docs")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with cleaned text, stored once as columns."""
    docs = _documents(spark, d).select("doc_id", "text")
    lab = load(spark, d, "labels").select("doc_id", *[(F.col(a) + 1).cast("int").alias(a) for a in METRIC_ASPECTS])
    clean = V.cleaned(docs.join(lab, "doc_id"), "text", keep=["doc_id", *METRIC_ASPECTS])
    return cut_lineage_columnar(clean.withColumn("held_out", _holdout()), "labelled")


def _fitted(labelled: DataFrame, aspects=METRIC_ASPECTS) -> H.AspectModel:
    train = labelled.where("not held_out")
    return H.train_heads(train, V.build_vocab(train, MAX_VOCAB), aspects, text_col="clean_text", cleaned=True,
                         max_iter=20, partitions=8)


def q_train_score(spark: SparkSession, d: str) -> DataFrame:
    """ML-1 + ML-2 + UDF-1/3: train outside the hold-out, score every document natively and
    through the UDF; the two must agree."""
    labelled = _labelled(spark, d)
    model = _fitted(labelled)
    docs = _stored_clean_docs(spark, d)
    native = H.score(docs, model, text_col="clean_text", keep=["doc_id", "clean_text"], cleaned=True)
    by_udf = H.scoring_udf(model)(F.coalesce("clean_text", F.lit("")))
    differ = sum([F.col(a).eqNullSafe(F.get("_udf", i)).cast("int") for i, a in enumerate(METRIC_ASPECTS)], F.lit(0))
    checked = native.withColumn("_udf", by_udf).agg(
        F.count("*").alias("n_scored"), F.count_if(differ != len(METRIC_ASPECTS)).alias("n_differ"))
    sizes = labelled.agg(F.count_if(~F.col("held_out")).alias("n_train"), F.count_if("held_out").alias("n_held_out"))
    return checked.crossJoin(sizes)          # one row each


def q_evaluate_model(spark: SparkSession, d: str) -> DataFrame:
    """ML-4: metrics of the trained heads on the hold-out alone."""
    labelled = _labelled(spark, d)
    held = labelled.where("held_out")
    m = H.evaluate(_fitted(labelled), held, "doc_id", text_col="clean_text", cleaned=True)
    ok = [F.col(c).between(0.0, 1.0).alias(f"{c}_ok") for c in ("macro_f1", "balanced_acc")]
    return m.select(*ok).crossJoin(held.agg(F.count("*").alias("n_held_out")))


def q_select_by_validation(spark: SparkSession, d: str) -> DataFrame:
    """ML-3: candidates judged on the hold-out; the early-stop operator and the loop keep the same one."""
    labelled = _labelled(spark, d)
    train = labelled.where("not held_out")
    _, losses = H.train_with_validation(train, labelled.where("held_out"), V.build_vocab(train, MAX_VOCAB), METRIC_ASPECTS,
                                        reg_params=(1.0, 0.1, 0.01), patience=3, text_col="clean_text", cleaned=True,
                                        max_iter=10, partitions=8)
    kept = history.early_stop(losses, 3)
    least = losses.agg(F.min("val_loss").alias("least"), F.count("*").alias("n_candidates"))
    return kept.crossJoin(least).select("n_candidates", (F.col("best_loss") == F.col("least")).alias("best_is_least"),
                                        F.col("least").between(0.0, 10.0).alias("loss_ok"))


def q_stream_scored(spark: SparkSession, d: str) -> DataFrame:
    """ML-2 in the review stream: every review of three micro-batches scored by the trained heads, as in one batch."""
    heads = {"quality": "Quality", "toxic": "Others"}          # two of the stored aspects; the rest are NONE
    model = _fitted(_labelled(spark, d).withColumnsRenamed(heads), list(heads.values()))
    root = shared_path(spark, "streams", "scored", unique=True)
    docs = load(spark, d, "documents").select("doc_id", "text")
    # three micro-batches of two files each, of more files where one would hold over SOURCE_BYTES
    files = max(2, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (3 * SOURCE_BYTES)))
    review_messages(docs, text_col="text", keep=["doc_id"]).repartition(3 * files).write.parquet(f"{root}/source")
    messages = replay_source(spark, f"{root}/source", spark.read.parquet(f"{root}/source").schema, max_files_per_trigger=files)
    drain(run_reviews_stream(messages, H.stream_scorer(model), f"{root}/table", f"{root}/checkpoint", {"availableNow": True},
                             keep=["doc_id"]))
    stored = spark.read.parquet(f"{root}/table")
    batch = H.score(docs.withColumnRenamed("text", "ReviewText"), model, keep=["doc_id"])
    same = stored.join(batch.select("doc_id", *[F.col(a).alias(f"_{a}") for a in model.aspects]), "doc_id")
    wrong = sum([(F.col(a) != F.col(f"_{a}")).cast("int") for a in model.aspects], F.lit(0))
    return same.agg(F.count("*").alias("n_rows"), F.count_if(wrong > 0).alias("n_differ"),
                    F.count_distinct("batch_id").alias("n_batches"))


def weight(word_id, head: int, label: int):
    """Integer weight of a vocabulary id for one head and class, -5 to 5."""
    return (word_id * (7 * head + 3 * label + 1)) % 11 - 5


def q_score_udf(spark: SparkSession, d: str) -> DataFrame:
    """UDF-1/3: heads with integer weights from the vocabulary ids, scored by the Arrow UDF."""
    docs = _stored_clean_docs(spark, d)
    words = H.vocab_words(V.build_vocab(docs, MAX_VOCAB))
    ids = np.arange(len(words), dtype=np.int64) + 2
    w = np.array([[weight(ids, h, c) for c in range(NUM_CLASSES)] for h in range(len(METRIC_ASPECTS))], dtype=float)
    labels = H.linear_udf(words, w, np.zeros(w.shape[:2]))(F.coalesce("clean_text", F.lit("")))
    return docs.select("doc_id", labels.alias("_l")).select("doc_id", *[F.get("_l", i).alias(a) for i, a in enumerate(METRIC_ASPECTS)])


def q_score_native(spark: SparkSession, d: str) -> DataFrame:
    """The same heads in native expressions: ids in a row, one sum per head and class, first largest."""
    docs = _stored_clean_docs(spark, d)
    enc = V.encode(docs, V.build_vocab(docs, MAX_VOCAB)).select("doc_id", F.filter("ids", lambda x: x >= 2).alias("ids"))

    def total(head: int, label: int) -> F.Column:
        return F.aggregate("ids", F.lit(0).cast("long"), lambda s, x: s + weight(x.cast("long"), head, label))

    out = []
    for h, a in enumerate(METRIC_ASPECTS):
        sums = F.array(*[total(h, c) for c in range(NUM_CLASSES)])
        names = F.array(*[F.lit(n) for n in LABEL_NAMES])
        out.append(F.get(names, (F.array_position(sums, F.array_max(sums)) - 1).cast("int")).alias(a))
    return enc.select("doc_id", *out)


EPOCH_RATE = 20.0


def _integer_heads(words: list[str]) -> E.LinearHeads:
    """Heads whose weights are the integers of :func:`weight`."""
    heads = E.LinearHeads.zeros(words, METRIC_ASPECTS)
    ids = np.arange(len(words), dtype=np.int64) + 2
    for h in range(len(METRIC_ASPECTS)):
        for c in range(NUM_CLASSES):
            heads.weights[h, c, 2:] = weight(ids, h, c)
    return heads


def q_epoch_losses(spark: SparkSession, d: str) -> DataFrame:
    """ML-1, AGG-12: two epochs of plain gradient steps from integer heads, with the losses of each."""
    labelled, vocab = _labelled(spark, d), cut_lineage_columnar(V.build_vocab(_stored_clean_docs(spark, d), MAX_VOCAB), "vocab")
    _, losses = E.train_epochs(labelled.where("not held_out"), labelled.where("held_out"), vocab, METRIC_ASPECTS, "doc_id", epochs=2,
                               rate=EPOCH_RATE, adam=False, start=_integer_heads(H.vocab_words(vocab)))
    return losses.select("epoch", F.round("train_loss", 8).alias("train_loss"), F.round("val_loss", 8).alias("val_loss"))


def q_epoch_training(spark: SparkSession, d: str) -> DataFrame:
    """ML-1, ML-3, WIN-2: a whole run with early stop; the early-stop operator reads the same end from its history."""
    labelled = _labelled(spark, d)
    train, held = labelled.where("not held_out"), labelled.where("held_out")
    _, losses = E.train_epochs(train, held, V.build_vocab(train, MAX_VOCAB), METRIC_ASPECTS, "doc_id", epochs=12, patience=3,
                               evaluate_every=4)
    stop = history.early_stop(losses.select("run", "epoch", "val_loss"), 3).first()
    chance = F.lit(float(np.log(NUM_CLASSES)))
    return losses.agg(
        F.round(F.min_by("train_loss", "epoch"), 8).alias("first_loss"),
        (F.min("val_loss") < chance).alias("learns"), (F.min("val_loss") == F.lit(stop["best_loss"])).alias("best_is_least"),
        (F.max("epoch") == F.lit(stop["stop_epoch"] or 12)).alias("ends_at_stop"),
        F.bool_and(F.col("macro_f1").isNotNull() == (F.col("epoch") % 4 == 0)).alias("judged_every_fourth"))


def q_holdout_confusion(spark: SparkSession, d: str) -> DataFrame:
    """ML-4, AGG-8: truth and prediction of integer heads, stored and loaded again, on the hold-out alone."""
    labelled, vocab = _labelled(spark, d), cut_lineage_columnar(V.build_vocab(_stored_clean_docs(spark, d), MAX_VOCAB), "vocab")
    path = shared_path(spark, "models", unique=True)
    E.save(_integer_heads(H.vocab_words(vocab)), spark, path)
    rows, _ = E.prepared(labelled.where("held_out"), vocab, METRIC_ASPECTS, "doc_id")
    return E.judged(rows, H.load_model(spark, path))[1]


ML_QUERIES = {"epoch_losses": q_epoch_losses, "epoch_training": q_epoch_training, "holdout_confusion": q_holdout_confusion,
              "train_score": q_train_score, "score_udf": q_score_udf, "score_native": q_score_native,
              "evaluate_model": q_evaluate_model, "select_by_validation": q_select_by_validation,
              "stream_scored": q_stream_scored}


def ml_oracle_sql(vocab_cte: str) -> dict[str, str]:
    """``vocab_cte`` defines ``tok`` (doc_id, pos, token) and ``vocab`` (token, id)."""
    sums = [f"sum(coalesce((v.id * {7 * h + 3 * c + 1}) % 11 - 5, 0)) AS s{h}{c}"
            for h in range(len(METRIC_ASPECTS)) for c in range(NUM_CLASSES)]
    names = "[" + ", ".join(f"'{n}'" for n in LABEL_NAMES) + "]"
    best = []
    for h, a in enumerate(METRIC_ASPECTS):
        scores = "[" + ", ".join(f"coalesce(hs.s{h}{c}, 0)" for c in range(NUM_CLASSES)) + "]"
        best.append(f"{names}[list_position({scores}, list_max({scores}))] AS {a}")
    heads = (vocab_cte + f", hs AS (SELECT tok.doc_id, {', '.join(sums)} FROM tok LEFT JOIN vocab v "
             "ON tok.token = v.token AND v.id >= 2 GROUP BY tok.doc_id) "
             f"SELECT d.doc_id, {', '.join(best)} FROM documents d LEFT JOIN hs ON d.doc_id = hs.doc_id")
    aspect = "CASE h " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(METRIC_ASPECTS)) + " END"
    truth = "CASE hc.h " + " ".join(f"WHEN {i} THEN y{i}" for i in range(len(METRIC_ASPECTS))) + " END"
    ys = ", ".join(f"l.{a} + 1 AS y{i}" for i, a in enumerate(METRIC_ASPECTS))
    usable = " AND ".join(f"l.{a} IS NOT NULL" for a in METRIC_ASPECTS)
    base = (vocab_cte + f", lab AS (SELECT d.doc_id, {ys}, ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT % {FOLDS} = 0 AS held "
            f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {usable}), "
            "feats AS (SELECT tok.doc_id, v.id, count(*) AS cnt FROM tok JOIN vocab v ON tok.token = v.token AND v.id >= 2 "
            "SEMI JOIN lab ON tok.doc_id = lab.doc_id GROUP BY ALL), "
            "numbered AS (SELECT lab.*, (row_number() OVER (PARTITION BY held ORDER BY doc_id) - 1) // 64 AS batch FROM lab), "
            "rws AS (SELECT n.*, greatest(coalesce((SELECT sum(cnt) FROM feats f WHERE f.doc_id = n.doc_id), 0), 1)::DOUBLE AS size, "
            f"1.0::DOUBLE / (count(*) OVER (PARTITION BY held, batch) * {len(METRIC_ASPECTS)} "
            "* ((SELECT max(batch) + 1 FROM numbered m WHERE m.held = n.held))) AS wgt FROM numbered n), "
            f"hc AS (SELECT h, c FROM range({len(METRIC_ASPECTS)}) a(h), range({NUM_CLASSES}) b(c)), "
            "w0 AS MATERIALIZED (SELECT v.id, h, c, ((v.id * (7 * h + 3 * c + 1)) % 11 - 5)::DOUBLE AS w FROM vocab v, hc WHERE v.id >= 2), "
            "b0 AS MATERIALIZED (SELECT h, c, 0.0::DOUBLE AS b FROM hc)")

    def forward(k: int) -> str:
        return (f", z{k} AS MATERIALIZED (SELECT r.doc_id, r.held, r.wgt, r.size, hc.h, hc.c, {truth} AS y, coalesce(s.s, 0) / r.size + b.b AS z "
                f"FROM rws r CROSS JOIN hc JOIN b{k} b ON b.h = hc.h AND b.c = hc.c LEFT JOIN (SELECT f.doc_id, w.h, w.c, sum(f.cnt * w.w) AS s "
                f"FROM feats f JOIN w{k} w ON f.id = w.id GROUP BY ALL) s ON s.doc_id = r.doc_id AND s.h = hc.h AND s.c = hc.c), "
                f"e{k} AS (SELECT *, max(z) OVER (PARTITION BY doc_id, h) AS m FROM z{k}), "
                f"p{k} AS MATERIALIZED (SELECT *, sum(exp(z - m)) OVER (PARTITION BY doc_id, h) AS total, exp(z - m) AS ez FROM e{k}), "
                f"l{k} AS (SELECT held, sum(wgt * (ln(total) + m - z)) AS loss FROM p{k} WHERE c = y GROUP BY held)")

    def stepped(k: int) -> str:
        err = "wgt * (ez / total - CASE WHEN c = y THEN 1 ELSE 0 END)"
        return (f", gb{k} AS (SELECT h, c, sum({err}) AS g FROM p{k} WHERE NOT held GROUP BY ALL), "
                f"gw{k} AS (SELECT f.id, p.h, p.c, sum({err} * f.cnt / size) AS g FROM p{k} p JOIN feats f ON f.doc_id = p.doc_id "
                "WHERE NOT held GROUP BY ALL), "
                f"b{k + 1} AS MATERIALIZED (SELECT h, c, b - {EPOCH_RATE} * g AS b FROM b{k} JOIN gb{k} USING (h, c)), "
                f"w{k + 1} AS MATERIALIZED (SELECT w.id, w.h, w.c, w.w - {EPOCH_RATE} * coalesce(g.g, 0) AS w FROM w{k} w LEFT JOIN gw{k} g "
                "ON g.id = w.id AND g.h = w.h AND g.c = w.c)")

    epoch_losses = (base + forward(0) + stepped(0) + forward(1) + stepped(1) + forward(2) + " " + " UNION ALL ".join(
        f"SELECT {k + 1}::INTEGER AS epoch, round((SELECT loss FROM l{k} WHERE NOT held), 8) AS train_loss, "
        f"round((SELECT loss FROM l{k + 1} WHERE held), 8) AS val_loss" for k in range(2)))
    confusion = (base + forward(0) + f" SELECT {aspect} AS aspect, y::INTEGER AS truth, pred::INTEGER AS pred, count(*) AS cnt FROM "
                 "(SELECT doc_id, h, any_value(y) AS y, list_position(list(z ORDER BY c), max(z)) - 1 AS pred FROM z0 WHERE held "
                 "GROUP BY doc_id, h) GROUP BY ALL")
    labelled = ("SELECT d.doc_id, ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT % "
                f"{FOLDS} = 0 AS held_out FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
    return {
        "epoch_losses": epoch_losses, "holdout_confusion": confusion,
        "epoch_training": (f"SELECT round(ln({NUM_CLASSES}), 8) AS first_loss, true AS learns, true AS best_is_least, true AS ends_at_stop, "
                           "true AS judged_every_fourth FROM labels LIMIT 1"),
        "select_by_validation": "SELECT 3::BIGINT AS n_candidates, true AS best_is_least, true AS loss_ok FROM labels LIMIT 1",
        "stream_scored": "SELECT count(*) AS n_rows, 0::BIGINT AS n_differ, 3::BIGINT AS n_batches FROM documents WHERE text IS NOT NULL",
        "score_udf": heads, "score_native": heads,
        "train_score": (f"WITH x AS ({labelled}) SELECT (SELECT count(*) FROM documents) AS n_scored, 0::BIGINT AS n_differ, "
                        "count(*) FILTER (WHERE NOT held_out) AS n_train, count(*) FILTER (WHERE held_out) AS n_held_out FROM x"),
        "evaluate_model": (f"WITH x AS ({labelled}) SELECT true AS macro_f1_ok, true AS balanced_acc_ok, "
                           "count(*) FILTER (WHERE held_out) AS n_held_out FROM x"),
    }
