"""Most frequent tokens from mergeable summaries (AGG-1, TOP-1, TOP-2).

Each task keeps a Misra-Gries summary: at most ``counters`` tokens with counts that are too low by at most the task's
error.  Summaries add up: with the errors' sum E, a token's count lies between its summed counter and that plus E, and a
token in no summary occurs E times at most.  If E lies below the k-th largest summed counter, only tokens whose upper
bound reaches that can be among the first k; these candidates alone are counted exactly, with their first place, in a
second pass that ships a row per candidate and task.  If the bound doesn't close, all tokens are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.batches import pieces
from aspectflow.operators import vocab as V
from aspectflow.session import cut_lineage_columnar

COUNTERS = 10_000
HELD = 500                  # times as many counted tokens as counters that a task holds before they go into its summary
CANDIDATES = 1_000_000      # rows of candidates that are sent to all tasks; more are counted by the exact path


def _tokens(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(tokens, row of each) of cleaned texts."""
    import pyarrow.compute as pc

    lists = pc.split_pattern(text, " ")
    flat = pc.list_flatten(lists)
    keep = pc.not_equal(flat, "")
    return pc.filter(flat, keep), pc.filter(pc.list_parent_indices(lists), keep)


def _reduced(counts: dict[str, int], counters: int) -> int:
    """Cut a summary to ``counters`` tokens in place; the amount taken from every counter."""
    if len(counts) <= counters:
        return 0
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - counters - 1)[len(counts) - counters - 1])
    for token, n in list(counts.items()):
        if n > off:
            counts[token] = n - off
        else:
            del counts[token]
    return off


def _add(counts: dict[str, int], held: list[pa.Table]) -> None:
    """Add the tables (token, n) to a summary."""
    if held:
        found = pa.concat_tables(held).group_by("token").aggregate([("n", "sum")])
        for token, n in zip(found["token"].to_pylist(), found["n_sum"].to_pylist()):
            counts[token] = counts.get(token, 0) + n


def summaries(clean_docs: DataFrame, counters: int = COUNTERS, text_col: str = "clean_text") -> DataFrame:
    """(token, low, error): every task's counters, and its error in a row with a null token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counts: dict[str, int] = {}
        error = 0
        for batch in batches:
            held: list[pa.Table] = []
            for piece in pieces(batch, "text"):
                found = pc.value_counts(_tokens(piece["text"])[0])
                held.append(pa.table({"token": found.field("values"), "n": found.field("counts")}))
                if sum(t.num_rows for t in held) > HELD * counters:
                    _add(counts, held)
                    held = []
                    error += _reduced(counts, counters)
            _add(counts, held)
            error += _reduced(counts, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counts, None], pa.string()), pa.array([*counts.values(), 0], pa.int64()),
             pa.array([0] * len(counts) + [error], pa.int64())], names=["token", "low", "error"])

    return clean_docs.select(F.col(text_col).alias("text")).mapInArrow(run, "token string, low long, error long")


def candidates(clean_docs: DataFrame, k: int, counters: int = COUNTERS, text_col: str = "clean_text") -> DataFrame | None:
    """The tokens (token, low) that can be among the ``k`` most frequent, ties included; None if that isn't proven."""
    merged = cut_lineage_columnar(summaries(clean_docs, counters, text_col).groupBy("token").agg(
        F.sum("low").alias("low"), F.sum("error").alias("error")), "heavy_summaries")
    error = merged.where("token is null").agg(F.sum("error")).first()[0] or 0
    counted = merged.where("token is not null")
    best = counted.orderBy(F.desc("low")).limit(k).agg(F.min("low").alias("least"), F.count("*").alias("n")).first()
    if error and (best["n"] < k or error >= best["least"]):
        return None
    least = best["least"] if best["n"] == k else 0
    return counted.where(F.col("low") + error >= least).select("token", "low")


def counted(clean_docs: DataFrame, chosen: list[str], id_col: str = "doc_id", text_col: str = "clean_text") -> DataFrame:
    """(token, cnt, first) of the tokens ``chosen`` alone; tasks ship a row per chosen token they hold."""
    sent = clean_docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        words = pa.array(sent.value, pa.string())
        total = np.zeros(len(words), np.int64)
        first: dict[int, tuple] = {}
        for batch in (piece for b in batches for piece in pieces(b, "text")):
            tokens, owner = _tokens(batch["text"])
            index = pc.index_in(tokens, value_set=words)
            known = np.flatnonzero(np.asarray(index.is_valid()))
            at = np.asarray(index.take(pa.array(known)), dtype=np.int64)
            total += np.bincount(at, minlength=len(words))
            owner = np.asarray(owner, dtype=np.int64)
            starts = np.searchsorted(owner, owner, side="left")          # a row's first token
            ids = batch["id"].to_pylist()
            # the first place of a token in each row that holds it, then the smallest (id, place)
            pairs, place = np.unique(at * (batch.num_rows + 1) + owner[known], return_index=True)
            for word, row, p in zip(pairs // (batch.num_rows + 1), pairs % (batch.num_rows + 1), place):
                here = (ids[row] is None, ids[row] if ids[row] is not None else 0, int(known[p] - starts[known[p]]))
                if int(word) not in first or here < first[int(word)]:
                    first[int(word)] = here
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(held)), pa.array(total[held]),
             pa.array([None if first[w][0] else first[w][1] for w in held.tolist()], pa.int64()),
             pa.array([first[w][2] for w in held.tolist()], pa.int32())], names=["token", "cnt", "doc", "pos"])

    parts = clean_docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "token string, cnt long, doc long, pos int")
    # a null id is a first place only for tokens that occur under no other
    least = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "pos"))
    return (parts.groupBy("token").agg(F.sum("cnt").alias("cnt"), least.alias("_f"))
            .select("token", "cnt", F.struct("_f.doc", "_f.pos").alias("first")))


def top_of_texts(clean_docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "clean_text",
                 counters: int = COUNTERS) -> DataFrame:
    """TOP-1/2: the ``k`` most frequent tokens (token, cnt, first, rank), ties by first occurrence; the same rows as
    :func:`aspectflow.operators.vocab.top_of_texts`, which takes over where the summaries prove nothing.  ``id_col``
    holds integers; ``clean_docs`` is read twice: pass a stored table."""
    found = candidates(clean_docs, k, counters, text_col)
    words = [] if found is None else [r["token"] for r in found.limit(CANDIDATES + 1).collect()]
    if found is None or len(words) > CANDIDATES:
        return V.top_of_texts(clean_docs, k, id_col, text_col)
    return V.top_tokens(counted(clean_docs, words, id_col, text_col), k)
