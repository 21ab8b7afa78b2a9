"""Ranked lexical search: term-at-a-time with limited accumulators.

Documents are reduced to postings of the queries' terms.  A query's terms are taken rarest first; every document of a
term gets an accumulator until what all remaining terms can add at most lies below the k-th best partial score.  From
then on no new document can reach the result, and the remaining terms update the existing accumulators only, exactly.
Postings are processed in bounded blocks of documents; a task carries its k best over its blocks, and the tasks'
results are merged.  Statistics (documents, lengths, document frequencies, largest impacts) cover all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.llm.shingles import text_batches
from aspectflow.llm.stored import stored

TOP = 10
SLICE_BYTES = 8 << 20        # text of the queries that are answered together; more queries take more passes
BLOCK_POSTINGS = 1 << 20
MERGE_SALTS = 64

# UTF-8 bytes of a character beyond ASCII all lie above 0x7F, so terms of bytes are terms of characters
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

POSTINGS = "row long, doc_id long, n long, term array<int>, tf array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order, A-Z in lower case; null has none."""
    return TERM.findall((text or "").encode().lower())


def query_terms(queries: DataFrame, key: str) -> DataFrame:
    """(key, terms): the distinct terms of each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            terms = [sorted(set(terms_of(t))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(terms, pa.list_(pa.binary()))], names=["key", "terms"])

    return queries.select(F.col(key).cast("long").alias("key"), "text").mapInArrow(run, "key long, terms array<binary>")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(row, doc_id, n, term, tf) of every document with a term: its number of terms, and which of ``vocabulary`` it
    holds how often.  ``row`` tells rows apart once the result is stored."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, row = sent.value, TaskContext.get().partitionId() << 33
        for batch in text_batches(batches):
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = terms_of(text)
                if words:
                    held = Counter(map(number.get, words))
                    held.pop(None, None)
                    for column, value in zip(out, (row, doc_id, len(words), list(held), list(held.values()))):
                        column.append(value)
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=["row", "doc_id", "n", "term", "tf"])

    return docs.select("doc_id", "text").mapInArrow(run, POSTINGS)


def impact(tf: Column, n: Column, documents: int, length: int) -> Column:
    """What one posting counts before the term's weight, in 64-bit integers."""
    long = lambda v: F.lit(v).cast("long")
    m = long(10) + F.call_function("div", long(90) * n * long(documents), long(length))
    return F.call_function("div", long(1_000_000_000) * tf, long(1000) * tf + long(8) * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block:
    """Postings of a bounded number of documents, by term."""

    def __init__(self, row: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray, n: np.ndarray, held: np.ndarray,
                 term: np.ndarray, tf: np.ndarray, terms: int, documents: int, length: int):
        self.row, self.doc_id, self.no_id = row, doc_id, no_id
        m = 10 + (90 * n * documents) // length
        owner = np.repeat(np.arange(len(row)), held)
        order = np.argsort(term, kind="stable")
        self.docs = owner[order]
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=terms))])
        self.score = np.zeros(len(row), np.int64)

    def best(self, terms: list[tuple[int, int]], rest: list[int], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of this block that may be among the k best; scores below ``bar`` need not come.

        ``terms`` lists (term, weight) rarest first, ``rest[i]`` bounds what terms i and later add to any document.
        """
        score, peak, created = self.score, 0, None
        for i, (term, w) in enumerate(terms):
            a, b = self.start[term], self.start[term + 1]
            if created is None and rest[i] < peak:               # is the k-th partial score beyond reach?
                partial = score[score > 0]
                if len(partial) >= k:
                    bar = max(bar, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            if created is None and rest[i] < bar:
                created = np.flatnonzero(score)
            if a == b:
                continue
            docs, gain = self.docs[a:b], w * self.impact[a:b]
            if created is None:
                score[docs] += gain
                peak = max(peak, int(score[docs].max()))
            elif len(created) < len(docs):
                at = np.minimum(np.searchsorted(docs, created), len(docs) - 1)
                same = docs[at] == created
                score[created[same]] += gain[at[same]]
            else:
                known = score[docs] > 0
                score[docs[known]] += gain[known]
        if created is None:
            created = np.flatnonzero(score)
        scores = score[created]
        score[created] = 0
        if len(scores) > k:
            bar = max(bar, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        reach = scores >= max(bar, 1)
        return created[reach], scores[reach]


def _k_best(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The first k of (score, no_id, doc_id, row) by falling score, then ascending doc_id (null last), then row."""
    order = np.lexsort((found[3], found[2], found[1], -found[0]))[:k]
    return tuple(f[order] for f in found)


def _ranked(rows: DataFrame, queries: list[list[tuple[int, int]]], bounds: list[list[int]], terms: int, documents: int,
            length: int, top: int, block_postings: int) -> DataFrame:
    """(query, doc_id, score, row): every task's best for every query."""
    sent = rows.sparkSession.sparkContext.broadcast((queries, bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, bounds = sent.value
        best: dict[int, tuple[np.ndarray, ...]] = {}
        held: list[pa.RecordBatch] = []

        def close() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            term, tf = t["term"].combine_chunks(), t["tf"].combine_chunks()
            doc_id = t["doc_id"].combine_chunks()
            block = Block(np.asarray(t["row"]), np.asarray(doc_id.fill_null(0)), np.asarray(doc_id.is_null()), np.asarray(t["n"]),
                          np.diff(np.asarray(term.offsets)), np.asarray(term.flatten()), np.asarray(tf.flatten()),
                          terms, documents, length)
            for q, (wanted, rest) in enumerate(zip(queries, bounds)):
                old = best.get(q)
                bar = int(old[0][-1]) if old is not None and len(old[0]) == top else 0
                docs, scores = block.best(wanted, rest, top, bar)
                if len(docs):
                    new = (scores, block.no_id[docs], block.doc_id[docs], block.row[docs])
                    best[q] = _k_best(new if old is None else tuple(np.concatenate(p) for p in zip(old, new)), top)

        size = 0
        for batch in batches:
            # a batch may hold more postings than a block
            upto = np.asarray(batch["term"].offsets, dtype=np.int64)
            start = 0
            for i in range(batch.num_rows):
                if size + upto[i + 1] - upto[start] >= block_postings:
                    held.append(batch.slice(start, i + 1 - start))
                    close()
                    start, size = i + 1, 0
            if start < batch.num_rows:
                held.append(batch.slice(start))
                size += int(upto[-1] - upto[start])
        if held:
            close()
        for q, (scores, no_id, doc_id, row) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), q), pa.int32()), pa.array(doc_id, pa.int64(), mask=no_id), pa.array(scores), pa.array(row)],
                names=["query", "doc_id", "score", "row"])

    return rows.mapInArrow(run, "query int, doc_id long, score long, row long")


def _slice(docs: DataFrame, queries: list[tuple[int | None, list[bytes]]], key: str, top: int, block_postings: int) -> DataFrame:
    """The result for a bounded list of queries."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in queries for t in terms}))}
    rows = stored(postings(docs, vocabulary), "lexical_postings")
    total = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    documents, length = total["documents"], total["length"] or 1
    each = rows.select("n", F.explode(F.arrays_zip("term", "tf")).alias("p")).select("n", "p.term", "p.tf")
    facts = {r["term"]: (r["df"], r["top"]) for r in
             each.groupBy("term").agg(F.count("*").alias("df"),
                                      F.max(impact(F.col("tf"), F.col("n"), documents, length)).alias("top")).collect()}
    wanted, bounds = [], []
    for _, terms in queries:
        numbers = sorted((vocabulary[t] for t in terms if vocabulary[t] in facts), key=lambda t: (facts[t][0], t))
        weights = [(t, weight(facts[t][0], documents)) for t in numbers]
        most = [w * facts[t][1] for t, w in weights]
        wanted.append(weights)
        bounds.append([sum(most[i:]) for i in range(len(most))])
    found = _ranked(rows, wanted, bounds, len(vocabulary), documents, length, top, block_postings)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "row"]
    # the tasks' results meet in salted groups first, so that no query's results all meet in one task at once
    salted = Window.partitionBy("query", "salt").orderBy(*order)
    first = (found.withColumn("salt", F.pmod(F.shiftright("row", 33), F.lit(MERGE_SALTS)))
             .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top).drop("rank", "salt"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    keys = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(queries)], f"query int, `{key}` long")
    return ranked.join(F.broadcast(keys), "query").select(key, F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, key: str = "item_id", top: int = TOP, slice_bytes: int = SLICE_BYTES,
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(key, rank, doc_id, score): the ``top`` documents (doc_id, text) with a score above 0 for each query (key, text).

    Equal scores go by ascending doc_id, null last.  Every row is a document of its own, so copies with one id take a
    rank each; every query row is a query of its own.  Null text has no terms: such documents do not count, such
    queries have no result.  Empty tables give an empty result; other columns are not looked at.  Texts are read
    whole.  Queries beyond ``slice_bytes`` of text are answered in slices, each with a pass over the documents.
    """
    spark = docs.sparkSession
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // slice_bytes)
    dealt = query_terms(queries, key)
    parts = []
    for s in range(slices):
        part = dealt if slices == 1 else dealt.where(F.pmod(F.xxhash64("key", F.array_join(
            F.transform("terms", F.hex), " ")), F.lit(slices)) == s)
        some = [(r["key"], [bytes(t) for t in r["terms"]]) for r in part.where(F.size("terms") > 0).collect()]
        if some:
            parts.append(_slice(docs, some, key, top, block_postings))
    if not parts:
        return spark.createDataFrame([], f"`{key}` long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
