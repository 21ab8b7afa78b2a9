"""Language identification with error-correcting output codes.

Every learned language has a codeword.  For each of its bits a binary classifier over hashed byte n-grams says on
which side a text lies: a linear model of n-gram log-odds between the languages with bit 1 and those with bit 0, from
counts over the whole training corpus.  Loss-weighted decoding sums, for each codeword, the logistic loss of the bit
margins, weighted by how reliable a bit's classifier is; the nearest codeword wins, and a small gap to the second
marks the text as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from aspectflow.functions.batches import giving_back
from aspectflow.llm.shingles import text_batches, text_buffer

ORDERS = (2, 3)
BUCKET_BITS = 15
SHARPNESS = 12.0          # margin per nat of mean log-odds; at least this sure texts have losses near 0
AMBIGUOUS = 0.6           # a best codeword with a smaller share than this is flagged
CALIBRATION_ROWS = 2000   # rows on which the bits' reliabilities are measured
UNDETERMINED = "und"
ADDED = ("lang_pred", "score", "ambiguous")


def _classes() -> np.ndarray:
    """Bytes to n-gram symbols: letters in lower case, other ASCII as one space, bytes of longer characters as they are."""
    table = np.full(256, 32, np.uint32)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_CLASS = _classes()


def gram_buckets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the bucket of the n-gram at every byte of all texts, and the texts' byte offsets."""
    data, offsets = text_buffer(texts)
    x = _CLASS[data]
    latin = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    x[latin] += 32                                       # capital Latin-1 letters in lower case
    out = []
    for order in ORDERS:
        code = x.copy()
        for i in range(1, order):
            code[:-i] = (code[:-i] << np.uint32(8)) | x[i:]
        code = (code + np.uint32(order)) * np.uint32(0x9E3779B1)
        out.append(((code ^ (code >> np.uint32(13))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64))
    return out, offsets


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """(languages x bits) of +1 and -1: the exhaustive code up to 7 languages, beyond them the best of random codes."""
    if n <= 7:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c] if n > 1 else [(1,)]
        return np.array(columns, dtype=np.int8).T.reshape(n, -1)
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice(np.array([1, -1], np.int8), size=(n, 10 * int(np.ceil(np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        gap = int((code.shape[1] - (code.astype(int) @ code.T.astype(int))[~np.eye(n, dtype=bool)].max()) // 2)
        if gap > far:
            best, far = code, gap
    return best


@dataclass(frozen=True)
class Model:
    """Languages in order, their codewords, n-gram weights (order x bucket x bit) and the bits' reliabilities."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    def margins(self, texts: pa.Array) -> np.ndarray:
        """(texts x bits) margins: sharpened mean log-odds over all n-grams of the whole text."""
        buckets, offsets = gram_buckets(texts)
        total = np.zeros((len(texts), self.code.shape[1]), np.float64)
        for w, b in zip(self.weights, buckets):
            # weights are summed piecewise to bound memory; pieces end where texts end
            for i in range(len(texts)):
                for lo in range(offsets[i], offsets[i + 1], 1 << 16):
                    total[i] += w[b[lo:min(lo + (1 << 16), offsets[i + 1])]].sum(0, dtype=np.float32)
        return SHARPNESS * total / (len(self.weights) * np.maximum(np.diff(offsets), 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest codeword, its share of confidence in 0 to 1); ties go to the first language."""
        loss = np.stack([(np.logaddexp(0, -margins * word) * self.reliability).sum(1) for word in self.code], axis=1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        return loss.argmin(1), 1.0 / share.sum(1)


def fit(docs: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model | None:
    """Learn from the text and lang of every row where both are there; None if no row is.

    N-gram counts cover all rows and are added up per task before the shuffle; what reaches the driver is one number
    per language, order and bucket (bounded by parameters and the number of languages).
    """
    rows = docs.select("text", "lang").where("text is not null and lang is not null")
    size = 1 << BUCKET_BITS

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_batches(batches):
            langs = batch["lang"].to_pylist()
            names = sorted(set(langs))
            buckets, offsets = gram_buckets(batch["text"])
            which = np.repeat(np.array([names.index(x) for x in langs]), np.diff(offsets)) * size
            for o, b in enumerate(buckets):
                found = np.bincount(which + b, minlength=len(names) * size).reshape(len(names), size)
                for name, line in zip(names, found):
                    sums.setdefault(name, np.zeros((len(ORDERS), size), np.int64))[o] += line
        for name, table in sums.items():
            flat = table.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(flat[at])],
                                             names=["lang", "cell", "n"])

    cells = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(cells["lang"].to_pylist()))
    if not names:
        return None
    counts = np.zeros((len(names), len(ORDERS) * size))
    lang_of = {name: i for i, name in enumerate(names)}
    counts[[lang_of[x] for x in cells["lang"].to_pylist()], cells["cell"].to_numpy()] = cells["n"].to_numpy()
    counts = counts.reshape(len(names), len(ORDERS), size)
    p = (counts + 0.1) / (counts + 0.1).sum(2, keepdims=True)
    code = codewords(len(names))
    weights = np.zeros((len(ORDERS), size, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        yes, no = code[:, bit] > 0, code[:, bit] < 0
        if yes.any() and no.any():
            weights[:, :, bit] = np.log(p[yes].mean(0)) - np.log(p[no].mean(0))
    model = Model(tuple(names), code, weights, np.ones(code.shape[1]))
    # reliability: how far a bit's classifier is from guessing, on a bounded sample of the training rows
    sample = rows.orderBy(F.xxhash64("text"), "lang").limit(calibration_rows).repartition(8)

    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            side = model.code[[lang_of[x] for x in batch["lang"].to_pylist()]]
            right = (np.sign(model.margins(batch["text"])) == side).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(right), dtype=np.int32)), pa.array(right.astype(np.int64)),
                                              pa.array(np.full(len(right), len(side), np.int64))], names=["bit", "ok", "n"])

    reliability = np.ones(code.shape[1])
    for bit, ok, n in (sample.mapInArrow(measure, "bit int, ok long, n long").groupBy("bit")
                       .agg(F.sum("ok"), F.sum("n")).collect()):
        reliability[bit] = max(0.05, 2 * ok / n - 1)
    return Model(model.languages, code, weights, reliability)


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; only ``text`` is looked at.

    A text that is null or has no letter is ``und`` with score 0 and ambiguous, and so is every text without a model.
    Input columns of the added names are replaced; rows are neither moved nor merged.
    """
    docs = docs.drop(*ADDED).withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = StructType([f for f in docs.schema if f.name != "__letter"]
                        + [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                           StructField("ambiguous", BooleanType())])

    @giving_back
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            letter = np.asarray(batch["__letter"].to_pylist(), dtype=bool)
            if model is None:
                letter[:] = False
                best, share = np.zeros(len(letter), int), np.zeros(len(letter))
            else:
                best, share = model.decode(model.margins(batch["text"]))
            share = np.where(letter, share, 0.0)
            names = [model.languages[b] if has else UNDETERMINED for b, has in zip(best.tolist(), letter)]
            kept = batch.drop_columns(["__letter"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(names, pa.string()), pa.array(share),
                                              pa.array(share < AMBIGUOUS)], names=[*kept.schema.names, *ADDED])

    return docs.mapInArrow(predict, schema)


def held_out(docs: DataFrame, folds: int = 5):
    """Column: whether the CRC-32 of doc_id as text is divisible by ``folds``; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % folds == 0, F.lit(True))
