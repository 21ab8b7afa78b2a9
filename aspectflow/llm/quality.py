"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

Bytes of the UTF-8 text (A-Z in lower case, white space as blanks) are the symbols, so there are no unknown words and
n-grams are exact 64-bit keys.  Trusted text is counted per task and dealt to shards by the three symbols before the last
one: all orders above the third, with their contexts, lie in one shard, which adds the counts up and derives continuation
counts by sorting.  The lower orders have 2^24 keys at most, whatever the corpus, and go to every task.  Documents stay
where they are: a task gathers the distinct n-grams of a chunk of texts and meets the stored shards one after the other,
so no n-gram of a document is shuffled.  A document's perplexity is the mean over all its bytes.  The limit up to which a
document is kept comes from a quantile of those trusted documents of its language that the model has not been trained on.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.batches import give_back, giving_back
from aspectflow.llm.shingles import BATCH_BYTES, text_batches, text_buffer
from aspectflow.llm.stored import stored
from aspectflow.session import arrow_batches

ORDER = 8                   # the most bytes that an exact 64-bit key holds
HIGH = 0.99                 # quantile of the held-back trusted documents' log-perplexity: the limit itself
FOLDS = 5                   # one fold of the trusted texts is kept from training, for the limit
FEWEST = 10                 # a language with fewer texts in that fold takes the limit of all languages together
WIDEN = 4.0                 # that limit lies this many times as far above the median as the quantile: it is other languages' text
TABLE_BYTES = 64 << 20      # a list of ids, or a packed model, up to this size goes to every task
CHUNK_BYTES = 32 << 20      # text that meets the model's files at once; every chunk reads all shards
SHARD_BYTES = 4 << 20       # trusted text a shard
HELD_GRAMS = 1 << 20        # n-grams that a task adds up before it hands them on
PIECE_BYTES = 512 << 10      # text whose n-grams a scoring task has unpacked at once, in some 50 times as many bytes
LOW = 3                     # orders up to this one have 2^24 keys at most and are not sharded


def _symbols() -> np.ndarray:
    table = np.arange(256, dtype=np.int64)
    table[65:91] = table[97:123]
    table[[0, 9, 10, 11, 12, 13]] = 32
    return table


_SYMBOL = _symbols()


def text_grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text and at the blank that closes it, as one number, and text offsets.

    Before a text's start stand zero bytes; a text's own zero bytes count as blanks.
    """
    data, offsets = text_buffer(texts)
    x = _SYMBOL[data]
    code, starts = x.copy(), offsets[:-1]
    for back in range(1, order):
        before = np.empty_like(x)
        before[back:], before[:back] = x[:-back], 0
        edge = (starts[:, None] + np.arange(back)[None, :]).ravel()
        before[edge[edge < len(x)]] = 0
        code |= before << np.int64(8 * back)
    return code, offsets


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes of their bytes; small numbers and small steps between sorted ones take few."""
    planes = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(len(x), 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=8 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view(np.uint64).ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _starts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers starts."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]][:len(x)])


class _Distinct:
    """Sorted distinct numbers of all arrays put in, in one buffer: sorted, rid of repeats and grown in its place."""

    def __init__(self) -> None:
        self.x, self.n = np.empty(2 * HELD_GRAMS, np.uint64), 0

    def add(self, numbers: np.ndarray) -> None:
        if self.n + len(numbers) > len(self.x):
            self._fold()
            size = self.n + len(numbers) + max(HELD_GRAMS, self.n // 2)
            if size > len(self.x):
                self.x.resize(size, refcheck=False)
        self.x[self.n:self.n + len(numbers)] = numbers
        self.n += len(numbers)

    def _fold(self) -> None:
        """Without counts np.unique hashes, which takes many times as long, and it holds copies."""
        self.x[:self.n].sort()
        kept, last = 0, None
        for lo in range(0, self.n, HELD_GRAMS):
            part = self.x[lo:min(lo + HELD_GRAMS, self.n)]
            found = part[np.r_[last is None or part[0] != last, part[1:] != part[:-1]]]
            last = part[-1].copy()
            self.x[kept:kept + len(found)] = found
            kept += len(found)
        self.n = kept

    def taken(self) -> np.ndarray:
        """The numbers; the buffer is given up."""
        self._fold()
        x, n = self.x, self.n
        self.__init__()
        x.resize(n, refcheck=False)
        return x


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all pairs of keys and counts, which are given up, and the sums of their counts."""
    keys, n = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    del order
    first = _starts(keys)
    return keys[first], np.add.reduceat(n, first) if len(keys) else np.empty(0, np.uint64)


def _tails(grams: np.ndarray, order: int) -> np.ndarray:
    return grams & np.uint64((1 << (8 * order)) - 1)


def _shard(grams: np.ndarray, shards: int) -> np.ndarray:
    """By the ``LOW`` symbols before the last one, which an n-gram shares with its tails and contexts of more symbols."""
    out = np.empty(len(grams), np.uint16 if shards <= 1 << 16 else np.int64)
    for lo in range(0, len(grams), HELD_GRAMS):
        mixed = _tails(grams[lo:lo + HELD_GRAMS] >> np.uint64(8), LOW) * np.uint64(0x9E3779B97F4A7C15)
        out[lo:lo + HELD_GRAMS] = (mixed >> np.uint64(32)) % np.uint64(shards)
    return out


def _counted(shards: int):
    """Kernel over texts: (shard, size, keys, n), n-grams and their counts, added up ``HELD_GRAMS`` at a time."""
    names = ["shard", "size", "keys", "n"]

    def rows(grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        at = _shard(grams, shards)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(shards + 1))
        parts = [(s, order[ends[s]:ends[s + 1]]) for s in range(shards) if ends[s] < ends[s + 1]]
        return pa.RecordBatch.from_arrays([
            pa.array([s for s, _ in parts], pa.int32()), pa.array([len(x) for _, x in parts], pa.int64()),
            pa.array([packed(_steps(grams[x])) for _, x in parts], pa.binary()),
            pa.array([packed(n[x]) for _, x in parts], pa.binary())], names=names)

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in text_batches(batches):
            grams, n = np.unique(text_grams(batch["text"])[0].view(np.uint64), return_counts=True)
            held.append((grams, n.astype(np.uint64)))
            if sum(len(g) for g, _ in held) > HELD_GRAMS:
                held = [_added(held)]
                if 2 * len(held[0][0]) > HELD_GRAMS:
                    yield rows(*held.pop())
        if held:
            yield rows(*_added(held))

    return count


def _orders(part: pa.Table) -> pa.Table:
    """A shard's counts added up, and from them continuation counts of the orders below, with their counts of counts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for row in part.to_batches(max_chunksize=1):
        size = row["size"][0].as_py()
        held.append((np.cumsum(unpacked(row["keys"][0].as_py(), size), dtype=np.uint64), unpacked(row["n"][0].as_py(), size)))
        if sum(len(k) for k, _ in held[1:]) > max(HELD_GRAMS, len(held[0][0])):
            held = [_added(held)]
    (keys, n), out = _added(held), []
    for k in range(ORDER, LOW - 1, -1):
        out.append({"shard": part["shard"][0].as_py(), "k": k, "size": len(keys), "keys": packed(_steps(keys)), "n": packed(n),
                    **{f"n{i}": int((n == i).sum()) for i in range(1, 5)}})
        keys, n = np.unique(_tails(keys, k - 1), return_counts=True)
    give_back()
    return pa.Table.from_pylist(out, pa.schema([("shard", pa.int32()), ("k", pa.int32()), ("size", pa.int64()), ("keys", pa.binary()),
                                                ("n", pa.binary()), *[(f"n{i}", pa.int64()) for i in range(1, 5)]]))


MODEL = "shard int, k int, size long, keys binary, n binary, n1 long, n2 long, n3 long, n4 long"


def counted(texts: DataFrame, shards: int) -> DataFrame:
    """(shard, k, size, keys, n, n1 to n4): the packed n-grams of every order from ``LOW`` up in the whole ``text`` of all rows.

    The highest order has counts, lower ones the number of different symbols before.  An n-gram of order ``LOW`` may be
    in several shards and its numbers add up; n1 to n4 count the n-grams of a shard that are seen 1 to 4 times.
    """
    return (texts.select("text").mapInArrow(_counted(shards), "shard int, size long, keys binary, n binary")
            .groupBy("shard").applyInArrow(_orders, MODEL))


def discounts(of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of n-grams seen once, twice and more often, from the counts of counts 1 to 4.

    Where a count of counts is 0 the closed form has no value, and 0.5, 1 and 1.5 stand in.
    """
    n1, n2, n3, n4 = (of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), i + 1 - 0.01) for i, d in enumerate(raw))


def _order_table(keys: np.ndarray, n: np.ndarray, of: tuple[float, float, float]) -> tuple[np.ndarray, ...]:
    """(n-grams, their discounted share, contexts, what each context hands to the order below), n-grams and contexts sorted."""
    discount = np.array([0.0, *of])[np.minimum(n, 3).astype(np.int64)]
    ctx = keys >> np.uint64(8)
    first = _starts(ctx)
    total = np.add.reduceat(n, first).astype(np.float64)
    kept = (n - discount) / np.repeat(total, np.diff(np.r_[first, len(ctx)]))
    return keys, kept, ctx[first], np.add.reduceat(discount, first) / total


def low_orders(model: DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """Tables of the orders up to ``LOW``, whose keys are 2^24 at most."""
    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys = np.cumsum(unpacked(r["keys"], r["size"]), dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(unpacked(r["n"], r["size"]).astype(np.int64))],
                                                 names=["gram", "n"])

    table = (model.where(f"k = {LOW}").select("size", "keys", "n").mapInArrow(plain, "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).orderBy("gram").toArrow())
    keys, n = (table[c].to_numpy().astype(np.uint64) for c in ("gram", "n"))
    out = {}
    for k in range(LOW, 0, -1):
        if len(keys):
            out[k] = _order_table(keys, n, discounts({i: int((n == i).sum()) for i in range(1, 5)}))
        keys, n = np.unique(_tails(keys, k - 1), return_counts=True)
    return out


def _found(sorted_keys: np.ndarray, asked: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, asked), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == asked, values[at], missing)


def probabilities(grams: np.ndarray, tables: dict[int, Callable[[], tuple[np.ndarray, ...]]], order: int = ORDER) -> np.ndarray:
    """Of sorted distinct n-grams: every order interpolated with the next lower one, the lowest with 256 equal symbols.

    An order hands a context that trusted text doesn't hold to the order below.  A table is made when its order's turn
    comes, so that one order's at a time is held.
    """
    if order == 1:
        low = np.full(len(grams), 1 / 256)
    else:
        tails, at = np.unique(_tails(grams, order - 1), return_inverse=True)
        low = probabilities(tails, tables, order - 1)[at]
    if order not in tables:
        return low
    keys, kept, contexts, spared = tables[order]()
    return _found(keys, grams, kept, 0.0) + _found(contexts, grams >> np.uint64(8), spared, 1.0) * low


def _read(path: str) -> Iterator[dict]:
    """The rows of a file of the model, by Arrow's file systems, a shard's worth at a time."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)
    with store.open_input_file(name) as f:
        for batch in pq.ParquetFile(f).iter_batches(ORDER, columns=["shard", "k", "size", "keys", "n"]):
            yield from batch.to_pylist()


def _order_of(row: dict, of: dict[int, tuple[float, float, float]]) -> tuple[np.ndarray, ...]:
    return _order_table(np.cumsum(unpacked(row["keys"], row["size"]), dtype=np.uint64), unpacked(row["n"], row["size"]), of[row["k"]])


def _shard_tables(rows: Iterator[dict], of: dict[int, tuple[float, float, float]]) -> Iterator[tuple[int, dict]]:
    """(shard, makers of its tables of the orders above ``LOW``); a shard's rows stand together."""
    for shard, own in itertools.groupby(rows, lambda r: r["shard"]):
        yield shard, {r["k"]: partial(_order_of, r, of) for r in own if r["k"] > LOW}


def _by_shard(grams: np.ndarray, shards: int) -> Callable[[int], np.ndarray]:
    """Where the n-grams of a shard are, put in order ``HELD_GRAMS`` at a time."""
    order, ends = np.empty(len(grams), np.uint32), []
    for lo in range(0, len(grams), HELD_GRAMS):
        at = _shard(grams[lo:lo + HELD_GRAMS], shards)
        own = np.argsort(at, kind="stable")
        order[lo:lo + HELD_GRAMS] = own + lo
        ends.append(lo + np.searchsorted(at[own], np.arange(shards + 1)))
    return lambda shard: np.concatenate([order[e[shard]:e[shard + 1]] for e in ends])


KEYS = "doc_id long, text_id long, lang string, trusted boolean, calibrating boolean"


def scored(docs: DataFrame, model: DataFrame, shards: int, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, text_id, lang, trusted, calibrating, log_perplexity per symbol) of every document; null for null or empty text.

    ``model`` is a stored table of ``counted``.  Packed in ``table_bytes`` at most, it is sent to all tasks; a larger one is
    read from its files by every chunk of ``CHUNK_BYTES`` of text, a shard at a time.  Both give the same values.
    """
    spark = docs.sparkSession
    sums = model.groupBy("k").agg(*[F.sum(f"n{i}") for i in range(1, 5)], F.sum(F.length("keys") + F.length("n"))).collect()
    of = {r[0]: discounts(dict(enumerate(r[1:5], 1))) for r in sums}
    small = sum(r[5] for r in sums) <= table_bytes
    rows = [r.asDict() for r in model.select("shard", "k", "size", "keys", "n").orderBy("shard").collect()] if small else None
    sent = spark.sparkContext.broadcast((rows, low_orders(model), [] if small else model.inputFiles()))
    chunk_bytes = CHUNK_BYTES // 2 if small else CHUNK_BYTES    # a task that holds the model itself holds less text

    def log_probabilities(grams: np.ndarray) -> np.ndarray:
        rows, low, files = sent.value
        low = {k: partial(lambda table: table, table) for k, table in low.items()}
        asked, logp, missed = _by_shard(grams, shards), np.empty(len(grams)), set(range(shards))

        def answer(shard: int, tables: dict) -> None:
            at = asked(shard)
            logp[at] = np.log(probabilities(grams[at], tables))
            missed.discard(shard)

        for part in (rows,) if rows is not None else map(_read, files):
            for shard, tables in _shard_tables(part, of):
                answer(shard, low | tables)
        for shard in sorted(missed):
            answer(shard, low)
        return logp

    def chunk_scores(chunk: list[pa.RecordBatch], grams: np.ndarray) -> Iterator[pa.RecordBatch]:
        give_back()
        logp = log_probabilities(grams)
        give_back()
        for batch in chunk:
            code, offsets = text_grams(batch["text"])
            distinct, back = np.unique(code.view(np.uint64), return_inverse=True)
            each = logp[np.searchsorted(grams, distinct)][back]
            empty = np.asarray(pc.equal(pc.fill_null(pc.binary_length(batch["text"]), 0), 0))
            values = np.where(empty, np.nan, -np.add.reduceat(each, offsets[:-1]) / np.diff(offsets)) if len(empty) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(values, from_pandas=True)], names=names)

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = [], _Distinct(), 0
        for batch in text_batches(batches, size=PIECE_BYTES):
            code = text_grams(batch["text"])[0]
            chunk.append(batch)
            held.add(code.view(np.uint64))
            size += len(code)
            if size >= chunk_bytes:
                yield from chunk_scores(chunk, held.taken())
                chunk, size = [], 0
        if chunk:
            yield from chunk_scores(chunk, held.taken())

    out_schema = f"{KEYS}, log_perplexity double"
    names = [c.split()[0] for c in out_schema.split(", ")]
    return docs.select("doc_id", "text_id", "lang", "trusted", "calibrating", "text").mapInArrow(score, out_schema)


def limits(scores: DataFrame, high: float = HIGH, fewest: int = FEWEST) -> DataFrame:
    """(lang, highest): the quantile ``high`` of held-back trusted documents' log-perplexities, by language; copies count once.

    A language with fewer than ``fewest`` of them has no quantile of its own; its limit is that of all languages, widened
    by ``WIDEN``.
    """
    held = scores.where("calibrating and log_perplexity is not null").dropDuplicates(["lang", "text_id"])
    quantile = F.percentile_approx("log_perplexity", high, 10_000).alias("q")
    middle = F.percentile_approx("log_perplexity", 0.5, 10_000).alias("m")
    everywhere = (held.dropDuplicates(["text_id"]).agg(quantile, middle, F.count("*").alias("n")).where(F.col("n") >= fewest)
                  .select((F.col("m") + WIDEN * (F.col("q") - F.col("m"))).alias("q_all")))
    per = held.groupBy("lang").agg(quantile, F.count("*").alias("n"))
    own = (scores.select("lang").distinct().withColumnRenamed("lang", "_lang")
           .join(per, F.col("_lang").eqNullSafe(F.col("lang")), "left")
           .join(F.broadcast(everywhere), F.lit(True), "left"))         # one row at most
    return own.select("_lang", F.when(F.col("n") >= fewest, F.col("q")).otherwise(F.col("q_all")).alias("highest"))


def judged(docs: DataFrame, labels: DataFrame, high: float = HIGH, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, text_id, lang, trusted, calibrating, log_perplexity, highest, kept) of every document.

    Trusted text: documents that ``labels`` gives quality 1 and no toxicity.  ``text_id`` is a hash of the text, which
    tells rows with one doc_id apart.  A document is kept if its log-perplexity is not above its language's limit.
    Null or empty text has no perplexity and is not kept.  A language (null is one) with fewer than ``FEWEST`` held-back
    trusted documents is held to the limit of all languages together, widened by ``WIDEN``; with fewer in all there is no limit and all
    texts stay.  Without any trusted text all symbols are equally likely.
    Repeated rows are judged alike.  Extra columns are not looked at.
    """
    trusted = stored(labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
                     .select(F.col("doc_id").alias("_id")).distinct(), "trusted")
    # a small list of ids goes to the texts; beyond that size Spark shuffles both
    ids = F.broadcast(trusted) if trusted.count() * 16 <= table_bytes else trusted
    marked = (docs.select("doc_id", "lang", "text").withColumn("text_id", F.xxhash64("text"))
              .join(ids, F.col("doc_id") == F.col("_id"), "left").withColumn("listed", F.col("_id").isNotNull()).drop("_id"))
    held = F.pmod("text_id", F.lit(FOLDS)) == 0             # by text, so copies are on one side
    marked = (marked.withColumn("trusted", F.col("listed") & ~held).withColumn("calibrating", F.col("listed") & held)
              .drop("listed"))
    texts = marked.where("trusted")
    shards = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES
    with arrow_batches(docs.sparkSession, BATCH_BYTES):     # the kernels cut batches to that size anyway
        model = stored(counted(texts, shards), "kneser_ney")
        scores = stored(scored(marked, model, shards, table_bytes), "perplexities")
    within = F.col("highest").isNull() | (F.col("log_perplexity") <= F.col("highest"))
    # one row per language: sent to the scores while small, so that no task gets all rows of a common language
    per_language = stored(limits(scores, high), "limits")
    if per_language.count() * 64 <= table_bytes:
        per_language = F.broadcast(per_language)
    return (scores.join(per_language, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .withColumn("kept", F.col("log_perplexity").isNotNull() & within).drop("_lang"))
