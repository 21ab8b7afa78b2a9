"""Best-fit packing with large-item matching.

Documents become pieces of at most one sequence's length.  Pieces above a third of the capacity are large: at most
two of them go into one bin, matched greedily, longest first, each with the longest that still fits.  Smaller pieces
then go, longest first, into the gap that they fill best; only what fits no gap opens a new bin.  Pieces are dealt
to bounded random lots that are packed independently, which costs at most one partly filled bin a lot.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.functions.batches import giving_back
from aspectflow.llm.shingles import text_batches
from aspectflow.llm.stored import stored
from aspectflow.llm.tokens import encoder, vocabulary_path, with_end
from aspectflow.session import arrow_batches

CAPACITY = 2048
END_ID = 0
PIECES_PER_LOT = 20_000
TEXT_BYTES = 512 << 10         # text that a task tokenizes at once, in some 50 times as many bytes; a longer text goes by itself

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long, ids binary"


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; lengths are 1 to ``capacity``; ties go to the earlier piece."""
    order = np.lexsort((np.arange(len(lengths)), -np.asarray(lengths)))
    bins, offsets = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    large = [int(i) for i in order if 3 * lengths[i] > capacity]
    small = [int(i) for i in order if 3 * lengths[i] <= capacity]
    # greedy matching: partners wait by ascending length; the longest opens a bin and takes the longest that fits
    waiting = sorted((int(lengths[i]), -i) for i in large)
    gaps: list[tuple[int, int]] = []          # (free room, bin), ascending
    n = 0
    while waiting:
        length, i = waiting.pop()
        bins[-i], free = n, capacity - length
        at = bisect_left(waiting, (free + 1, -(1 << 62)))
        if at:
            partner, j = waiting.pop(at - 1)
            bins[-j], offsets[-j], free = n, length, free - partner
        if free:
            gaps.append((free, n))
        n += 1
    gaps.sort()
    for i in small:
        length = int(lengths[i])
        at = bisect_left(gaps, (length, -1))
        if at < len(gaps):
            free, b = gaps.pop(at)
        else:
            free, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - free
        if free > length:
            insort(gaps, (free - length, b))
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = True) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of ``capacity``; ``copy`` tells repeated rows of a task apart."""
    path = vocabulary or vocabulary_path()

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(path), 0
        for batch in text_batches(batches, size=TEXT_BYTES):
            out: list[list] = [[] for _ in range(7)]
            ids, lengths = with_end(*enc.encode_all(batch["text"]), end_id)
            data = memoryview(ids).cast("B")
            for doc_id, end, n in zip(batch["doc_id"].to_pylist(), np.cumsum(lengths).tolist(), lengths.tolist()):
                for piece, start in enumerate(range(0, n, capacity)):
                    part = data[4 * (end - n + start):4 * (end - n + min(n, start + capacity))]
                    for column, value in zip(out, (doc_id, row, piece, start, len(part) // 4, zlib.crc32(part),
                                                   part.tobytes() if with_ids else None)):
                        column.append(value)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                      pa.int64(), pa.binary()))],
                names=["doc_id", "copy", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           pieces_per_lot: int = PIECES_PER_LOT) -> DataFrame:
    """Place of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or empty text is the end id alone.  Repeated rows are packed as documents of their own.  An empty table
    gives an empty result.  Other columns of ``docs`` are not looked at.  Full pieces are sequences by themselves.
    """
    spark = docs.sparkSession
    with arrow_batches(spark, TEXT_BYTES):                  # the kernel cuts batches to that size anyway
        cut = stored(pieces(docs, vocabulary, capacity, end_id, with_ids=False).drop("ids"), "pieces")
    lots = max(1, -(-cut.where(F.col("length") < capacity).count() // pieces_per_lot))
    # a piece's lot is a hash of what identifies it, so copies of a document spread over the lots
    dealt = cut.withColumn("lot", F.when(F.col("length") < capacity, F.pmod(
        F.xxhash64("doc_id", "copy", "piece", "ids_crc32"), F.lit(lots))))

    def pack(lot: pa.Table) -> pa.Table:               # Arrow keeps ids exact beside null ones
        lot = lot.sort_by([(c, "ascending") for c in ("doc_id", "copy", "piece", "ids_crc32")])
        bins, offsets = pack_lengths(lot["length"].to_numpy(), capacity)
        return lot.drop_columns(["copy"]).append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, lot long, bin long, offset long"
    short = dealt.where("lot is not null").groupBy("lot").applyInArrow(pack, schema)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    # numbers: bins of lot l are l, l + lots, ...; full pieces count down from -1 by a hash-free unique number
    packed_short = short.withColumn("sequence_id", F.col("bin") * lots + F.col("lot")).select(*columns)
    full = (dealt.where("lot is null").withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")).select(*columns))
    return packed_short.unionByName(full)


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """The training sequences themselves: (sequence_id, ids array<int>, doc_ids), pieces in order of offset.

    ``placed`` is the result of :func:`packed`; a bin holds ``capacity`` ids at most, so a group is bounded.
    """
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    nth = Window.partitionBy(*keys).orderBy(F.lit(0))      # repeated rows pair up one to one
    left = placed.withColumn("_n", F.row_number().over(nth.orderBy("sequence_id", "offset")))
    right = pieces(docs, vocabulary, capacity, end_id).select(*keys, "ids", F.row_number().over(nth.orderBy("copy")).alias("_n"))
    same = [left[k].eqNullSafe(right[k]) for k in keys] + [left["_n"] == right["_n"]]
    joined = left.join(right, same).select(left["sequence_id"], left["offset"], left["doc_id"], right["ids"])

    def line(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("offset")
        ids = np.frombuffer(b"".join(parts["ids"].to_pylist()), "<u4").astype(np.int32)
        return pa.table({"sequence_id": parts["sequence_id"].slice(0, 1), "ids": pa.array([ids], pa.list_(pa.int32())),
                         "doc_ids": pa.array([parts["doc_id"].to_pylist()], pa.list_(pa.int64()))})

    return joined.groupBy("sequence_id").applyInArrow(line, "sequence_id long, ids array<int>, doc_ids array<long>")
