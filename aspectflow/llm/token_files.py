"""Token-ID files: one file per shard, holding wavelet matrices.

A shard file is a Parquet file of blocks; a block is about ``BLOCK_TOKENS`` ids of whole documents in ascending doc_id
order, stored as a wavelet matrix: one bit-plane per id bit with a rank directory, and a document table.  From it come
the id at a position (access), how often an id occurs in a range (count) and where (occurrences), without decoding.
Files are written by Spark's own writer, so any shared store serves and a lost task is written anew.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aspectflow.llm.shingles import text_batches
from aspectflow.llm.tokens import TEXT_BYTES, encoder, vocabulary_path, with_end

END_ID = 2
BLOCK_TOKENS = 1 << 20
MAGIC = b"WMX1"
SUPER = 512           # bits per entry of the rank directory

BLOCKS = "shard int, block int, start_in_shard long, n_tokens long, n_docs long, payload binary"


class WaveletMatrix:
    """Bit-planes from the highest bit down; below each plane, ids with bit 0 precede ids with bit 1, stably."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], supers: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.supers = n, planes, zeros, supers
        self.bits = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, supers = [], [], []
        for level in range(bits - 1, -1, -1):
            one = ((x >> x.dtype.type(level)) & x.dtype.type(1)).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.frombuffer(packed.tobytes().ljust(-(-len(packed) // 8) * 8 + 8, b"\0"), "<u8")
            x = np.concatenate([x[~one], x[one]])
            planes.append(words)
            zeros.append(len(one) - int(np.count_nonzero(one)))
            counts = np.bitwise_count(words).astype(np.int64)
            supers.append(np.concatenate([[0], np.cumsum(counts)])[:: SUPER // 64].astype("<u4"))
        return cls(len(ids), planes, zeros, supers)

    def _bool(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").astype(bool)

    def rank1(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane: one directory entry and at most eight words."""
        word = at >> 6
        first = (word // (SUPER // 64)) * (SUPER // 64)
        total = int(self.supers[level][word // (SUPER // 64)]) + int(np.bitwise_count(self.planes[level][first:word]).sum())
        tail = int(self.planes[level][word]) & ((1 << (at & 63)) - 1)
        return total + tail.bit_count()

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) given bit of a plane, by bisection over rank."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self.rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def access(self, at: int) -> int:
        value = 0
        for level in range(self.bits):
            ones = self.rank1(level, at)
            bit = self.rank1(level, at + 1) - ones
            value = value << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return value

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            if symbol >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``symbol`` occurs at positions lo to hi - 1."""
        if symbol >> self.bits:
            return 0
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, symbol: int, lo: int = 0, hi: int | None = None) -> list[int]:
        """Positions of ``symbol`` in ascending order: down by rank, up again by select."""
        if symbol >> self.bits:
            return []
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        out = []
        for at in range(a, b):
            for level in range(self.bits - 1, -1, -1):
                bit = symbol >> (self.bits - 1 - level) & 1
                at = self.select(level, bit, at - self.zeros[level] if bit else at)
            out.append(at)
        return out

    def decode(self) -> np.ndarray:
        """All ids, rebuilt from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        y = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            one = self._bool(level)
            x = np.empty_like(y)
            x[~one], x[one] = y[: self.zeros[level]], y[self.zeros[level]:]
            x |= one.astype(kind) << kind(self.bits - 1 - level)
            y = x
        return y.astype("<u4")

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<QI", self.n, self.bits) + struct.pack(f"<{self.bits}Q", *self.zeros)
        return head + b"".join(s.tobytes() for s in self.supers) + b"".join(p.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", data, 4)
        zeros = list(struct.unpack_from(f"<{bits}Q", data, 16))
        at, words = 16 + 8 * bits, -(-(-(-n // 8)) // 8) + 1
        entries = -(-(words + 1) // (SUPER // 64))
        supers = [np.frombuffer(data, "<u4", entries, at + 4 * entries * i) for i in range(bits)]
        at += 4 * entries * bits
        planes = [np.frombuffer(data, "<u8", words, at + 8 * words * i) for i in range(bits)]
        return cls(n, planes, zeros, supers)


def block_payload(doc_ids: list[int | None], arrays: list[np.ndarray], bits: int) -> bytes:
    """Document table (ids, null flags, lengths) and wavelet matrix of one block."""
    ids = np.asarray([d or 0 for d in doc_ids], "<i8").tobytes()
    nulls = np.asarray([d is None for d in doc_ids], np.uint8).tobytes()
    lengths = np.asarray([len(a) for a in arrays], "<u8").tobytes()
    return struct.pack("<Q", len(doc_ids)) + ids + nulls + lengths + WaveletMatrix.build(np.concatenate(arrays), bits).to_bytes()


def open_block(payload: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(doc ids, lengths, matrix) of a block."""
    n = struct.unpack_from("<Q", payload)[0]
    ids, nulls = np.frombuffer(payload, "<i8", n, 8), np.frombuffer(payload, np.uint8, n, 8 + 8 * n)
    lengths = np.frombuffer(payload, "<u8", n, 8 + 9 * n).astype(np.int64)
    return [None if z else int(d) for d, z in zip(ids, nulls)], lengths, WaveletMatrix.from_bytes(payload[8 + 17 * n:])


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                      block_tokens: int = BLOCK_TOKENS, bits: int = 16) -> None:
    """Encode every whole text, append ``end_id``, and write one file of wavelet-matrix blocks per shard.

    Shards are ranges of doc_id (nulls first), ties ordered by the text's digest, so repeated ids may span shards.
    Null text is empty.  ``bits`` must hold every id.  An empty table writes files without blocks.
    """
    vocab = vocabulary or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(vocab), TaskContext.get().partitionId()
        ids: list[int | None] = []
        arrays: list[np.ndarray] = []
        state = {"block": 0, "start": 0, "n": 0}

        def close() -> pa.RecordBatch:
            row = [shard, state["block"], state["start"], state["n"], len(ids), block_payload(ids, arrays, bits)]
            state.update(block=state["block"] + 1, start=state["start"] + state["n"], n=0)
            ids.clear()
            arrays.clear()
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)],
                                              names=["shard", "block", "start_in_shard", "n_tokens", "n_docs", "payload"])

        for batch in text_batches(batches, size=TEXT_BYTES):
            flat, lengths = with_end(*enc.encode_all(batch["text"]), end_id)
            if len(flat) and int(flat.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            for doc_id, tokens in zip(batch["doc_id"].to_pylist(), np.split(flat, np.cumsum(lengths)[:-1])):
                ids.append(doc_id)
                arrays.append(tokens)
                state["n"] += len(tokens)
                if state["n"] >= block_tokens:
                    yield close()
        if ids:
            yield close()

    tie = F.xxhash64("text")
    (docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
     .mapInArrow(encode, BLOCKS).write.parquet(path))


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, payload in zip(batch["shard"].to_pylist(), batch["start_in_shard"].to_pylist(), batch["payload"]):
                ids, lengths, matrix = open_block(payload.as_py())
                data = memoryview(matrix.decode().tobytes())
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(ids), pa.int32()), pa.array(ids, pa.int64()),
                     pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = blocks.select("shard", "start_in_shard", "payload").mapInArrow(
        decode, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # one row per shard: the running total is over files, not rows
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return docs.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(blocks: DataFrame, symbol: int) -> DataFrame:
    """(shard, position in shard) of every occurrence of an id, found in the succinct planes without decoding."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, payload in zip(batch["shard"].to_pylist(), batch["start_in_shard"].to_pylist(), batch["payload"]):
                at = open_block(payload.as_py())[2].occurrences(symbol)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(at), pa.int32()),
                                                  pa.array([start + a for a in at], pa.int64())], names=["shard", "position"])

    return blocks.select("shard", "start_in_shard", "payload").mapInArrow(find, "shard int, position long")
