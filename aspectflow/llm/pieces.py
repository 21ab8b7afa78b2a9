"""SentencePiece BPE encoding and decoding of whole texts in vectorised merge rounds.

A batch of texts becomes one flat array of code points.  Words are runs of the space symbol with what follows; no piece
holds a space symbol after another character, so no merge crosses a word's start.  Distinct words of the batch are
merged together: every round finds each word's smallest pair rank (a segmented minimum), merges all its leftmost
non-overlapping pairs of that rank at once, closes the gaps, and drops the words in which no pair is left.  Ids of the
words are then dealt to all places where they occur.  Characters in no piece become byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from aspectflow.llm.shingles import text_batches
from aspectflow.llm.words import BASE, KnownWords, distinct_words, known_or_made, spans

MODEL = "piece_bpe_32k.model"
SPACE = 0x2581                # the symbol that stands for a blank
BATCH_BYTES = 2 << 20         # text that is merged together; a longer text is a batch of its own
CACHE_WORDS = 250_000         # words whose ids a worker keeps; beyond that it keeps those of its last batch
_NONE = np.int32(2**31 - 1)   # rank of a pair that is no piece

_U = np.uint64


def model_path(name: str = MODEL) -> str:
    """Default place of a public model file; every function takes another path."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """A BPE model with byte fallback, identity normalisation and a leading space symbol; other kinds are refused."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(names) if not special[i] and not sp.is_unused(i)}
        if (sp.normalize(" a  b") != "▁▁a▁▁b" or sp.normalize("ﬁ") != "▁ﬁ" or any(sp.is_unused(i) for i in range(size))
                or not any(sp.is_byte(i) for i in range(size)) or min(self.bos, self.eos) < 0
                or any("▁" in p.lstrip("▁") for p in ids)):
            raise ValueError("not a BPE model with identity normalisation, byte fallback and leading space symbols")
        # symbols: pieces by their id, then single characters that occur in pieces only
        symbols = dict(ids)
        for p in ids:
            for c in p:
                symbols.setdefault(c, size + len(symbols) - len(ids))
        score = np.array([sp.get_score(i) for i in range(size)])
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        keys, merged, alone = [], [], np.zeros(size, bool)
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
                    for part in (left, right):      # merging on from a part may come before the next merge into that part
                        if part < size and rank[i] <= rank[part]:
                            alone[part] = True
        self._table(np.array(keys, np.int64), np.array(merged, np.int32))
        self.rank, self.alone, self.size = rank, alone, size
        self.known = KnownWords()
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.cp_of = np.zeros(size + len(symbols) - len(ids), np.int64)
        for s, i in symbols.items():
            self.cp_of[i] = ord(s[0])
        # decoding: the bytes of each id
        self.is_control = np.array([sp.is_control(i) for i in range(size)])
        self.is_byte = np.array([sp.is_byte(i) for i in range(size)])
        out = [b"" if self.is_control[i] else bytes([int(names[i][3:5], 16)]) if self.is_byte[i]
               else " ⁇ ".encode() if sp.is_unknown(i) else names[i].replace("▁", " ").encode() for i in range(size)]
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        self.out_len = np.array([len(b) for b in out], np.int64)
        self.out_start = np.cumsum(self.out_len) - self.out_len
        self.leads = np.array([not special[i] and names[i].startswith("▁") for i in range(size)])

    def _table(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """A hash table of pairs, at most an eighth full: a pair stands at its slot or at one of the next ``reach``."""
        bits = max(4, int(8 * len(keys)).bit_length())
        self.shift, self.reach = _U(64 - bits), 0
        self.keys, self.merged = np.full((1 << bits) + 64, -1, np.int64), np.zeros((1 << bits) + 64, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == -1
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            now = free & first
            self.keys[slot[now]], self.merged[slot[now]] = keys[left[now]], merged[left[now]]
            slot, left = slot[~now] + 1, left[~now]
            self.reach += 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(_U) * BASE) >> self.shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair; ``_NONE`` where the two are no piece."""
        rank, to = np.full(len(left), _NONE, np.int32), np.zeros(len(left), np.int32)
        rows = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[rows].astype(np.int64) << 32 | right[rows].astype(np.int64)
        slot = self._slots(key)
        for _ in range(self.reach):
            there = self.keys[slot]
            hit = there == key
            to[rows[hit]] = self.merged[slot[hit]]
            rank[rows[hit]] = self.rank[to[rows[hit]]]
            on = ~hit & (there != -1)
            if not on.any():
                break
            rows, key, slot = rows[on], key[on], slot[on] + 1
        return rank, to

    def merge_words(self, symbol: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words laid out one after the other until no pair is left: (symbols, lengths) in the same order.

        Negative symbols stand for characters in no piece and never merge.
        """
        words = len(lengths)
        ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []      # (words, their lengths, their symbols)
        word, length = np.arange(words), np.asarray(lengths, np.int64)
        symbol = np.asarray(symbol, np.int32)
        last = np.zeros(len(symbol), bool)
        last[np.cumsum(length) - 1] = True
        rank, to = np.full(len(symbol), _NONE, np.int32), np.zeros(len(symbol), np.int32)
        at = np.flatnonzero(~last)
        rank[at], to[at] = self._pairs(symbol[at], symbol[at + 1])
        while len(word):
            starts = np.cumsum(length) - length
            least = np.minimum.reduceat(rank, starts)
            open_ = least != _NONE
            if not open_.all():
                rows = np.repeat(open_, length)
                ends.append((word[~open_], length[~open_], symbol[~rows]))
                word, length, least = word[open_], length[open_], least[open_]
                symbol, rank, to = symbol[rows], rank[rows], to[rows]
                if not len(word):
                    break
            owners = np.repeat(np.arange(len(length)), length)
            at = np.flatnonzero(rank == least[owners])
            # of overlapping pairs every second one, from the left
            first = np.empty(len(at), bool)
            first[:1], first[1:] = True, np.diff(at) != 1
            run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            # where merging on may come before the other pairs of this rank, only the leftmost one
            owner = owners[at]
            at = at[~self.alone[to[at]] | np.r_[True, owner[1:] != owner[:-1]]]
            symbol[at] = to[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            # the right symbol's pair becomes the merged symbol's pair
            rank[at], to[at] = rank[at + 1], to[at + 1]
            new_at = at - np.arange(len(at))
            symbol, rank, to = symbol[keep], rank[keep], to[keep]
            length = length - np.bincount(owners[at], minlength=len(length))
            ends_at = np.cumsum(length)
            edge = np.zeros(len(symbol) + 1, bool)           # a word starts here
            edge[ends_at - length] = edge[-1] = True
            changed = np.zeros(len(symbol), bool)
            changed[new_at] = True
            changed[new_at[~edge[new_at]] - 1] = True
            closed = edge[1:]
            rank[changed & closed] = _NONE
            again = np.flatnonzero(changed & ~closed)
            rank[again], to[again] = self._pairs(symbol[again], symbol[again + 1])
        if not ends:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        done, sizes, symbols = (np.concatenate([e[k] for e in ends]) for k in range(3))
        order = np.argsort(done)
        begins = np.cumsum(sizes) - sizes
        return symbols[spans(begins[order], sizes[order])], sizes[order]

    def _ids(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of merged words; a symbol that is no piece becomes the ids of its UTF-8 bytes."""
        odd = (symbols < 0) | (symbols >= self.size)
        if not odd.any():
            return symbols.astype(np.uint32), lengths
        places = np.flatnonzero(odd)
        chars = [chr(int(-1 - s) if s < 0 else int(self.cp_of[s])).encode("utf-8", "surrogatepass") for s in symbols[places]]
        wide = np.ones(len(symbols), np.int64)
        wide[places] = [len(c) for c in chars]
        ids = np.repeat(symbols, wide).astype(np.uint32)
        ids[spans((np.cumsum(wide) - wide)[places], wide[places])] = self.byte_id[np.frombuffer(b"".join(chars), np.uint8)]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        return ids, np.bincount(owner, weights=wide, minlength=len(lengths)).astype(np.int64)

    def encode(self, texts: pa.Array, bos: bool = True, eos: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids per text); null is the empty text, which has no leading symbol."""
        texts = pc.fill_null(texts, "")
        chars = np.asarray(pc.utf8_length(texts), dtype=np.int64)
        cp = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
        filled = np.flatnonzero(chars)
        per_text = np.zeros(len(chars), np.int64)
        if len(filled):
            cp = np.insert(cp, (np.cumsum(chars) - chars)[filled], SPACE)
            cp[cp == 0x20] = SPACE
            chars = chars + (chars > 0)
            blank = cp == SPACE
            begins = blank.copy()
            begins[1:] &= ~blank[:-1]
            begins[(np.cumsum(chars) - chars)[filled]] = True
            starts = np.flatnonzero(begins)
            lengths = np.diff(np.append(starts, len(cp)))
            rep, which, hashes = distinct_words(cp, starts, lengths)
            word_ids, word_start, word_len = self._words(cp, starts[rep], lengths[rep], hashes)
            ids = word_ids[spans(word_start[which], word_len[which])]
            text_start = (np.cumsum(chars) - chars)[filled]
            per_text[filled] = np.add.reduceat(word_len[which], np.searchsorted(starts, text_start))
        else:
            ids = np.empty(0, np.uint32)
        ends = np.cumsum(per_text)
        places = np.concatenate([(ends - per_text) if bos else ends[:0], ends if eos else ends[:0]])
        marks = np.concatenate([np.full(len(ends) if bos else 0, self.bos), np.full(len(ends) if eos else 0, self.eos)])
        # at equal places a text's end comes before the next text's begin; inside an empty text begin before end
        doc = np.concatenate([np.arange(len(ends))[: len(ends) if bos else 0], np.arange(len(ends))[: len(ends) if eos else 0]])
        order = np.lexsort((np.concatenate([np.zeros(len(ends) if bos else 0), np.ones(len(ends) if eos else 0)]), doc))
        return np.insert(ids, places[order], marks[order].astype(np.uint32)), per_text + int(bos) + int(eos)

    def _words(self, cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each distinct word's ids start, how many they are); words that are known already are not merged again."""
        def merge(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            symbol = self.symbol_of[flat]
            return self._ids(*self.merge_words(np.where(symbol < 0, -1 - flat.astype(np.int64), symbol).astype(np.int32), sizes))

        self.known, *out = known_or_made(self.known, cp, starts, lengths, hashes, merge, CACHE_WORDS)
        return tuple(out)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """UTF-8 of each text: control pieces vanish, the leading space symbol goes, invalid bytes become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        size = self.out_len[ids]
        start = self.out_start[ids]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        visible = np.flatnonzero(~self.is_control[ids])
        head = visible[np.r_[True, owner[visible][1:] != owner[visible][:-1]][: len(visible)]]
        head = head[self.leads[ids[head]]]
        start, size = start.copy(), size.copy()
        start[head] += 1
        size[head] -= 1
        data = self.out_bytes[spans(start, size)].tobytes()
        per_text = np.bincount(owner, weights=size, minlength=len(lengths)).astype(np.int64)
        ends = np.cumsum(per_text)
        texts = [data[e - n:e] for e, n in zip(ends.tolist(), per_text.tolist())]
        try:
            data.decode()
        except UnicodeDecodeError:           # ids that no encoder gave
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            texts = [self._mended(t, ids[a:b]) for t, a, b in zip(texts, bounds[:-1], bounds[1:])]
        return texts

    def _mended(self, text: bytes, ids: np.ndarray) -> bytes:
        """Runs of byte pieces decoded one by one: a byte that starts no valid character becomes U+FFFD."""
        try:
            text.decode()
            return text
        except UnicodeDecodeError:
            pass
        out, run, seen = [], bytearray(), False
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.out_bytes[self.out_start[i]:self.out_start[i] + 1].tobytes()
                seen = True
                continue
            while run:
                for wide in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:wide]).decode().encode())
                        del run[:wide]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    del run[:1]
            if i >= 0 and not self.is_control[i]:
                piece = self.out_bytes[self.out_start[i]:self.out_start[i] + self.out_len[i]].tobytes()
                out.append(piece[1:] if not seen and self.leads[i] else piece)
                seen = True
        return b"".join(out)


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model of a file, loaded once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encoded(docs: DataFrame, model: str | None = None, bos: bool = True, eos: bool = True,
            batch_bytes: int = BATCH_BYTES, decode: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document; ``ids`` holds little-endian unsigned 32-bit piece ids.

    With ``decode`` a column ``text`` holds what the ids stand for, as :func:`decoded` gives it, in the same pass.
    Null text is the empty text: the begin and end ids alone.  Repeated rows are encoded alike, null ids stay, an empty
    table gives an empty result, and other columns of ``docs`` are not looked at.  Texts are encoded whole, in batches of
    about ``batch_bytes`` of text, so that a task's memory is bounded by that or by its longest text.
    """
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(path)
        for batch in text_batches(batches, size=batch_bytes):
            ids, lengths = m.encode(batch["text"], bos, eos)
            ends = 4 * np.concatenate([[0], np.cumsum(lengths)])
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
                None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            columns = [batch["doc_id"], pa.array(lengths), column.cast(pa.binary())]
            if decode:
                columns.append(pa.array(m.decode(ids, lengths), pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "text"][: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary" + (", text string" if decode else ""))


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` (doc_id, n_tokens, ids) with ``text``, what the ids stand for; null ids give null text."""
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(path)
        for batch in batches:
            blobs = batch["ids"].to_pylist()
            ids = np.frombuffer(b"".join(b or b"" for b in blobs), "<u4")
            texts = m.decode(ids, np.array([len(b or b"") // 4 for b in blobs], np.int64))
            column = pa.array([None if b is None else t.decode() for b, t in zip(blobs, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=["doc_id", "n_tokens", "ids", "text"])

    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")
