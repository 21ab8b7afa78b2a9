"""Whole-text tokenization with a public BPE vocabulary, and cutting id sequences into binary columns.

The vocabulary lower-cases and drops white space, so a text's ids are the ids of its white-space separated chunks in
order.  Chunks repeat, so a batch encodes distinct ones only, and each worker keeps a bounded number of them.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from aspectflow.llm.words import KnownWords, distinct_words, known_or_made, spans

VOCABULARY = "word_bpe_49k.json"
CACHE_ENTRIES = 1_000_000
TEXT_BYTES = 2 << 20           # text that is split together; a longer text is a batch of its own

_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#%&$()|\"-]*)\Z")


# What the batch-wise split needs to know of each character, one bit each: white space that splits by any rule of the
# vocabulary (other white space stays inside a chunk and is left to the library), points and commas, what stands before
# one that starts a piece of its own, and letters for which lower case is a matter of one character, 32 further on.
_BLANK, _POINT, _BEFORE, _LETTER, _UPPER = 1, 2, 4, 8, 16
_KIND = np.zeros(0x110000, np.uint8)
_KIND[[ord(c) for c in " \t\n\r"]] = _BLANK
_KIND[[ord(c) for c in ".,"]] = _POINT
for _c in range(0x100):
    if re.match("[A-Za-z0-9À-ÖØ-öø-ÿ]", chr(_c)):
        _KIND[_c] = _BEFORE | (0 if chr(_c).isdigit() else _LETTER | (_UPPER if chr(_c).isupper() else 0))


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Default place of a public vocabulary file; every function takes another path."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Whole-text encoding by a vocabulary file: the ids of a text are those of its chunks in order.

    A batch of texts is split into chunks on one flat array of code points, and the library encodes each distinct
    chunk once.  Ids of chunks are kept over batches, up to ``CACHE_ENTRIES`` of them; beyond that those of the last
    batch stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        # the vocabulary's characters for a Latin-1 letter's two bytes: the bytes themselves but for two of them
        self.odd_bytes = [(chr(b), self.bytes_of[0xC0 + b - 0x80][1]) for b in range(0x9F, 0xC0)
                          if 0xC0 + b - 0x80 in self.bytes_of and self.bytes_of[0xC0 + b - 0x80] != "Ã" + chr(b)]
        self.known = KnownWords()
        self.parts: dict[str, list[int]] = {}

    def level(self, word: str) -> str:
        """A word of lower-case Latin-1 letters in the characters that the vocabulary has for its bytes."""
        word = word.encode().decode("latin-1")
        for byte, char in self.odd_bytes:
            word = word.replace(byte, char)
        return word

    def slowly(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def chunk(self, chunk: str) -> list[int]:
        """Ids of one chunk: a plain word is lower-cased and goes straight to the model, marks after it are split off."""
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            return [t.id for t in self.model.tokenize(chunk)]
        word = _WORD.match(chunk)
        if word is None:
            return self.slowly(chunk)
        if word[2]:
            return self.part(word[1]) + self.part(word[2])
        lower = chunk.lower()
        return self.part(lower) if lower != chunk else [t.id for t in self.model.tokenize(self.level(chunk))]

    def part(self, part: str) -> list[int]:
        """Ids of a part of a chunk, kept while there are few."""
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= CACHE_ENTRIES // 4:
                self.parts.clear()
            ids = self.parts[part] = self.chunk(part)
        return ids

    def _chunks(self, cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each distinct chunk's ids start, how many they are)."""
        def library(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            text = flat.astype("<u4").tobytes().decode("utf-32-le")
            ends = np.cumsum(sizes)
            plain = np.bitwise_and.reduceat(_KIND[flat], ends - sizes) & _LETTER if len(sizes) else np.empty(0, np.uint8)
            model, marked, level = self.model.tokenize, self.chunk, self.level
            found = []
            for a, b, letters in zip((ends - sizes).tolist(), ends.tolist(), plain.tolist()):
                word = text[a:b]               # words of letters alone are in lower case here
                found.append([t.id for t in model(word if word.isascii() else level(word))] if letters else marked(word))
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

        self.known, *out = known_or_made(self.known, cp, starts, lengths, hashes, library, CACHE_ENTRIES)
        return tuple(out)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all whole texts one after the other, ids per text); a null text has none."""
        texts = pc.fill_null(texts, "")
        chars = np.asarray(pc.utf8_length(texts), dtype=np.int64)
        cp = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(chars)
        kind = _KIND[cp]
        blank = (kind & _BLANK).astype(bool)
        fresh = np.ones(len(cp), bool)               # a chunk may start here: after a blank, at a text's start, at a point
        fresh[1:] = blank[:-1] | ((kind[1:] == _POINT) & (kind[:-1] & _BEFORE).astype(bool))
        fresh[(ends - chars)[chars > 0]] = True
        starts = np.flatnonzero(~blank & fresh)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(chars), np.int64)
        stops = fresh | blank
        stops = np.append(np.flatnonzero(stops), len(cp))
        lengths = stops[np.searchsorted(stops, starts, side="right")] - starts
        keep = ~blank
        dense, kind = cp[keep], kind[keep]           # chunks without the blanks
        at = np.cumsum(lengths) - lengths
        # words of letters alone in lower case, the vocabulary's own rule, so that they repeat more
        plain = np.repeat(np.bitwise_and.reduceat(kind, at) & _LETTER, lengths).astype(bool)
        dense = dense + ((kind & _UPPER).astype(bool) & plain) * np.uint32(32)
        rep, which, hashes = distinct_words(dense, at, lengths)
        ids, id_start, id_len = self._chunks(dense, at[rep], lengths[rep], hashes)
        out = ids[spans(id_start[which], id_len[which])]
        owner = np.searchsorted(ends, starts, side="right")
        return out, np.bincount(owner, weights=id_len[which], minlength=len(chars)).astype(np.int64)

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of one whole text."""
        return self.encode_all(pa.array([text], pa.string()))[0]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, np.cumsum(lengths), np.uint32(end_id)).astype("<u4"), lengths + 1
