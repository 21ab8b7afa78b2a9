"""Words as spans of one flat array of code points: distinct ones, and those whose ids are known already."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from aspectflow.llm.shingles import mix64

_U = np.uint64
BASE = _U(0x9E3779B97F4A7C15 | 1)
_MIXED = mix64(np.arange(1, 0x3001, dtype=_U))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of all spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def distinct_words(cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one word for each distinct one, which of them each word is, ascending hashes), exact: equal hashes are compared."""
    powers = np.full(int(lengths.max()), BASE, _U)
    powers[:1] = 1
    powers = np.cumprod(powers)
    inside = np.arange(len(cp), dtype=np.int64) - np.repeat(starts, lengths)
    values = _MIXED[cp] if int(cp.max()) < len(_MIXED) else mix64(cp.astype(_U) + _U(1))
    hashes = mix64(np.add.reduceat(values * powers[inside], starts) + lengths.astype(_U))
    hashes, rep, which = np.unique(hashes, return_index=True, return_inverse=True)
    there = np.minimum(np.repeat(starts[rep[which]], lengths) + inside, len(cp) - 1)
    differs = np.logical_or.reduceat(cp[there] != cp, starts) | (lengths[rep[which]] != lengths)
    if differs.any():                    # a hash collision: such a word stands for itself
        odd = np.flatnonzero(differs)
        which[odd] = len(rep) + np.arange(len(odd))
        rep = np.concatenate([rep, odd])
    return rep, which, hashes


class KnownWords:
    """Words already merged, by sorted hash: code points, which are compared, and ids, both one after the other."""

    def __init__(self):
        self.hash = np.empty(0, _U)
        self.cp, self.ids = np.empty(0, np.uint32), np.empty(0, np.uint32)
        self.start, self.len, self.id_start, self.id_len = (np.empty(0, np.int32) for _ in range(4))

    def find(self, hashes: np.ndarray, cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the word is really there) of each word."""
        at = np.searchsorted(self.hash, hashes)
        if not len(self.hash):
            return at, np.zeros(len(at), bool)
        near = np.minimum(at, len(self.hash) - 1)
        hit = (self.hash[near] == hashes) & (self.len[near] == lengths)
        rows = np.flatnonzero(hit)
        if len(rows):
            n = lengths[rows]
            unlike = self.cp[spans(self.start[near[rows]].astype(np.int64), n)] != cp[spans(starts[rows], n)]
            hit[rows] = ~np.logical_or.reduceat(unlike, np.cumsum(n) - n)
        return at, hit

    def add(self, at: np.ndarray, hashes: np.ndarray, cp: np.ndarray, lengths: np.ndarray, ids: np.ndarray, id_len: np.ndarray) -> None:
        """Insert words with new hashes, ascending, at the places that :meth:`find` gave."""
        new = np.append(self.hash, _U(0))[np.minimum(at, len(self.hash))] != hashes if len(self.hash) else np.ones(len(at), bool)
        self.start = np.insert(self.start, at[new], (len(self.cp) + np.cumsum(lengths) - lengths)[new])
        self.id_start = np.insert(self.id_start, at[new], (len(self.ids) + np.cumsum(id_len) - id_len)[new])
        self.len, self.id_len = np.insert(self.len, at[new], lengths[new]), np.insert(self.id_len, at[new], id_len[new])
        self.hash = np.insert(self.hash, at[new], hashes[new])
        self.cp, self.ids = np.concatenate([self.cp, cp]), np.concatenate([self.ids, ids])


def known_or_made(known: KnownWords, cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray,
                  make: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], most: int,
                  ) -> tuple[KnownWords, np.ndarray, np.ndarray, np.ndarray]:
    """(known words from now on, ids, where each distinct word's ids start, how many they are).

    ``hashes`` are those of the first words, ascending; further words share a hash with one of them.  ``make`` gives
    (ids, ids per word) for the words that are not known, laid out one after the other.  When more than ``most`` words
    would be known, only those of this call stay.
    """
    k = len(hashes)
    at, hit = known.find(hashes, cp, starts[:k], lengths[:k])
    missed = np.concatenate([np.flatnonzero(~hit), np.arange(k, len(starts))])
    flat = cp[spans(starts[missed], lengths[missed])]
    new_ids, new_len = make(flat, lengths[missed])
    id_start, id_len = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
    places = at[hit]
    id_start[:k][hit], id_len[:k][hit] = known.id_start[places], known.id_len[places]
    id_start[missed], id_len[missed] = len(known.ids) + np.cumsum(new_len) - new_len, new_len
    ids = np.concatenate([known.ids, new_ids])
    fresh, at = int((~hit).sum()), at[~hit]
    if len(known.hash) + fresh > most:
        known = KnownWords()
        fresh, missed, at = k, np.arange(k), np.zeros(k, np.int64)
        flat = cp[spans(starts[:k], lengths[:k])]
        new_ids, new_len = ids[spans(id_start[:k], id_len[:k])], id_len[:k]
    chars = int(lengths[missed[:fresh]].sum())
    known.add(at, hashes[missed[:fresh]], flat[:chars], lengths[missed[:fresh]], new_ids[: int(new_len[:fresh].sum())], new_len[:fresh])
    return known, ids, id_start, id_len
