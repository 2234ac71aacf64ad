"""Encoding texts through caches of their pieces.

Byte-pair encoders treat each pre-token alone, and no pre-token runs from a non-space to white space. So a text may be
cut after each word: a piece is the white space before a word and the word. Each piece is encoded once per worker,
by the hash of its bytes, and looked up as arrays: no Python object per word.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # tasks share the cores; forked workers can't share threads

#: Slots of a worker's cache and ids it holds at most before it starts anew.
CACHE_SLOTS = 1 << 19
CACHE_IDS = 4_000_000


def library(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class PieceCache:
    """Piece hash -> ids, one entry a slot; a newer piece takes the place of an older one.

    ``encode`` maps a list of pieces (str) to a list of id lists.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], slots: int = CACHE_SLOTS):
        self.encode, self.mask = encode, np.uint64(slots - 1)
        self.keys = np.zeros(slots, np.uint64)
        self.start = np.zeros(slots, np.int64)
        self.size = np.zeros(slots, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def look_up(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Where the ids of each piece lie in ``pool``, and how many they are."""
        if self.used > CACHE_IDS:
            self.keys[:] = 0
            self.used = 0
        slot = (hashes & self.mask).astype(np.int64)
        at, size = self.start[slot], self.size[slot]
        missing = np.flatnonzero(self.keys[slot] != hashes)
        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            rows = missing[first]
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[rows].tolist(), ends[rows].tolist())]
            found = self.encode(texts)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
            where = self.used + np.cumsum(sizes) - sizes
            self._add(flat)
            at[missing], size[missing] = where[back], sizes[back]
            slots = slot[rows]
            self.keys[slots], self.start[slots], self.size[slots] = new, where, sizes
            # of two new pieces in one slot the last written one stays in all three arrays alike
        return at, size

    def _add(self, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            pool = np.zeros(max(2 * len(self.pool), self.used + len(ids)), np.uint32)
            pool[:self.used] = self.pool[:self.used]
            self.pool = pool
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)


def gather(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids of all pieces, one after the other."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, pool.dtype)
    step = np.ones(total, np.int64)
    filled = size > 0
    begin = (np.cumsum(size) - size)[filled]
    first, length = at[filled], size[filled]
    step[begin[0]] = first[0]
    step[begin[1:]] = first[1:] - (first[:-1] + length[:-1] - 1)
    return pool[np.cumsum(step)]
