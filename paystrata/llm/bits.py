"""Filters of bits: which of very many 64-bit hashes are in a set, with some too many and none too few.

A filter has two bits for each member, is sized by their number, and never grows beyond ``MOST_BITS``; then it lets more through.
It only spares work: whoever uses one checks, or can do with, what it lets through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paystrata.llm import hashing

BITS_TO_A_MEMBER = 16
MOST_BITS = 1 << 28
#: Bits that travel in one row.
CHUNK_BITS = 1 << 19


class Filter:
    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in _places(hashes, self.mask):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def empty(self) -> bool:
        return not self.bits.any()


def _places(hashes: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return hashes & mask, hashing.mix(hashes) & mask


def filter_of(hashes: DataFrame, members: int) -> Filter:
    """The filter of a column of hashes (long). Tasks set bits and unite them; the driver gets the united bits only."""
    n_bits = CHUNK_BITS
    while n_bits < min(BITS_TO_A_MEMBER * members, MOST_BITS):
        n_bits *= 2

    def run(batches):
        bits = np.zeros(n_bits, bool)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for place in _places(own, np.uint64(n_bits - 1)):
                bits[place] = True
        packed = np.packbits(bits, bitorder="little").reshape(-1, CHUNK_BITS // 8)
        filled = np.flatnonzero(packed.any(axis=1))
        yield _rows(filled.tolist(), [packed[k].tobytes() for k in filled])

    def unite(batches):
        held: dict[int, np.ndarray] = {}        # chunks are few: the filter's size bounds them
        for batch in batches:
            for chunk, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bits = np.frombuffer(one, np.uint8)
                held[chunk] = held[chunk] | bits if chunk in held else bits
        yield _rows(list(held), [b.tobytes() for b in held.values()])

    schema = "chunk int, bits binary"
    bits = np.zeros(n_bits // 8, np.uint8)
    for row in hashes.mapInArrow(run, schema).repartition("chunk").mapInArrow(unite, schema).collect():
        at = row["chunk"] * CHUNK_BITS // 8
        bits[at:at + CHUNK_BITS // 8] |= np.frombuffer(row["bits"], np.uint8)
    return Filter(bits)


def _rows(chunks: list[int], bits: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(bits, pa.binary())], names=["chunk", "bits"])
