"""Hashes of byte ranges, words and word windows over many texts at once.

A block of texts is one byte array. Words, lines and other ranges that don't overlap have a multilinear hash
(``spans``): the sum of ``value[byte] * key[position in the range]`` modulo 2**64, with keys that look random and owe nothing
to the text. Two ranges agree with a probability of about 2**-57, whatever they hold.

Short windows that overlap (``running`` and ``ranges``) come from a running sum of ``value[byte] * R**position``: two of its
entries give the hash of a range, the difference divided by ``R**start``. A polynomial modulo 2**64 is weak for ranges of a
thousand bytes and more, so nothing longer than some tens of bytes is hashed that way.
"""

from __future__ import annotations

import numpy as np

_R = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: One value for each byte; ``FOLDED`` has those of a-z for A-Z.
EXACT = _values
FOLDED = _values.copy()
FOLDED[65:91] = _values[97:123]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("_powers", _R), ("_inverse", pow(_R, -1, 1 << 64))):
                table = np.full(size, np.uint64(base & _MASK))
                table[0] = 1
                globals()[name] = np.cumprod(table, dtype=np.uint64)
    return _powers, _inverse


def _keys(positions: np.ndarray) -> np.ndarray:
    return mix((positions + 1).astype(np.uint64) * np.uint64(_R) + np.uint64(0x2545F4914F6CDD1D))


#: Keys of the first positions; longer ranges compute theirs.
_KEYS = _keys(np.arange(1 << 12))


#: Bytes hashed in one go.
_AT_ONCE = 1 << 20


def spans(data: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each byte range; meant for ranges that don't overlap, as its cost is that of their bytes."""
    length = np.asarray(ends) - starts
    upto = np.cumsum(length)
    if len(length) < 2 or upto[-1] <= _AT_ONCE:
        return _spans(data, values, starts, length)
    # in parts, as a byte takes some tens of bytes on the way; long ranges by themselves
    out = np.zeros(len(length), np.uint64)
    edges = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(_AT_ONCE, upto[-1], _AT_ONCE)), [len(length)]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        long_ = np.flatnonzero(length[a:b] > _AT_ONCE)
        short = np.where(length[a:b] > _AT_ONCE, 0, length[a:b])
        out[a:b] = _spans(data, values, starts[a:b], short)
        for k in (long_ + a).tolist():
            out[k] = _span(data, values, int(starts[k]), int(ends[k]))
    return out


def _spans(data, values, starts, length) -> np.ndarray:
    n = int(length.sum()) if len(length) else 0
    if len(length) == 1 and n > _AT_ONCE:
        return np.array([_span(data, values, int(starts[0]), int(starts[0]) + n)])
    first = np.cumsum(length) - length
    place = np.arange(n) - np.repeat(first, length)
    keys = _KEYS[place] if len(length) == 0 or length.max() <= len(_KEYS) else _keys(place)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data[place + np.repeat(starts, length)]] * keys, out=sums[1:])
    return mix(sums[first + length] - sums[first] + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _span(data: np.ndarray, values: np.ndarray, start: int, end: int) -> np.uint64:
    """The hash of one long range."""
    total = np.zeros(1, np.uint64)
    for at in range(start, end, _AT_ONCE):
        part = np.arange(at, min(at + _AT_ONCE, end))
        total += (values[data[part]] * _keys(part - start)).sum(dtype=np.uint64)
    return mix(total + np.array([end - start], np.uint64) * np.uint64(0xD6E8FEB86659FD93))[0]


def running(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Entry i is the sum over the first i bytes."""
    powers, _ = _power_table(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[:len(data)], out=out[1:])
    return out


def ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each short byte range; it depends on the bytes and their number only."""
    _, inverse = _power_table(len(sums))
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and how many words come before each text (one entry more than texts).

    ``gap`` tells for each byte whether it parts words.
    """
    solid = ~gap[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    opens[inner] = solid[inner]              # a text's edge parts words too
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; entry i starts at word i."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k:k + n] * np.uint64((0xA0761D6478BD642F * (2 * k + 1) + 2 * k) & _MASK | 1)
    return mix(out)
