"""Word spans and fingerprints of Arrow text columns, vectorised over a whole batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Modulus of the Rabin-Karp fingerprints: the Mersenne prime 2**61 - 1.
PRIME = (1 << 61) - 1
#: Base of the window polynomial, a fixed random residue.
BASE = 1_046_527_123_977_261_931
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_P = np.uint64(PRIME)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Lane masks: the lowest k bytes of a little-endian word of eight.
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null rows are empty."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    whole = whole.fill_null("").cast(pa.large_string())
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks)
    _, offsets, data = whole.buffers()
    rows = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[rows[0] : rows[-1]], rows - rows[0]


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each row's words start (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(rows), np.int64)
    word = ~_SPACE[data]
    # A row's first byte starts a word and its last byte ends one, whatever stands beside it.
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint below ``PRIME`` for every word, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    h = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, active = 0, np.arange(len(starts))
    while len(active):
        lane = lanes[starts[active] + at] & _MASKS[np.minimum(sizes[active] - at, 8)]
        lane *= np.uint64(0xBF58476D1CE4E5B9)
        lane ^= lane >> np.uint64(31)
        mixed = (h[active] ^ lane) * np.uint64(0x94D049BB133111EB)
        h[active] = mixed ^ (mixed >> np.uint64(29))
        at += 8
        active = active[sizes[active] > at]
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(27))) % _P


def _times(values: np.ndarray, factor: int) -> np.ndarray:
    """``values * factor`` modulo ``PRIME`` in 64-bit arithmetic."""
    high, low = np.uint64(factor >> 31), np.uint64(factor & ((1 << 31) - 1))
    up, down = values >> np.uint64(31), values & _LOW31
    middle = down * high + up * low
    total = up * high * np.uint64(2) + (middle >> np.uint64(30))
    total += ((middle & _LOW30) << np.uint64(31)) + down * low
    return _reduced(total)


def _reduced(values: np.ndarray) -> np.ndarray:
    folded = (values >> np.uint64(61)) + (values & _P)
    return np.where(folded >= _P, folded - _P, folded)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive words, by doubling.

    The hash of ``a`` words followed by ``b`` words is ``A * BASE**b + B``.
    """
    if len(words) < size:
        return np.zeros(0, np.uint64)
    power, length = words, 1  # hashes of ``length`` words, a power of two
    made, covered = None, 0  # hashes of the first ``covered`` words of a window
    while True:
        if size & length:
            if made is None:
                made = power
            else:
                n = len(power) - covered
                made = _reduced(_times(made[:n], pow(BASE, length, PRIME)) + power[covered:])
            covered += length
        if covered == size:
            return made[: len(words) - size + 1]
        n = len(power) - length
        power = _reduced(_times(power[:n], pow(BASE, length, PRIME)) + power[length:])
        length *= 2
