"""Words, shingles and windows of whole texts as 64-bit numbers, for batches of texts at once.

A word is a run of bytes other than space and the control characters 9 to 13. Its number comes
from its bytes eight at a time, each step mixed so that no difference cancels another; words of
more than ``LONG_BYTES`` are digested one by one. Numbers of runs come from those of their halves
in the same way. Numbers are the same in every process.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
LONG_BYTES = 64
_PAIR = U64(0xD1B54A32D192ED03)  # odd, so that it loses no bit of the left half
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # the first k of eight bytes


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection that spreads every bit (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(U64) + U64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of several texts, in order: first[i] to first[i + 1] are those of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def sequences(self, length: int, which: int = 0) -> np.ndarray:
        """A number for each run of so many words, also for runs that cross texts. ``which``
        chooses between numbers that have nothing to do with each other."""
        if len(self.numbers) < length:
            return np.empty(0, U64)
        half = self.numbers if which == 0 else _numbers(self.data, self.starts, self.ends, which)
        run, held, width = None, 0, 1
        while width <= length:  # runs of 1, 2, 4 ... words; those that make up ``length`` are put together
            if length & width:
                run = half if run is None else _paired(run, half[held:], width)
                held += width
            width *= 2
            if width <= length:
                half = _paired(half, half[width // 2 :], width)
        return mixed(run, length)

    def whole(self) -> np.ndarray:
        """A number for the word sequence of each text."""
        plain = [self.numbers[a:b].tobytes() for a, b in zip(self.first[:-1], self.first[1:])]
        return np.frombuffer(b"".join(hashlib.blake2b(p, digest_size=8).digest() for p in plain), U64)


def _paired(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """Numbers of runs from those of their first and second parts, as far as both reach."""
    n = min(len(left), len(right))
    with np.errstate(over="ignore"):
        return mixed(left[:n] * _PAIR + right[:n], 1000 + width)


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """The numbers of words, given the bytes of all texts."""
    sizes = ends - starts
    numbers = mixed(sizes.astype(U64), 50 + which)
    # the eight bytes from every place on
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    rows, step = np.flatnonzero(sizes <= LONG_BYTES), 0
    while len(rows):
        left = sizes[rows] - step
        numbers[rows] = mixed(numbers[rows] ^ (eight[starts[rows] + step] & _TAIL[np.minimum(left, 8)]), 60 + which)
        rows, step = rows[left > 8], step + 8
    for i in np.flatnonzero(sizes > LONG_BYTES):
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, salt=bytes([which])).digest()
        numbers[i] = int.from_bytes(digest, "little")
    return numbers


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Null texts have no words."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[low:high] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - low
    if lower:
        data = _ASCII_LOWER[data]
    n = len(data)
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[cuts]
    stops = np.zeros(n + 1, bool)
    stops[1:-1] = inside[:-1] & ~inside[1:]
    if n:
        stops[n] = inside[-1]
    stops[cuts] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    numbers = _numbers(data, starts, ends)
    return Words(data, starts, ends, numbers, np.searchsorted(starts, offsets))


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
