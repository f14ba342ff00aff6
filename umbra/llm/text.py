"""Vectorised words, hashes and windows over the UTF-8 bytes of an Arrow string column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x5851F42D4C957F2D  # odd and 5 modulo 8, so a power series of full length modulo 2**64
_state = np.random.RandomState(20240229)
BYTE = _state.randint(0, 2**63 - 1, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(kind: str, n: int) -> np.ndarray:
    """BASE**i (up) or BASE**-i (down) modulo 2**64, for i below n or more."""
    have = _powers[kind]
    if len(have) < n:
        step = BASE if kind == "up" else pow(BASE, -1, 2**64)
        with np.errstate(over="ignore"):
            full = np.full(max(n, 1 << 16), U64(step), U64)
            full[0] = 1
            have = _powers[kind] = np.multiply.accumulate(full)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of a string or binary column; a null has no bytes."""
    kind = column.type
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    n, skip = len(column), column.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[skip : skip + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = at[:-1].copy(), at[1:].copy()
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        ends[gone] = starts[gone]
    return raw, starts, ends


def chunks(starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about limit bytes; one longer text is a range of its own."""
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, side="right")))
        yield i, min(j, n)
        i = j


class Words:
    """The words of the texts data[starts[i]:ends[i]], which lie behind one another.

    starts, ends: of each word, in self.data; count: words of each text; first: index of each text's first word.
    """

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False):
        low, high = (int(starts[0]), int(ends[-1])) if len(starts) else (0, 0)
        high = max(high, low)
        self.data = LOWER[raw[low:high]] if lower else raw[low:high]
        self.text_start, self.text_end = starts - low, ends - low
        n = len(self.data)
        inside = np.zeros(n + 2, dtype=bool)
        np.logical_not(SPACE[self.data], out=inside[1:-1])
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.text_start] = True
        cut[self.text_end] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.searchsorted(self.start, self.text_end) - self.first
        self._padded: np.ndarray | None = None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[start:end]."""
        if self._padded is None:
            self._padded = padded(self.data)
        return range_hashes(self._padded, start, end)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def padded(data: np.ndarray) -> np.ndarray:
    """data with eight more bytes, so that eight can be read from any place."""
    return np.concatenate([data, np.zeros(8, np.uint8)])


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 256) -> np.ndarray:
    """64-bit hashes of data[start:end], where data is padded.

    Eight bytes at a time are mixed into the state, so no family of texts collides by its form, as it can in a sum of
    powers modulo 2**64. Ranges of up to eight bytes never collide with one of equal length. A range of more than most
    bytes takes a cryptographic hash.
    """
    size = end - start
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    with np.errstate(over="ignore"):
        out = mix(_eight(eight, start, size) ^ (size.astype(U64) * U64(BASE)))
        left = np.flatnonzero((size > 8) & (size <= most))
        step = 8
        while len(left):
            out[left] = mix(out[left] ^ _eight(eight, start[left] + step, size[left] - step)) + U64(BASE)
            step += 8
            left = left[size[left] > step]
    for k in np.flatnonzero(size > most).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]], digest_size=8).digest(), "little")
    return out


MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _eight(eight: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    return eight[at].view("<u8").reshape(-1) & MASK[np.minimum(size, 8)]


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of width adjacent words, for each start; empty if there are fewer."""
    if len(words) < width:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        total = np.full(len(words) - width + 1, U64(width), U64)
        for k in range(width):
            total = (total + words[k : len(words) - width + 1 + k]) * U64(0x9E3779B97F4A7C15 + 2 * k)
        return mix(total)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(U64, copy=False).view(np.int64)
