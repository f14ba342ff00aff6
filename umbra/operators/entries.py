"""Which of many strings occur in a text: an index of arrays, made once and sent to the tasks.

A string is filed under its first 8, 4, 2 or 1 bytes, whichever it has. All windows of a text are looked up at once in a
table of bits; where one may begin a string, the strings are searched by halves for each length that they have there. It
takes some 100 bytes a string, where an automaton takes thousands.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Packed:
    """Strings in one run of bytes."""

    def __init__(self, values: list[bytes]):
        self.ends = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
        self.data = b"".join(values)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, k: int) -> bytes:
        return self.data[self.ends[k] : self.ends[k + 1]]


def _windows(data: bytes, width: int) -> np.ndarray:
    return np.ndarray((max(len(data) - width + 1, 0),), dtype=f"<u{width}", buffer=data, strides=(1,)).astype(np.uint64)


class Index:
    def __init__(self, values: list[bytes]):
        """values: none of them empty."""
        order = sorted(range(len(values)), key=values.__getitem__)
        self.number = np.array(order, dtype=np.int32)
        self.values = Packed([values[k] for k in order])
        lengths = np.diff(self.values.ends)
        self.classes = []
        widths = 1 << np.minimum(np.log2(np.maximum(lengths, 1)).astype(int), 3)
        for width in (8, 4, 2, 1):
            rows = np.nonzero(widths == width)[0]
            if not len(rows):
                continue
            starts = np.array([int.from_bytes(self.values[k][:width], "little") for k in rows], dtype=np.uint64)
            both = np.unique(np.stack([starts, lengths[rows].astype(np.uint64)], axis=1), axis=0)
            firsts, at = np.unique(both[:, 0], return_index=True)
            power = min(max(int(len(firsts)).bit_length() + 6, 10), 26)
            places = (firsts * _ODD) >> np.uint64(64 - power)
            table = np.zeros(1 << (power - 3), dtype=np.uint8)
            np.bitwise_or.at(table, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
            self.classes.append((width, power, table, firsts, np.append(at, len(both)), both[:, 1].astype(np.int32)))

    def found(self, data: bytes) -> set[int]:
        """The numbers of the values that occur in data."""
        out: set[int] = set()
        for width, power, table, firsts, at, lengths in self.classes:
            if len(data) < width:
                continue
            windows = _windows(data, width)
            places = (windows * _ODD) >> np.uint64(64 - power)
            near = np.nonzero((table[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1)[0]
            if not len(near):
                continue
            of = np.searchsorted(firsts, windows[near])
            of[of == len(firsts)] = 0
            for place, k in zip(near.tolist(), of.tolist()):
                if firsts[k] == windows[place]:
                    for n in lengths[at[k] : at[k + 1]].tolist():
                        if place + n <= len(data):
                            self._add(data[place : place + n], out)
        return out

    def _add(self, value: bytes, out: set[int]) -> None:
        k = bisect_left(self.values, value)
        while k < len(self.values) and self.values[k] == value:
            out.add(int(self.number[k]))
            k += 1


def low(data: bytes) -> bytes:
    """UTF-8 in lower case."""
    return data.lower() if data.isascii() else encoded(data.decode("utf-8", "surrogatepass").lower())


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def index_of(originals: list[str]) -> Index:
    return Index([encoded(o.lower()) for o in originals])


def bytes_of(values: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow array, one at a time."""
    for v in values:
        yield v.as_buffer().to_pybytes() if v.is_valid else None
