"""Elias-Fano sequences over numpy arrays, and files of arrays that are mapped into memory."""

from __future__ import annotations

import json
import mmap
import os
import sys
import uuid

import numpy as np

U64 = np.uint64
ONE = U64(1)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits one after the other, with a spare word at the end."""
    words = np.zeros(len(values) * width // 64 + 2, U64)
    if width:
        at = np.arange(len(values), dtype=U64) * U64(width)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        # No two values share a bit, so adding is the same as setting.
        np.add.at(words, word, values << shift)
        over = shift + U64(width) > U64(64)
        np.add.at(words, word[over] + 1, values[over] >> (U64(64) - shift[over]))
    return words


def _unpacked(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), U64)
    at = index.astype(U64) * U64(width)
    word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
    return (low | high) & U64((1 << width) - 1)


# Place of the k-th set bit of each byte, at 8 * byte + k.
IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for byte in range(256) for k in range(8)], U64)
EACH = U64(0x0101010101010101)
TOPS = U64(0x8080808080808080)


def _kth_bit(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit (from 0) in each word: running counts of all its bytes at once, then a table."""
    k = k.astype(U64)
    n = words - ((words >> ONE) & U64(0x5555555555555555))
    n = (n & U64(0x3333333333333333)) + ((n >> U64(2)) & U64(0x3333333333333333))
    n = ((n + (n >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * EACH
    # The byte: as many as have a running count of k or less.
    shift = np.bitwise_count(((k * EACH) | TOPS) - n & TOPS).astype(U64) << U64(3)
    before = ((n << U64(8)) >> shift) & U64(0xFF)
    byte = (words >> shift) & U64(0xFF)
    return shift + IN_BYTE[((byte << U64(3)) + k - before).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits unary, with counts per word for select."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        self.n, self.width = (int(v) for v in arrays[f"{name}.size"])
        self.low, self.high = arrays[f"{name}.low"], arrays[f"{name}.high"]
        self.ones, self.zeros = arrays[f"{name}.ones"], arrays[f"{name}.zeros"]

    @staticmethod
    def encode(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """Arrays of a sequence, by names that start with ``name``."""
        values = values.astype(U64)
        n = len(values)
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        places = (values >> U64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(places[-1]) if n else 0) // 64 + 2) * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(U64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))[:-1]
        low = _packed(values & U64((1 << width) - 1), width)
        return {
            f"{name}.size": np.array([n, width], np.int64),
            f"{name}.low": low,
            f"{name}.high": high,
            f"{name}.ones": ones,
            f"{name}.zeros": np.arange(len(high), dtype=np.int64) * 64 - ones,
        }

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        bits = self.high[word]
        return word * 64 + _kth_bit(bits if ones else ~bits, k - before[word]).astype(np.int64)

    def get(self, index: np.ndarray) -> np.ndarray:
        high = self._select(index, True) - index
        return (high.astype(U64) << U64(self.width)) | _unpacked(self.low, self.width, index)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each value, -1 where it is not in the sequence (which must then be strictly increasing)."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        h = (x >> U64(self.width)).astype(np.int64)
        possible = h <= self._top()
        h = np.minimum(h, self._top())
        start = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
        end = self._select(h, False) - h
        low = x & U64((1 << self.width) - 1)
        a, b = start.copy(), end.copy()
        while True:  # successor among the values with the same high bits
            live = np.nonzero(a < b)[0]
            if not len(live):
                break
            mid = (a[live] + b[live]) >> 1
            smaller = _unpacked(self.low, self.width, mid) < low[live]
            a[live] = np.where(smaller, mid + 1, a[live])
            b[live] = np.where(smaller, b[live], mid)
        inside = possible & (a < end)
        there = _unpacked(self.low, self.width, np.where(inside, a, 0)) == low
        return np.where(inside & there, a, -1)

    def _top(self) -> int:
        """High bits of the last value."""
        if not hasattr(self, "_last"):
            self._last = int(self.get(np.array([self.n - 1]))[0] >> U64(self.width))
        return self._last


class Successors:
    """For each context a sorted list of ids: monotone pointers, and the ids made monotone by running on."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        self.pointers, self.ids = EliasFano(arrays, f"{name}.pointers"), EliasFano(arrays, f"{name}.ids")

    @staticmethod
    def encode(pointers: np.ndarray, ids: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """pointers: start of each context's list, and the total; ids: sorted within each list."""
        used = np.nonzero(np.diff(pointers))[0]
        last = ids[pointers[used + 1] - 1].astype(np.int64) + 1
        base = np.zeros(len(pointers) - 1, np.int64)
        base[used] = np.concatenate(([0], np.cumsum(last)))[:-1]
        monotone = ids.astype(np.int64) + 1 + np.repeat(base, np.diff(pointers))
        return EliasFano.encode(pointers, f"{name}.pointers") | EliasFano.encode(monotone, f"{name}.ids")

    def start(self, context: np.ndarray) -> np.ndarray:
        return self.pointers.get(context).astype(np.int64)

    def find(self, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each id in the whole, -1 where it is not in its context's list, and where that list starts.

        Equal contexts that stand together are looked up once, and empty lists are not searched.
        """
        found, first = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        if not len(ids) or not self.ids.n:
            return found, first
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        distinct, which = context[new], np.cumsum(new) - 1
        start, end = self.start(distinct), self.start(distinct + 1)
        base = np.where(start > 0, self.ids.get(np.maximum(start - 1, 0)), U64(0))
        first = start[which]
        rows = np.nonzero((end > start)[which])[0]
        at = self.ids.find(base[which[rows]] + ids[rows].astype(U64) + ONE)
        inside = (at >= first[rows]) & (at < end[which[rows]])
        found[rows[inside]] = at[inside]
        return found, first


def save_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write a file of arrays under a name of its own, then put it in place: a task that runs twice does no harm."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for a in arrays.values():
            data = np.ascontiguousarray(a).tobytes()
            out.write(data + b"\0" * (-len(data) % 8))
    os.replace(own, path)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """Arrays of a file, mapped and read as they are touched."""
    # The mapping outlives the file's descriptor, so that thousands of files can be mapped at a time.
    unheld = {"trackfd": False} if sys.version_info >= (3, 13) else {}
    with open(path, "rb") as file:
        whole = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **unheld), np.uint8)
    size = int(whole[:8].view("<u8")[0])
    head = json.loads(whole[8 : 8 + size].tobytes())
    out = {}
    for name, (kind, n, at) in head.items():
        start = 8 + size + at
        out[name] = whole[start : start + n * np.dtype(kind).itemsize].view(kind)
    return out
