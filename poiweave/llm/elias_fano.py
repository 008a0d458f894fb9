"""Elias-Fano sequences and an n-gram trie of memory-mapped arrays, queried in batches."""

from __future__ import annotations

import os

import numpy as np

_U = np.uint64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width``-bit numbers end to end in 64-bit words, one spare word at the end."""
    out = np.zeros(len(values) * width // 64 + 2, dtype=_U)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        word, bit = at >> 6, (at & 63).astype(_U)
        np.bitwise_or.at(out, word, values << bit)
        over = bit + _U(width) > _U(64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (_U(64) - bit[over]))
    return out


def _unpack(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), dtype=_U)
    at = index * width
    word, bit = at >> 6, (at & 63).astype(_U)
    low = words[word] >> bit
    high = np.where(bit > 0, words[word + 1] << ((_U(64) - bit) & _U(63)), _U(0))
    return (low | high) & _U((1 << width) - 1)


def _nth_bit(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each 64-bit word, by halves; every word has one."""
    words, k, place = np.array(words), k.astype(np.uint8), np.zeros(len(words), np.uint8)
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(words & _U((1 << half) - 1))
        above = (k >= low).astype(np.uint8)
        k -= low * above
        above *= np.uint8(half)
        place += above
        words >>= above.astype(_U)
    return place


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with a rank directory per word."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values`` are sorted and below ``universe``."""
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(_U)
        top = (values >> _U(width)).astype(np.int64)
        size = n + (universe >> width) + 1
        bits = np.zeros((size + 63) // 64 * 64 + 64, dtype=np.uint8)
        bits[top + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(_U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high))]).astype(np.uint32)
        return cls(n, width, _pack(values & _U((1 << width) - 1), width), high, ones)

    def save(self, path: str) -> None:
        for name in ("low", "high", "ones"):
            getattr(self, name).tofile(f"{path}.{name}")
        np.array([self.n, self.low_bits], np.int64).tofile(f"{path}.head")

    @classmethod
    def load(cls, path: str) -> EliasFano:
        n, width = np.fromfile(f"{path}.head", np.int64)
        of = lambda name, kind: np.memmap(f"{path}.{name}", kind, "r")
        return cls(int(n), int(width), of("low", _U), of("high", _U), of("ones", np.uint32))

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the k-th (from 0) set or clear bit."""
        counts = self.ones.astype(np.int64)
        if zeros:
            counts = np.arange(len(counts)) * 64 - counts
        word = np.searchsorted(counts, k, side="right") - 1
        rest = k - counts[word]
        out = np.empty(len(k), dtype=np.int64)
        for a in range(0, len(k), 1 << 15):
            w = self.high[word[a : a + (1 << 15)]]
            out[a : a + len(w)] = _nth_bit(~w if zeros else w, rest[a : a + len(w)])
        return word * 64 + out

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """Values at the places ``index``."""
        index = np.asarray(index, dtype=np.int64)
        return (self._select(index, False) - index).astype(_U) << _U(self.low_bits) | _unpack(self.low, self.low_bits, index)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """For each x, the place of the first value that is not below it (``n`` if none)."""
        x = np.asarray(x, dtype=_U)
        if not len(x) or not self.n:
            return np.zeros(len(x), dtype=np.int64)
        top = (x >> _U(self.low_bits)).astype(np.int64)
        clear = len(self.high) * 64 - int(self.ones[-1])
        over = top >= clear
        top = np.minimum(top, clear - 1)
        # values with this high part lie between the (top-1)-th and the top-th clear bit
        start = np.where(top > 0, self._select(np.maximum(top - 1, 0), True) - (top - 1), 0)
        end = np.minimum(self._select(top, True) - top, self.n)
        start = np.minimum(start, self.n)
        want, lo, hi = x & _U((1 << self.low_bits) - 1), start, end
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            below = _unpack(self.low, self.low_bits, mid) < want[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
        lo[over] = self.n
        return lo


#: Step of the quantised log10 of a smoothed probability; code 0 means unseen.
STEP = 0.04
DISCOUNT = 0.75


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes 1..255 of probabilities in (0, 1], rounded down: what ``restore`` gives is never above ``p``. Below its range: 0."""
    code = np.ceil(-np.log10(p) / STEP)
    return np.where(code <= 254, code + 1, 0).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) * STEP), 0.0)


class TrieLevel:
    """Contexts of one length and their successors.

    ``pointers`` (Elias-Fano) says where the successors of each context start; ``spent`` is the probability that they have together,
    so that what is left goes to shorter contexts and the whole adds up to one. ``successors`` (Elias-Fano) holds context * words + word,
    so that the words of a context are stored relative to it and found by successor search in its range; ``codes`` are the quantised
    discounted probabilities (count - DISCOUNT) / total of the context. The place of a successor is its number as a context of the next level.
    """

    def __init__(self, words: int, pointers: EliasFano, successors: EliasFano, codes: np.ndarray, spent: np.ndarray):
        self.words, self.pointers, self.successors, self.codes, self.spent = words, pointers, successors, codes, spent

    @classmethod
    def build(cls, totals: np.ndarray, words: int, keys: np.ndarray, counts: np.ndarray, own: np.ndarray | None = None) -> TrieLevel:
        """``totals``: count of each context. ``keys`` = context * words + word, sorted and distinct, with positive ``counts``; they
        may be a part of a context's successors. Those that are not ``own`` are spent elsewhere."""
        contexts = len(totals)
        context = (keys // _U(max(1, words))).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(context, minlength=contexts))])
        codes = quantise((counts - DISCOUNT) / totals[context]) if len(keys) else np.zeros(0, np.uint8)
        spent = np.bincount(context, weights=restore(codes) if own is None else restore(codes) * own, minlength=contexts)
        up = np.where(spent > 0, np.nextafter(spent.astype(np.float32), np.float32(2)), np.float32(0))
        return cls(words, EliasFano.build(starts, len(keys) + 1), EliasFano.build(keys, max(1, contexts * words)), codes, up)

    def save(self, folder: str) -> None:
        os.makedirs(folder)
        self.pointers.save(os.path.join(folder, "pointers"))
        self.successors.save(os.path.join(folder, "successors"))
        np.concatenate([self.codes, [0]]).astype(np.uint8).tofile(os.path.join(folder, "codes"))
        np.concatenate([self.spent, [0]]).astype(np.float32).tofile(os.path.join(folder, "spent"))
        np.array([self.words], np.int64).tofile(os.path.join(folder, "words"))

    @classmethod
    def load(cls, folder: str) -> TrieLevel:
        """Map a saved level."""
        of = lambda name, kind: np.memmap(os.path.join(folder, name), kind, "r")[:-1]
        words = int(np.fromfile(os.path.join(folder, "words"), np.int64)[0])
        return cls(words, EliasFano.load(os.path.join(folder, "pointers")), EliasFano.load(os.path.join(folder, "successors")), of("codes", np.uint8), of("spent", np.float32))

    def successors_of(self, index: np.ndarray) -> np.ndarray:
        """Number of distinct successors of contexts."""
        return (self.pointers[index + 1] - self.pointers[index]).astype(np.int64)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of (context, word) pairs; -1 where unseen."""
        out = np.full(len(context), -1, np.int64)
        if not self.successors.n:
            return out
        for a in range(0, len(context), 1 << 18):
            key = context[a : a + (1 << 18)].astype(_U) * _U(self.words) + word[a : a + (1 << 18)].astype(_U)
            at = self.successors.successor(key)
            inside = np.minimum(at, self.successors.n - 1)
            out[a : a + len(key)] = np.where((at < self.successors.n) & (self.successors[inside] == key), at, -1)
        return out


class NgramTrie:
    """Levels of contexts of one word, of two and so on; a successor at one level is a context of the next."""

    def __init__(self, levels: list[TrieLevel]):
        self.levels = levels

    def save(self, folder: str) -> None:
        for k, level in enumerate(self.levels):
            level.save(os.path.join(folder, str(k)))

    @classmethod
    def load(cls, folder: str) -> NgramTrie:
        """Map the levels of a saved trie."""
        return cls([TrieLevel.load(os.path.join(folder, name)) for name in sorted(os.listdir(folder))])
