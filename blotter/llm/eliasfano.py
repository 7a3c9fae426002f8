"""Elias-Fano sequences and an n-gram trie on them, over flat buffers.

A monotone sequence keeps the low bits of each value packed and the high bits
in unary, about ``2 + log2(universe / n)`` bits a value. All parts are numpy
views of one buffer, so a saved trie is opened by mapping its file; what a
level adds in memory when it is opened is the start of each high-bit bucket.
"""

from __future__ import annotations

import numpy as np


def _pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value, end to end, with 8 spare bytes."""
    out = np.zeros((len(values) * bits + 7) // 8 + 8, np.uint8)
    if bits:
        low = values & np.uint64((1 << bits) - 1)
        spread = np.unpackbits(low.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=bits)
        packed = np.packbits(spread.reshape(-1), bitorder="little")
        out[: len(packed)] = packed
    return out


class EliasFano:
    """A sequence of unsigned numbers in order, equal ones allowed."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        ones = np.unpackbits(high, bitorder="little")
        #: Place of the first value of each bucket of equal high bits: the
        #: ones before the bucket's zero.
        self.bucket = np.concatenate([[0], np.flatnonzero(ones == 0) - np.arange(int((ones == 0).sum()))]).astype(np.int64)
        self.words = np.ndarray((max(1, len(low) - 7),), "<u8", low, strides=(1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, min(56, (top // max(1, n)).bit_length() - 1))
        high = (values >> np.uint64(bits)).astype(np.int64)
        unary = np.zeros(n + (top >> bits) + 1, np.uint8)
        unary[high + np.arange(n)] = 1
        return cls(n, bits, _pack_low(values, bits), np.packbits(unary, bitorder="little"))

    def _low(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.bits
        return (self.words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        high = np.searchsorted(self.bucket, at, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.bits)) | (self._low(at) if self.bits else np.uint64(0))

    def successor(self, x: np.ndarray, begin: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value of ``x`` or more (``n`` if none): from the
        start of its bucket, past the smaller low bits. With ``begin`` and ``stop``
        the search stays between these places (``stop`` if none)."""
        x = np.asarray(x, np.uint64)
        last = len(self.bucket) - 2
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        beyond = high > last
        high = np.minimum(high, max(last, 0))
        at, end = self.bucket[high], self.bucket[np.minimum(high + 1, len(self.bucket) - 1)]
        end = np.minimum(end, self.n)
        if begin is not None:
            at, end = np.clip(at, begin, stop), np.clip(end, begin, stop)
        low = x & np.uint64((1 << self.bits) - 1)
        # Halving within the bucket; a bucket has few values on average.
        width = int((end - at).max(initial=0))
        left, right = at.copy(), end.copy()
        for _ in range(width.bit_length()):
            open_ = left < right
            mid = (left + right) >> 1
            less = open_ & ((self._low(np.minimum(mid, max(self.n - 1, 0))) if self.bits else np.zeros(len(mid), np.uint64)) < low)
            right = np.where(open_ & ~less, mid, right)
            left = np.where(less, mid + 1, left)
        return np.where(beyond, self.n if stop is None else stop, left)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of ``x``, or -1."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at = self.successor(x)
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self[inside] == x), inside, -1)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.int64), self.low, self.high]

    @classmethod
    def from_parts(cls, head: np.ndarray, low: np.ndarray, high: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, high)


class Trie:
    """Bigram trie: contexts, the successors' own numbers, and for each context
    its successors with quantised log10 probabilities.

    ``contexts``: context words' hashes. ``names``: successor words' hashes;
    their places are the numbers of the successors. ``pointers``: where each
    context's successors begin. ``level``: number of the successor plus the
    context's place times the count of names, one monotone sequence; a successor
    is searched between the pointers of its context. ``codes`` are places in
    ``table``."""

    def __init__(self, contexts: EliasFano, names: EliasFano, pointers: EliasFano, level: EliasFano, codes: np.ndarray, table: np.ndarray):
        self.contexts, self.names, self.pointers, self.level = contexts, names, pointers, level
        self.codes, self.table = codes, table

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, log10p: np.ndarray, levels: int = 256) -> Trie:
        """From n-grams sorted by context and word, each once."""
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
        names, number = np.unique(word, return_inverse=True)
        place = np.cumsum(np.r_[False, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
        key = place.astype(np.uint64) * np.uint64(max(1, len(names))) + number.astype(np.uint64)
        lo, hi = (float(log10p.min()), float(log10p.max())) if len(log10p) else (0.0, 0.0)
        step = (hi - lo) / (levels - 1) or 1.0
        codes = np.rint((log10p - lo) / step).astype(np.uint8)
        table = (lo + step * np.arange(levels)).astype(np.float32)
        return cls(
            EliasFano.of(context[first]), EliasFano.of(names), EliasFano.of(np.append(first, len(context)).astype(np.uint64)),
            EliasFano.of(key), codes, table,
        )

    def lookup(
        self, context: np.ndarray, word: np.ndarray, times: np.ndarray | None = None, number: np.ndarray | None = None
    ) -> np.ndarray:
        """log10 probabilities, not a number where the n-gram is not held.

        With ``times`` each context stands for that many n-grams that follow each
        other, with ``number`` each of these names its word by a place in ``word``;
        so contexts and words are looked up once each."""
        c, w = self.contexts.find(context), self.names.find(word)
        if not len(self.codes):
            return np.full(len(context) if times is None else int(times.sum()), np.nan)
        # The successors of a context lie between its pointer and the next one.
        begin, stop = (self.pointers[np.maximum(c, 0) + k].astype(np.int64) for k in (0, 1))
        if times is not None:
            c, begin, stop = (np.repeat(x, times) for x in (c, begin, stop))
        if number is not None:
            w = w[number]
        held = (c >= 0) & (w >= 0)
        key = np.maximum(c, 0).astype(np.uint64) * np.uint64(max(1, self.names.n)) + np.maximum(w, 0).astype(np.uint64)
        at = np.minimum(self.level.successor(key, begin, stop), len(self.codes) - 1)
        held &= (at < stop) & (self.level[at] == key)
        return np.where(held, self.table[self.codes[at]], np.nan)

    def successors(self, context: int) -> np.ndarray:
        """Hashes of the words that follow a context."""
        c = int(self.contexts.find(np.array([context], np.uint64))[0])
        if c < 0:
            return np.zeros(0, np.uint64)
        a, b = self.pointers[np.array([c, c + 1])].astype(np.int64)
        return self.names[(self.level[np.arange(a, b)] - np.uint64(c) * np.uint64(self.names.n)).astype(np.int64)]

    def to_bytes(self) -> bytes:
        """Length and type of each part, then the parts on 8-byte bounds."""
        parts = [p for s in (self.contexts, self.names, self.pointers, self.level) for p in s.parts()] + [self.codes, self.table]
        sizes = np.array([p.nbytes for p in parts], "<i8").tobytes()
        return sizes + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)

    @classmethod
    def from_buffer(cls, buffer) -> Trie:
        """A trie whose parts are views of ``buffer`` (bytes or a mapped file)."""
        kinds = [np.int64, np.uint8, np.uint8] * 4 + [np.uint8, np.float32]
        sizes = np.frombuffer(buffer, "<i8", len(kinds)).tolist()
        parts, at = [], 8 * len(kinds)
        for size, kind in zip(sizes, kinds):
            parts.append(np.frombuffer(buffer, kind, size // np.dtype(kind).itemsize, at))
            at += size + -size % 8
        return cls(*(EliasFano.from_parts(*parts[i : i + 3]) for i in (0, 3, 6, 9)), parts[12], parts[13])
