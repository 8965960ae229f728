"""Elias-Fano coded monotone sequences over numpy arrays.

``encode`` turns a non-decreasing sequence below a universe ``u`` into flat
64-bit words: per value ``l`` low bits, packed, and the high parts in unary (a
one per value, a zero per bucket).  ``View`` answers vectorised queries on the
words in place, so they can lie in a memory-mapped file: ``access`` (select on
the ones) and ``find`` (the range of a bucket by select on the zeros, then the
low bits by bisection), without decoding the sequence.
"""

from __future__ import annotations

HEADER = 6  # words: length, universe, low bits, high bits in words, low words, spare


def _pack(values, bits: int):
    """Consecutive ``bits``-wide fields in little-endian 64-bit words."""
    import numpy as np

    n = len(values)
    out = np.zeros((n * bits + 63) // 64 + 1, np.uint64)
    if bits and n:
        at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # fields that begin in a word are disjoint: their sum is their union
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[starts]] += np.add.reduceat(values << shift, starts)
        over = (shift + np.uint64(bits)) > np.uint64(64)
        out[word[over] + 1] += values[over] >> (np.uint64(64) - shift[over])
    return out


def encode(values, universe: int):
    """Words of the sequence ``values`` (uint64, non-decreasing, < universe)."""
    import numpy as np

    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    low = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
    packed = _pack(v & np.uint64((1 << low) - 1), low)
    high = (v >> np.uint64(low)).astype(np.int64)
    buckets = ((max(universe, 1) - 1) >> low) + 1
    size = (n + buckets + 63) // 64 + 1
    bits = np.zeros(size * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    bits[n + buckets :] = 1  # beyond the last bucket: no further zeros are asked for
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.uint64)
    zeros = np.arange(size + 1, dtype=np.uint64) * np.uint64(64) - ones
    head = np.array([n, universe, low, size, len(packed), buckets], np.uint64)
    return np.concatenate([head, packed, words, ones, zeros])


def _select_in_word(word, k):
    """Position of the ``k``-th (from 0) set bit of each word."""
    import numpy as np

    pos = np.zeros(len(word), np.uint64)
    k = k.astype(np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        s = np.uint64(step)
        count = np.bitwise_count((word >> pos) & np.uint64((1 << step) - 1)).astype(np.uint64)
        beyond = k >= count
        k = np.where(beyond, k - count, k)
        pos = np.where(beyond, pos + s, pos)
    return pos.astype(np.int64)


class View:
    """Queries on the words written by ``encode``, beginning at ``words[0]``."""

    def __init__(self, words):
        import numpy as np

        words = words.view(np.ndarray)  # still the mapped memory, without the subclass's cost per slice
        n, self.universe, low, size, packed, buckets = (int(x) for x in words[:HEADER])
        self.n, self.low, self.buckets = n, low, buckets
        self.packed = words[HEADER : HEADER + packed]
        self.bits = words[HEADER + packed : HEADER + packed + size]
        self.ones = words[HEADER + packed + size : HEADER + packed + 2 * size + 1].view(np.int64)
        self.zeros = words[HEADER + packed + 2 * size + 1 : HEADER + packed + 3 * size + 2].view(np.int64)
        self.words = HEADER + packed + 3 * size + 2
        self._mask = np.uint64((1 << low) - 1)

    def _low(self, i):
        import numpy as np

        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.packed[word] >> shift
        over = (shift + np.uint64(self.low)) > np.uint64(64)
        if over.any():
            out[over] |= self.packed[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & self._mask

    def access(self, i):
        """Values at the positions ``i`` (int64, in range)."""
        import numpy as np

        w = np.searchsorted(self.ones, i, "right") - 1
        at = w * 64 + _select_in_word(self.bits[w], i - self.ones[w])
        return (at - i).astype(np.uint64) << np.uint64(self.low) | self._low(i)

    def _before(self, bucket):
        """Number of values in the buckets below ``bucket``: the place of its
        preceding zero, less the zeros."""
        import numpy as np

        out = np.zeros(len(bucket), np.int64)
        some = np.flatnonzero(bucket > 0)
        if len(some):
            k = bucket[some] - 1  # index of the zero that ends the bucket before
            lo = np.searchsorted(self.zeros, k, "right") - 1
            rest = k - self.zeros[lo]
            out[some] = lo * 64 + _select_in_word(~self.bits[lo], rest) - k
        return out

    def find(self, values):
        """Position of each value, or -1 (values must occur at most once)."""
        import numpy as np

        values = np.ascontiguousarray(values, np.uint64)
        out = np.full(len(values), -1, np.int64)
        ask = np.flatnonzero(values < np.uint64(self.universe)) if self.n else np.zeros(0, np.int64)
        if not len(ask):
            return out
        v = values[ask]
        bucket = (v >> np.uint64(self.low)).astype(np.int64)
        at, end = self._before(bucket), self._before(bucket + 1)
        want = v & self._mask
        # the low bits ascend inside a bucket: the first successor by bisection
        # (a bucket inside a dense stretch can hold thousands of values)
        first, last = at.copy(), end.copy()
        go = np.flatnonzero(first < last)
        while len(go):
            mid = (first[go] + last[go]) >> 1
            less = self._low(mid) < want[go]
            first[go] = np.where(less, mid + 1, first[go])
            last[go] = np.where(less, last[go], mid)
            go = go[first[go] < last[go]]
        some = np.flatnonzero(first < end)
        hit = some[self._low(first[some]) == want[some]]
        out[ask[hit]] = first[hit]
        return out
