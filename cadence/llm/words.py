"""Words and word windows of many texts at once, as flat numpy arrays.

A word is a run of bytes other than space and ``\\x09-\\x0D`` (UTF-8 keeps those
bytes for these characters alone, so the rule holds for bytes as for
characters). Words and windows get 64-bit fingerprints: a polynomial in an odd
base modulo 2**64 over random byte values, from prefix sums, then a mixing step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BLOCK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of ``base`` and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        n = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            steps = np.full(n + 1, _U(b), _U)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=_U))
        _powers[base] = have = (tables[0], tables[1])
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of a run of texts.

    ``data``: bytes of all texts; ``start``/``end``: byte range of each word;
    ``first``: number of the first word of each text, one more entry at the end.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        body = texts.buffers()[2]
        whole = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        self.data = whole[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        inside = ~_SPACE[self.data]
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = offsets[1:-1]
            cut = cut[(cut > 0) & (cut < len(inside))]
            begins[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def fingerprints(self) -> np.ndarray:
        """One 64-bit fingerprint for each word."""
        out = np.zeros(len(self.start), _U)
        w = 0
        while w < len(self.start):
            base = self.start[w]
            stop = max(w + 1, int(np.searchsorted(self.end, base + _BLOCK, "right")))
            length = int(self.end[stop - 1] - base)
            power, inverse = _power_table(_BYTE_BASE, length)
            sums = np.zeros(length + 1, _U)
            np.cumsum(_VALUES[self.data[base:base + length]] * power[:length], out=sums[1:])
            a, b = self.start[w:stop] - base, self.end[w:stop] - base
            out[w:stop] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(_U) * _U(0xA24BAED4963EE407)
            w = stop
        return mixed(out)

    def window_fingerprints(self, words: np.ndarray, width: int) -> np.ndarray:
        """Fingerprint of the ``width`` words from each word on; where a window
        crosses the end of its text the value has no meaning (``window_starts``)."""
        n = len(words)
        out = np.zeros(n, _U)
        for at in range(0, max(0, n - width + 1), _BLOCK):
            k = min(_BLOCK, n - width + 1 - at)
            power, inverse = _power_table(_WORD_BASE, k + width)
            sums = np.zeros(k + width, _U)
            np.cumsum(words[at:at + k + width - 1] * power[:k + width - 1], out=sums[1:])
            out[at:at + k] = (sums[width:width + k] - sums[:k]) * inverse[:k]
        return mixed(out)

    def window_starts(self, width: int) -> np.ndarray:
        """True at each word from which a whole window of its text starts."""
        ok = np.zeros(len(self.start), bool)
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(self.start))
        ok[left >= width] = True
        return ok

    def normal_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """All words joined by one space, and each word's place in that."""
        size = self.end - self.start
        place = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size + 1, out=place[1:])
        out = np.full(int(place[-1]), 0x20, np.uint8)
        at = np.arange(int(size.sum()))
        words = np.repeat(np.arange(len(size)), size)
        within = at - np.repeat(np.cumsum(size) - size, size)
        out[place[words] + within] = self.data[self.start[words] + within]
        return out, place
