"""Vectorised word, shingle and character arrays over Arrow text batches.

Every function works on a slice of whole texts: a text is never cut, and a
slice holds about ``SLICE_BYTES`` of text unless one text alone is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, in place."""
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES + 1), np.uint64(base))
        out[0] = 1
        _powers[base] = have = np.multiply.accumulate(out)
    return have[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string array; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if large else np.int32
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, ends


def slices(ends: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) whose texts have at most ``limit`` bytes together, one row at least."""
    lo, n = 0, len(ends) - 1
    while lo < n:
        hi = int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of rows lo..hi: byte spans, 64-bit hashes and each row's range of words."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, lo: int, hi: int, lower: bool = True, hashes: bool = True):
        first = ends[lo]
        self.data = raw[first : ends[hi]]
        self.edges = ends[lo : hi + 1] - first
        size = len(self.data)
        blank = _SPACES[self.data]
        before = np.empty(size, bool)
        after = np.empty(size, bool)
        if size:
            before[1:], before[0] = blank[:-1], True
            after[:-1], after[-1] = blank[1:], True
            inner = self.edges[(self.edges > 0) & (self.edges < size)]
            before[inner] = True
            after[inner - 1] = True
        np.logical_not(blank, out=blank)
        self.starts = np.flatnonzero(before & blank)
        self.stops = np.flatnonzero(after & blank) + 1
        self.bounds = np.searchsorted(self.starts, self.edges)
        self.counts = np.diff(self.bounds)
        if hashes:
            self.hashes = span_hashes(_LOWER[self.data] if lower else self.data, self.starts, self.stops)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:stop] for each span, from prefix sums of a polynomial hash."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    if n:
        np.cumsum(_BYTE_CODES[data] * powers(_BASE, n), out=sums[1:])
    out = (sums[stops] - sums[starts]) * powers(_BASE_INV, n + 1)[starts]
    out += (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of k words (all its words as one run if there are fewer), and their rows.

    The result is sorted by row, then hash, without repeats.
    """
    h, rows = words.hashes, words.rows()
    n = len(h)
    factors = powers(0xA24BAED4963EE407, k + 1)[1:]
    if n >= k:
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += h[j : n - k + 1 + j] * factors[j]
        whole = rows[: n - k + 1] == rows[k - 1 :]
        hashes, owners = mix(total[whole]), rows[: n - k + 1][whole]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        sums = []
        for r in short:
            a, b = words.bounds[r], words.bounds[r + 1]
            sums.append(int(np.sum(h[a:b] * factors[: b - a], dtype=np.uint64)) + 0x1000193 * int(b - a) & 0xFFFFFFFFFFFFFFFF)
        hashes = np.concatenate([hashes, mix(np.array(sums, np.uint64))])
        owners = np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[new], owners[new]
    return hashes, owners


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts, one after another, and each text's edges among them."""
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=edges[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), edges
