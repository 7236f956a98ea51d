"""Word and byte hashes of many texts at once, in numpy.

A run of bytes b[s:e] hashes to sum(T[b[i]] * P^(i-s)) modulo 2^64, with T a
fixed random table and P odd, then through a finaliser.  One cumulative sum
over a chunk serves every run in it.
"""

from __future__ import annotations

import numpy as np

from sessionbars.llm.common import worker_cache

_P = 0x9E3779B97F4A7C15 | 1
_M = (1 << 64) - 1
#: Items that a pass over all bytes handles at once: its temporaries stay small.
_BLOCK = 1 << 16
#: By how many items the table of powers grows.
_STEP = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of P and of its inverse; only the longest that were asked for are kept."""
    size = (n + 1) // _STEP * _STEP + _STEP
    kept = worker_cache("powers", list)
    if not kept or len(kept[0]) < size:
        kept.clear()
        for base in (_P, pow(_P, -1, 1 << 64)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            kept.append(np.cumprod(a, dtype=np.uint64, out=a))
    return kept[0], kept[1]


def cumulative(buf: np.ndarray) -> np.ndarray:
    """c with c[i] = sum over j < i of T[b[j]] * P^j."""
    t, p = _table(), _powers(len(buf))[0]
    c = np.zeros(len(buf) + 1, np.uint64)
    for lo in range(0, len(buf), _BLOCK):
        part = t[buf[lo : lo + _BLOCK]]
        part *= p[lo : lo + len(part)]
        part[:1] += c[lo : lo + 1]
        np.cumsum(part, dtype=np.uint64, out=c[lo + 1 : lo + 1 + len(part)])
    return c


def run_hashes(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run [start, end) from the cumulative sums."""
    return mix((c[ends] - c[starts]) * _powers(len(c))[1][starts] + (ends - starts).astype(np.uint64))


def window_minima(c: np.ndarray, size: int, span: int) -> np.ndarray:
    """At each place the least hash among ``span`` runs of ``size`` bytes that start one after another from there."""
    q = _powers(len(c))[1]
    out = np.empty(len(c) - size - span + 1, np.uint64)
    for lo in range(0, len(out), _BLOCK):
        hi = min(lo + _BLOCK, len(out)) + span - 1
        least = mix((c[lo + size : hi + size] - c[lo:hi]) * q[lo:hi] + np.uint64(size))
        n = 1
        while 2 * n <= span:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        if n < span:
            least = np.minimum(least[: len(least) - (span - n)], least[span - n :])
        out[lo : lo + len(least)] = least
    return out


class Words:
    """The words of several texts: hashes, byte runs, and the first word of each text."""

    def __init__(self, texts: list[bytes], lower: bool = True, space: np.ndarray = SPACE):
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.translate(LOWER)
        self.buf = np.frombuffer(joined, np.uint8)
        gap = space[self.buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.first = np.searchsorted(self.starts, self.text_at)
        self.c = cumulative(self.buf)
        self.hashes = run_hashes(self.c, self.starts, self.ends)

    def prefixes(self, k: int) -> np.ndarray:
        return run_hashes(self.c, self.starts, np.minimum(self.starts + k, self.ends))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, and their bounds per text.  A text of
    fewer words has its whole sequence as one; a text without words has none."""
    h, first = words.hashes, words.first
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], np.uint64)
    if len(h) >= k:
        m = len(h) - k + 1
        acc = np.full(m, k, np.uint64)
        for j in range(k):
            acc = mix(acc * np.uint64(_P) + h[j : j + m])
        text = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(h)) - first[:-1][text]
        ok = pos[:m] + k <= n[text[:m]]
        out[bounds[text[:m][ok]] + pos[:m][ok]] = acc[ok]
    for i in np.flatnonzero((n > 0) & (n < k)):
        acc = np.full(1, n[i], np.uint64)
        for j in range(first[i], first[i + 1]):
            acc = mix(acc * np.uint64(_P) + h[j : j + 1])
        out[bounds[i]] = acc[0]
    return out, bounds


def distinct_per_text(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, sorted within it, and the new bounds."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[keep], t[keep]
    return h, np.searchsorted(t, np.arange(len(bounds)))
