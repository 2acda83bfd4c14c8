"""Word-shingle hashing shared by the near-duplicate operators (numpy, one batch of texts).

A word is a run of bytes other than space and ``\\x09-\\x0D``; letters A-Z are lower-cased.
A text's shingles are its distinct runs of ``k`` words, or its whole word sequence when it
has fewer; a text without words (or null) has none. Shingles are 64-bit hashes, so two
different shingles are taken for one with probability about ``pairs / 2**64``.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
SIMILARITY_PERCENT = 75

# Odd 64-bit multipliers of the polynomial hashes; any odd numbers would do.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1
_CHUNK_BYTES = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class _Powers:
    """Powers of the byte base and of its inverse, grown to the longest chunk seen."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int):
        if len(cls.up) < n:
            cls.up = _powers(_BYTE_BASE, n)
            cls.down = _powers(pow(_BYTE_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def _chunks(texts: list) -> list[tuple[int, int]]:
    """Runs of texts of about ``_CHUNK_BYTES``; a longer text is a run of its own."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > _CHUNK_BYTES:
            out.append((start, i))
            start, size = i, 0
        size += n
    if start < len(texts):
        out.append((start, len(texts)))
    return out


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and each text's first word's place (n + 1)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    up, down = _Powers.get(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    h = mix64((total[ends] - total[starts]) * down[starts])
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=at[1:])
    return h, np.searchsorted(starts, at + 1)


def shingle_sets(texts: list, k: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text."""
    out: list[np.ndarray] = []
    weights = [np.uint64(pow(_WORD_BASE, k - 1 - i, 1 << 64)) for i in range(k)]
    for lo, hi in _chunks(texts):
        h, first = word_hashes(texts[lo:hi])
        runs = np.zeros(max(len(h) - k + 1, 0), np.uint64)
        for i, w in enumerate(weights):
            runs += h[i: i + len(runs)] * w
        runs = mix64(runs)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                out.append(np.unique(runs[a: b - k + 1]))
            elif b > a:
                # a short text: one shingle, told apart from full ones by its word count
                v = int(b - a)
                for x in h[a:b].tolist():
                    v = (v * _WORD_BASE + x) & _MASK
                out.append(mix64(np.array([v], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def linked(common, n_a, n_b):
    """Whether sets of sizes ``n_a``, ``n_b`` with ``common`` members in both are similar enough."""
    return (common > 0) & (100 * common >= SIMILARITY_PERCENT * (n_a + n_b - common))
