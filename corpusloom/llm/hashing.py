"""Vectorised 64-bit hashing of words, shingles and substrings (numpy only).

A substring hash is read off prefix sums: ``H[i] = sum(c[j] * B**j for j < i)``
modulo 2**64 with odd ``B``, so ``(H[e] - H[s]) * B**-s`` depends on the bytes
``c[s:e]`` alone.  A multiply-shift finaliser spreads the weak low bits.
"""

from __future__ import annotations

from functools import cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 20

#: Separators of words: space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; tables grow by doubling."""
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _pow = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, BASE, U64)]), dtype=U64)
        _inv = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, _INVERSE, U64)]), dtype=U64)
    return _pow[:n], _inv[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(29)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(32)
    return x


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """H[0..n] of a sequence of small codes (bytes or code points)."""
    n = len(codes)
    out = np.zeros(n + 1, U64)
    np.cumsum((codes.astype(U64) + U64(1)) * powers(n)[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) under the given prefix sums, finalised."""
    inv = powers(len(sums))[1]
    raw = (sums[ends] - sums[starts]) * inv[starts]
    return mix(raw ^ ((ends - starts).astype(U64) * U64(0x9FB21C651E98DF25)))


def segments(data: bytes, size: int = SEGMENT):
    """Pieces of about ``size`` bytes cut before a separator, so no word is split."""
    start, n = 0, len(data)
    while n - start > size:
        tail = np.frombuffer(data, np.uint8, count=n - start - size, offset=start + size)
        cut = -1
        for at in range(0, len(tail), SEGMENT):
            hit = SPACE[tail[at : at + SEGMENT]]
            if hit.any():
                cut = at + int(hit.argmax())
                break
        if cut < 0:
            break
        yield data[start : start + size + cut]
        start += size + cut
    yield data[start:]


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word of the text, A-Z lower-cased; null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    found = []
    for part in segments(data):
        a = np.frombuffer(part, np.uint8)
        word = ~SPACE[a]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
        if len(edge):
            found.append(span_hashes(prefix_sums(a), edge[::2], edge[1::2]))
    return np.concatenate(found) if found else np.empty(0, U64)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams.

    With fewer words than ``width`` the whole sequence is the only shingle;
    without words there is none.
    """
    n = len(words)
    if not n:
        return words
    k = min(n, width)
    out = np.full(n - k + 1, k, U64)
    for j in range(k):
        out = out * U64(0x9E3779B97F4A7C15) + words[j : n - k + 1 + j]
        out ^= out >> U64(31)
    return distinct(mix(out))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


@cache
def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n hash functions."""
    base = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(BASE) + U64(seed))
    return base[:n] | U64(1), base[n:]


def minhash(values: np.ndarray, n: int, seed: int = 7, block: int = 4096) -> np.ndarray:
    """n minimum-hash coordinates (32 bits each) of a non-empty set of hashes."""
    a, b = coefficients(n, seed)
    best = np.full(n, 2**64 - 1, U64)
    for at in range(0, len(values), block):
        part = values[at : at + block, None] * a
        part += b
        np.minimum(best, part.min(axis=0), out=best)
    return (best >> U64(32)).astype(np.uint32)
