"""Vectorised word splitting and word / shingle hashing over UTF-8 bytes.

A chunk of texts becomes one byte array; word boundaries, 64-bit word hashes
and shingle hashes come from a few numpy passes over it, with no Python loop
per word.  Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A fixed 64-bit value for each byte.
_BYTE = np.array([(i + 1) * 0xD6E8FEB86659FD93 % (1 << 64) ^ (i * i + 7) * 0xA0761D6478BD642F % (1 << 64)
                  for i in range(256)], dtype=U)
_POWERS = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            a = np.full(n, base, U)
            a[0] = 1
            _POWERS[name] = np.cumprod(a, dtype=U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    buf: np.ndarray         # the chunk's bytes (lower-cased if asked for)
    start: np.ndarray       # of each word in buf
    end: np.ndarray
    first: np.ndarray       # of each document its first word; one more entry at the end
    hash: np.ndarray        # uint64 per word

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))


def split_words(texts: list[bytes], lower: bool = False, hashed: bool = True, collapse: bool = False) -> Words:
    """``collapse``: every run of white space becomes one space, so equal word sequences are equal bytes."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    at = np.cumsum([1, *(len(t) + 1 for t in texts)])
    if lower:
        buf = _LOWER[buf]
    white = _WHITE[buf]
    if collapse:
        keep = np.ones(len(buf), bool)
        keep[1:] = ~(white[1:] & white[:-1])
        moved = np.cumsum(keep) - keep
        at = moved[np.minimum(at, len(buf) - 1)]
        buf, white = np.where(white, np.uint8(32), buf)[keep], white[keep]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, at)
    first[-1] = len(start)
    return Words(buf, start, end, first, hash_spans(buf, start, end) if hashed else np.zeros(0, U))


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial over the bytes, shifted to a common origin, mixed with the length."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * up[:-1], out=total[1:], dtype=U)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(0xE7037ED1A0B428DB))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (len(h) - k + 1 of them; the caller masks document ends)."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, U)
    for j in range(k):
        out = (out ^ h[j:j + n]) * U(0x9FB21C651E98DF25)
        out ^= out >> U(29)
    return mix(out)


def whole(h: np.ndarray) -> int:
    """Hash of a whole word sequence."""
    return int(shingles(h, len(h))[0])


def doc_shingles(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each document; a shorter document's whole sequence is its one shingle."""
    every = shingles(w.hash, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(every[a:b - k + 1]))
        elif b > a:
            out.append(np.array([whole(w.hash[a:b])], U))
        else:
            out.append(np.zeros(0, U))
    return out
