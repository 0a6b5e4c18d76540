"""Vectorised word and shingle hashes for whole texts (numpy, inside tasks).

A word's 64-bit hash is a polynomial over random byte values, normalised by
its position and mixed with its length, so all words of a slab are hashed with
a few array operations. Texts are handled in slabs of about a megabyte; a text
longer than that is cut between words, never shortened.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SLAB = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(29))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


def byte_set(chars: bytes, inside: bool) -> np.ndarray:
    """Table of 256 flags: the bytes of ``chars`` are ``inside``, others not."""
    t = np.full(256, not inside)
    t[np.frombuffer(chars, np.uint8)] = inside
    return t


#: words [^\x20\x09-\x0D]+
BLACK = byte_set(b"\x20\x09\x0a\x0b\x0c\x0d", False)
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = byte_set(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]), True)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += U(32)
    return mix(low + U(0x9E3779B97F4A7C15)), low.astype(np.uint8)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15 | 1
    inv = pow(base, -1, 1 << 64)
    p, q = np.full(size, U(base)), np.full(size, U(inv))
    p[0] = q[0] = 1
    return np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)


def spans(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word of a byte array."""
    w = np.zeros(len(raw) + 2, np.int8)
    w[1:-1] = is_word[raw]
    d = np.diff(w)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _slab(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of one slab."""
    s, e = spans(raw, is_word)
    if not len(s):
        return np.empty(0, np.uint64), s
    size = 1 << max(21, int(len(raw) + 1).bit_length())
    p, q = _powers(size)
    value, _ = _tables()
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value[raw] * p[: len(raw)], out=total[1:])
    return mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64) * U(0xD6E8FEB86659FD93)), s


def hash_words(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of all texts, and where each
    text's words begin (len(texts) + 1 numbers)."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    parts: list[np.ndarray] = []
    group: list[bytes] = []
    held = first = 0

    def flush(upto: int) -> None:
        nonlocal group, held, first
        if not group:
            return
        raw = np.frombuffer(b"\n".join(group), np.uint8)
        h, s = _slab(raw, is_word)
        begins = np.cumsum([0] + [len(g) + 1 for g in group])
        bounds[first + 1: upto + 1] = np.diff(np.searchsorted(s, begins))
        parts.append(h)
        group, held, first = [], 0, upto

    for i, t in enumerate(texts):
        if len(t) > SLAB:
            flush(i)
            n, at = 0, 0
            while at < len(t):
                to = min(len(t), at + SLAB)
                while to < len(t) and is_word[t[to]]:
                    to += 1
                h, _ = _slab(np.frombuffer(t, np.uint8, to - at, at), is_word)
                parts.append(h)
                n, at = n + len(h), to
            bounds[i + 1] = n
            first = i + 1
            continue
        if held + len(t) > SLAB:
            flush(i)
        group.append(t)
        held += len(t) + 1
    flush(len(texts))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.cumsum(bounds)


def shingle_sets(texts: list[bytes], is_word: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; with fewer
    words the whole sequence is one shingle, without words there is none."""
    h, at = hash_words(texts, is_word)
    full = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        full = mix(full + h[k: k + len(full)] + U(k + 1))
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(full[a: b - n + 1]))
        else:
            x = np.zeros(min(1, b - a), np.uint64)
            for k in range(b - a):
                x = mix(x + h[a + k: a + k + 1] + U(k + 1))
            out.append(x if b == a else mix(x + U(b - a)))
    return out


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [x.as_py().encode() if x.is_valid else b"" for x in column]
