"""Minimal perfect hash over the keys of one shard: hash and displace.

Keys fall into small buckets; each bucket gets the first displacement that
sends all its keys to free slots, and buckets of one key name their slot
directly. n keys use n slots. A 32-bit fingerprint per slot tells a key that
is not in the shard from one that is.
"""

from __future__ import annotations

import numpy as np

from titlepulse.llm.words import mix

U = np.uint64
PER_BUCKET = 4
TRIES = 32


def key_hash(ids: np.ndarray, nth: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of (document id, how many rows with that id came before)."""
    return mix(mix(ids.astype(np.int64).view(np.uint64) + U(seed + 1)) ^ (nth.astype(np.uint64) * U(0x9E3779B97F4A7C15)))


def _parts(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and fingerprint of each key."""
    buckets = U(max(1, -(-n // PER_BUCKET)))
    return (h % buckets).astype(np.int64), (mix(h ^ U(0xD1B54A32D192ED03)) >> U(32)).astype(np.uint32)


def _slot(h: np.ndarray, d, n: int) -> np.ndarray:
    """Slot of each key under displacement d."""
    return (mix(h + np.asarray(d).astype(np.uint64) * U(0x632BE59BD9B4E019)) % U(n)).astype(np.int64)


def build(ids: np.ndarray, nth: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(seed, displacement per bucket, fingerprint per slot, position per slot)."""
    n = len(ids)
    for seed in range(1000):
        h = key_hash(ids, nth, seed)
        if len(np.unique(h)) < n:
            continue
        bucket, mark = _parts(h, n)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        groups = sorted(np.split(order, cuts), key=len, reverse=True) if n else []
        moves = np.zeros(max(1, -(-n // PER_BUCKET)), np.int64)
        taken, slot_of = np.zeros(n, bool), np.zeros(n, np.int64)
        free = None
        for g in groups:
            if len(g) == 1:
                if free is None:
                    free = list(np.flatnonzero(~taken)[::-1])
                at = int(free.pop())
                moves[bucket[g[0]]], slot_of[g[0]] = -at - 1, at
                continue
            for first in range(0, 1 << 17, TRIES):
                tries = _slot(h[g][None, :], np.arange(first, first + TRIES)[:, None], n)
                good = ~taken[tries].any(1)
                if len(g) > 1:
                    good &= (np.diff(np.sort(tries, 1), axis=1) > 0).all(1)
                if good.any():
                    k = int(np.argmax(good))
                    taken[tries[k]], slot_of[g], moves[bucket[g[0]]] = True, tries[k], first + k
                    break
            else:
                break
        else:
            marks, rank = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
            marks[slot_of], rank[slot_of] = mark, np.arange(n)
            return seed, moves, marks, rank
    raise ValueError("no perfect hash found; are the keys distinct?")


def find(ids: np.ndarray, nth: np.ndarray, seed: int, moves: np.ndarray, marks: np.ndarray,
         rank: np.ndarray) -> np.ndarray:
    """Position of each key in the shard, -1 where its fingerprint differs."""
    n = len(marks)
    if not n:
        return np.full(len(ids), -1)
    h = key_hash(ids, nth, seed)
    bucket, mark = _parts(h, n)
    d = moves[bucket]
    slot = np.where(d < 0, -d - 1, _slot(h, np.maximum(d, 0), n))
    return np.where(marks[slot] == mark, rank[slot].astype(np.int64), -1)
