"""Content-chosen suffixes of byte texts (numpy, inside tasks).

Of every ``width`` bytes one suffix is chosen: the place of the smallest hash
of ``gram`` bytes among those that lie in it, the leftmost of equal ones.
Equal strings choose the same place, so equal strings anywhere meet at equal
suffixes. A chosen suffix stands for the run of strings that chose it.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

from titlepulse.llm.words import _powers, mix

U = np.uint64
SLAB = 1 << 20
PLACE = 24


class Chosen(NamedTuple):
    doc: np.ndarray   # which text
    place: np.ndarray  # where the suffix starts in its text
    lo: np.ndarray    # first and last string start that chose it
    hi: np.ndarray
    lead: np.ndarray  # its first 8 bytes as a big-endian number
    gram: np.ndarray  # hash of its first bytes
    hull: np.ndarray  # hash of all bytes of its strings, with their places


@lru_cache(maxsize=1)
def _bytes() -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(0x1234567))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    p, _ = _powers(1 << max(21, int(len(raw) + 1).bit_length()))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_bytes()[raw] * p[: len(raw)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end]."""
    _, q = _powers(1 << max(21, int(len(sums)).bit_length()))
    return mix((sums[end] - sums[start]) * q[start] + (end - start).astype(np.uint64))


def lead8(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a big-endian number, zeros past the end."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        inside = at + k < len(raw)
        out = (out << U(8)) | np.where(inside, raw[np.minimum(at + k, len(raw) - 1)], 0).astype(np.uint64)
    return out


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w values in a row: block-wise running minima."""
    n = len(v) - w + 1
    pad = -len(v) % w
    b = np.concatenate([v, np.full(pad, ~U(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(b, axis=1).ravel()
    back = np.minimum.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1: w - 1 + n])


def _slab(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, width: int, gram: int) -> tuple | None:
    """Chosen suffixes of one slab of texts raw[begins[k]:ends[k]]."""
    if len(raw) < width:
        return None
    sums = prefix_sums(raw)
    starts = np.arange(len(raw) - gram + 1)
    g = span_hash(sums, starts, starts + gram)
    low = U((1 << PLACE) - 1)
    place = (_sliding_min((g & ~low) | starts.astype(np.uint64), width - gram + 1) & low).astype(np.int64)
    counts = np.maximum(0, ends - begins - width + 1)  # strings of each text
    total = counts.sum()
    if not total:
        return None
    doc = np.repeat(np.arange(len(begins)), counts)
    at = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begins, counts)
    sel = place[at]
    first = np.flatnonzero(np.concatenate([[True], (sel[1:] != sel[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.concatenate([first[1:], [total]]) - 1
    p, lo, hi, d = sel[first], at[first], at[last], doc[first]
    hull = mix(span_hash(sums, lo, hi + width) + (p - lo).astype(np.uint64) * U(0xD6E8FEB86659FD93) + (hi - lo).astype(np.uint64))
    return d, p - begins[d], lo - begins[d], hi - begins[d], lead8(raw, p), g[p], hull


def choose(texts: list[bytes], width: int, gram: int) -> Chosen:
    """Chosen suffixes of all texts. A text longer than a slab is worked in
    pieces that overlap by all but one byte of a string, so no string is lost;
    a suffix chosen on both sides of a cut stands there twice, each time for
    its own strings."""
    parts: list[tuple] = []
    group: list[tuple[int, int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            raw = np.frombuffer(b"".join(x for _, _, x in group), np.uint8)
            ends = np.cumsum([len(x) for _, _, x in group])
            got = _slab(raw, np.concatenate([[0], ends[:-1]]), ends, width, gram)
            if got is not None:
                which, base = np.asarray([i for i, _, _ in group]), np.asarray([o for _, o, _ in group])
                d = got[0]
                parts.append((which[d], *(x + base[d] for x in got[1:4]), *got[4:]))
        group, held = [], 0

    for i, t in enumerate(texts):
        for off in range(0, max(1, len(t) - width + 1), SLAB):
            piece = t if len(t) <= SLAB + width - 1 else t[off: off + SLAB + width - 1]
            if held + len(piece) > 2 * SLAB:
                flush()
            group.append((i, off, piece))
            held += len(piece)
            if piece is t:
                break
    flush()
    if not parts:
        e, u = np.empty(0, np.int64), np.empty(0, np.uint64)
        return Chosen(e, e, e, e, u, u, u)
    return Chosen(*(np.concatenate(x) for x in zip(*parts, strict=True)))
