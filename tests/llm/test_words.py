"""Word, shingle and suffix helpers against plain Python."""
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from titlepulse.llm import mph
from titlepulse.llm.linear import features
from titlepulse.llm.rtree import RTree, enough
from titlepulse.llm.suffix_dedup import multikey_quicksort
from titlepulse.llm.winnow import choose
from titlepulse.llm.words import ALNUM, BLACK, SLAB, hash_words, shingle_sets

TEXT = st.text(alphabet="aAbB é.\n\t,", max_size=60)


def lower(b: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_equal_words_have_equal_hashes(texts):
    raw = [t.encode() for t in texts]
    for table, pattern in ((BLACK, rb"[^\x20\x09-\x0d]+"), (ALNUM, rb"[0-9A-Za-z\x80-\xff]+")):
        h, at = hash_words(raw, table)
        words = [[lower(w) for w in re.findall(pattern, r)] for r in raw]
        assert np.diff(at).tolist() == [len(w) for w in words]
        flat = [w for ws in words for w in ws]
        assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5), st.integers(1, 4))
def test_shingle_set_sizes(texts, n):
    raw = [t.encode() for t in texts]
    for r, s in zip(raw, shingle_sets(raw, BLACK, n)):
        w = [lower(x) for x in re.findall(rb"[^\x20\x09-\x0d]+", r)]
        want = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
        assert len(s) == len(want)


def test_a_text_longer_than_a_slab_keeps_its_words():
    text = (b"word%d " * (SLAB // 3)) % tuple(range(SLAB // 3))
    assert len(text) > 2 * SLAB
    h, at = hash_words([b"a b", text, b"c"], BLACK)
    assert at.tolist() == [0, 2, 2 + SLAB // 3, 3 + SLAB // 3]
    one, _ = hash_words([b"word77"], BLACK)
    assert h[2 + 77] == one[0] and len(np.unique(h)) == len(h)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 500])
def test_perfect_hash(n):
    ids = np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n)
    nth = np.zeros(n, np.int64)
    seed, moves, marks, rank = mph.build(ids, nth)
    assert len(marks) == n and sorted(rank.tolist()) == list(range(n))
    assert (mph.find(ids, nth, seed, moves, marks, rank) == np.arange(n)).all()
    if n:
        other = np.setdiff1d(np.random.default_rng(9).integers(0, 1 << 62, 3000), ids)
        assert (mph.find(other, np.zeros(len(other), np.int64), seed, moves, marks, rank) == -1).mean() > 0.99


def test_perfect_hash_tells_repeated_ids_apart():
    ids, nth = np.asarray([5, 5, 5]), np.asarray([0, 1, 2])
    seed, moves, marks, rank = mph.build(ids, nth)
    assert mph.find(ids, nth, seed, moves, marks, rank).tolist() == [0, 1, 2]


def test_rtree_loses_no_partner():
    rng = np.random.default_rng(3)
    points = rng.poisson(3, (400, 64)).astype(np.int32)
    points[200:] = np.maximum(0, points[:200] + rng.integers(-1, 2, (200, 64)))
    sizes = points.sum(1)
    tree = RTree(points, sizes)
    for q in range(0, 400, 7):
        want = np.flatnonzero(enough(np.minimum(points, points[q]).sum(1), sizes[q], sizes))
        assert set(want) <= set(tree.query(points[q], int(sizes[q]), 85).tolist())


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    cols = [rng.integers(0, 4, 20000), rng.integers(0, 50, 20000), rng.integers(0, 1 << 60, 20000)]
    cols[0][:15000] = 2  # one lead that most rows share
    got = multikey_quicksort(cols)
    assert [c[got].tolist() for c in cols] == [c[np.lexsort(cols[::-1])].tolist() for c in cols]


def test_every_string_chooses_one_suffix_and_equal_strings_equal_ones():
    rng = np.random.default_rng(5)
    common = rng.integers(97, 101, 300).astype(np.uint8).tobytes()
    texts = [b"", b"x" * 19, b"y" * 500, rng.integers(97, 101, 700).astype(np.uint8).tobytes() + common,
             common + rng.integers(97, 101, 50).astype(np.uint8).tobytes()]
    c = choose(texts, 40, 16)
    for k, t in enumerate(texts):
        mine = c.doc == k
        runs = sorted(zip(c.lo[mine].tolist(), c.hi[mine].tolist()))
        assert [x for a, z in runs for x in range(a, z + 1)] == list(range(max(0, len(t) - 39)))
    where = {}
    for d, p, lo, hi, g in zip(c.doc, c.place, c.lo, c.hi, c.gram):
        for x in range(lo, hi + 1):
            s = texts[d][x:x + 40]
            assert where.setdefault(s, (p - x, g)) == (p - x, g)


def test_features_of_odd_texts():
    flat, at, words = features([b"", b" \n", b"One one two!"])
    assert words.tolist() == [0, 0, 3] and len(at) == 3 and len(flat) - at[2] == 7 + 2
