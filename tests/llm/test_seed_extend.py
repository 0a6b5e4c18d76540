"""Seed and extend: brute force over words, hot seeds, odd input."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from titlepulse.llm import seed_extend as se


def brute(texts, width):
    """Per text: (words, removed, kept words)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[k: k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {p for k in range(len(w) - width + 1) if seen[tuple(w[k: k + width])] > 1 for p in range(k, k + width)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def run(spark, texts, ids=None, width=6, gram=3):
    ids = list(range(len(texts))) if ids is None else ids
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, row string, odd int")
    got = se.remove_repeated_words(df, width, gram, texts=True).collect()
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got)


def want(texts, ids=None, width=6):
    ids = list(range(len(texts))) if ids is None else ids
    return sorted((repr(i), *b) for i, b in zip(ids, brute(texts, width)))


@pytest.mark.parametrize("vocab,width,gram", [(2, 6, 3), (3, 6, 6), (30, 6, 1), (4, 8, 2)])
def test_brute(spark, vocab, width, gram):
    rnd = random.Random(vocab * width)
    word = lambda: rnd.choice("aBcdefghij") * rnd.randrange(1, 3) if vocab > 4 else "aAbB"[rnd.randrange(vocab)]
    texts = [" ".join(word() for _ in range(rnd.randrange(40))) for _ in range(60)]
    shared = " ".join(word() for _ in range(25))
    texts += [f"{word()} {shared}\t{word()}" for _ in range(10)] + [shared, shared.upper(), shared.replace(" ", " \n ")]
    assert run(spark, texts, width=width, gram=gram) == want(texts, width=width)


def test_hot_seed(spark):
    """A line in a third of the texts, with different neighbours and in copies."""
    rnd = random.Random(3)
    line = "all of these ten words stand in very many texts"
    other = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    texts = [f"{other(9)} {line} {other(9)}" for _ in range(100)] + [f"{other(30)}" for _ in range(150)] + [f"{line} same tail here for all"] * 50
    assert run(spark, texts, width=12, gram=5) == want(texts, width=12)


def test_odd(spark):
    long = " ".join(f"w{k % 4001}x{k % 7}" for k in range(40_000))
    texts = [None, "", "  \n", "one two", long, "x " + long, "a b c d e f g", "a b c d e f g", "a b c d e f h", "same text " * 9, "p q r s t u"]
    ids = [1, 2, 3, None, 4, 5, 6, 6, 6, None, None]
    assert run(spark, texts, ids) == want(texts, ids)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert se.remove_repeated_words(empty).collect() == []


def test_pieces(monkeypatch):
    """Long texts and long words in small pieces give the same words and hashes."""
    text = ("alpha beta " * 50 + "z" * 300 + " \t" + "y" * 90 + " gamma é€ " * 30).encode()
    whole, spans = se.word_hashes(text), se.word_spans(text)
    monkeypatch.setattr(se, "SLAB", 64)
    s, e = se.word_spans(text)
    assert (s == spans[0]).all() and (e == spans[1]).all()
    assert [text[x:y] for x, y in zip(s, e)] == text.split()
    short = e - s <= 64
    assert (se.word_hashes(text)[short] == whole[short]).all()
    words = np.arange(900, dtype=np.uint64) % np.uint64(13)
    monkeypatch.setattr(se, "CHUNK", 50)
    got = np.concatenate([base + lo + np.arange(more + 1) for base, part in se.chunks(words, 6) for _, _, lo, more, _ in [se.anchors(part, 6, 3)]
                          for lo, more in zip(lo, more)])
    assert (got == np.arange(895)).all()
