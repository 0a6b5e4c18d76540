"""Fill-in-the-middle: brute force over code points, exact round trips, odd input."""
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from titlepulse.llm import fim


def brute(doc, text):
    """(n, form, prefix_chars, middle_chars, output) by string slices."""
    h = hashlib.sha256(f"1:{doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k: k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.integers(), st.text(st.sampled_from("ab<>PSMé€\U0001f600 \n")))
def test_round_trip(doc, text):
    p = fim.transform(text.encode(), str(doc))
    assert (p.chars, p.form, p.prefix, p.middle, p.out.decode()) == brute(doc, text)
    assert fim.restore(bytes(p.out), p.form).decode() == text


def test_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 5)
    rnd = random.Random(7)
    for doc in range(300):
        text = "".join(rnd.choice("xy<>é\U0001f600") for _ in range(rnd.randrange(80)))
        p = fim.transform(text.encode(), str(doc))
        assert p.out.decode() == brute(doc, text)[4] and fim.restore(p.out, p.form).decode() == text


def test_rotation():
    for a in range(5):
        for m in range(a, 9):
            for z in range(m, 9):
                buf = bytearray(b"012345678")
                fim.rotate(buf, a, m, z)
                assert bytes(buf) == b"012345678"[:a] + b"012345678"[m:z] + b"012345678"[a:m] + b"012345678"[z:]


def test_rows_odd(spark):
    long = "".join(chr(0x20AC + k % 500) for k in range(300_000))
    data = [(1, None), (2, ""), (3, "a <M> b"), (4, long), (5, "é"), (5, "é"), (5, "other"), (None, "no number"), (7, " ")]
    df = spark.createDataFrame([(*r, "x", 3) for r in data], "doc_id long, text string, form string, n int")
    got = fim.fill_in_middle(df, texts=True).collect()
    assert len(got) == len(data)
    want = sorted(repr((d, *brute("" if d is None else d, t or ""), t or "")) for d, t in data)
    assert sorted(repr((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"])) for r in got) == want
    assert all(hashlib.sha256(r["output"].encode()).hexdigest() == r["output_sha256"] for r in got)
    assert fim.fill_in_middle(df.limit(0)).collect() == []
    assert len(fim.fill_in_middle(df).columns) == 7
