"""Operator 13: fill-in-the-middle by in-place block rotation.

A text is cut twice, at code points that a hash of its document draws. The
three sentinels are inserted in one bytearray, ``<P>`` prefix ``<M>`` middle
``<S>`` suffix, and two neighbouring segments of it are exchanged by three
reversals: middle and suffix (psm), or all before the suffix and the suffix
(spm). Restoring finds the sentinels, inverts the rotation by another one and
deletes them, so the exact text comes back from output and form alone.

Every document is worked by itself in Arrow batches: no shuffle, and beside
one text and its copy a task holds blocks of a fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from titlepulse.llm.common import ship

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "1"
#: Of a hundred documents: so many are cut, and of these so many become spm.
CUT_SHARE, SPM_SHARE = 90, 20
BLOCK = 1 << 16
HELD = 8 << 20


class Parts(NamedTuple):
    form: str
    chars: int
    prefix: int | None
    middle: int | None
    out: bytearray


def reverse(buf: np.ndarray, a: int, z: int) -> None:
    """Reverse buf[a:z] in place, block by block from both ends."""
    while z - a > 1:
        k = min(BLOCK, (z - a) // 2)
        left = buf[a: a + k].copy()
        buf[a: a + k] = buf[z - k: z][::-1]
        buf[z - k: z] = left[::-1]
        a, z = a + k, z - k


def rotate(text: bytearray, a: int, mid: int, z: int) -> None:
    """Exchange text[a:mid] and text[mid:z] in place: each reversed, then both."""
    buf = np.frombuffer(text, np.uint8)
    reverse(buf, a, mid)
    reverse(buf, mid, z)
    reverse(buf, a, z)


def leads(raw: bytes, a: int, z: int) -> np.ndarray:
    """Where code points begin in raw[a:z]."""
    return (np.frombuffer(raw, np.uint8, z - a, a) & 0xC0) != 0x80


def count_chars(raw: bytes) -> int:
    return sum(int(leads(raw, k, min(len(raw), k + BLOCK)).sum()) for k in range(0, len(raw), BLOCK))


def scan_cuts(raw: bytes, cuts: tuple[int, int]) -> list[int]:
    """Byte offsets of two code point offsets, in ascending order, in one scan."""
    out: list[int] = []
    seen = 0
    for k in range(0, len(raw), BLOCK):
        at = np.flatnonzero(leads(raw, k, min(len(raw), k + BLOCK)))
        while len(out) < 2 and cuts[len(out)] < seen + len(at):
            out.append(k + int(at[cuts[len(out)] - seen]))
        if len(out) == 2:
            return out
        seen += len(at)
    return out + [len(raw)] * (2 - len(out))


def transform(raw: bytes, doc: str, seed: str = SEED) -> Parts:
    """The transformed text of the document with decimal id ``doc``."""
    digest = hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k: k + 8], 16) for k in (0, 8, 16, 24))
    n = count_chars(raw)
    if not raw or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CUT_SHARE:
        return Parts("plain", n, None, None, bytearray(raw))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = scan_cuts(raw, (a, b))
    buf = bytearray(raw)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    m, s = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < SPM_SHARE else "psm"
    rotate(buf, m if form == "psm" else 0, s, len(buf))
    return Parts(form, n, a, b - a, buf)


def restore(out: bytes | bytearray, form: str) -> bytearray:
    """The text that was transformed, from output and form alone."""
    buf = bytearray(out)
    if form == "plain":
        return buf
    a = buf.find(SUFFIX)
    mid = buf.find(MIDDLE if form == "psm" else PREFIX)
    rotate(buf, a, mid, len(buf))
    s = a + len(buf) - mid
    m = a if form == "psm" else buf.find(MIDDLE)
    for at in (s, m, 0):
        del buf[at: at + len(PREFIX)]
    return buf


SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, "
          "output string, restored string")
KINDS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                   ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("output", pa.string()), ("restored", pa.string())])


def _rows(seed: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[dict] = []
            held = 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                p = transform(raw, "" if doc is None else str(doc), seed)
                back = restore(p.out, p.form)
                out.append({"doc_id": doc, "n": p.chars, "form": p.form, "prefix_chars": p.prefix, "middle_chars": p.middle,
                            "output_sha256": hashlib.sha256(p.out).hexdigest(), "restored_sha256": hashlib.sha256(back).hexdigest(),
                            "output": p.out.decode() if texts else None, "restored": back.decode() if texts else None})
                held += len(raw) if texts else 0
                if held > HELD:
                    yield pa.RecordBatch.from_pylist(out, KINDS)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, KINDS)

    return run


def fill_in_middle(docs: DataFrame, seed: str = SEED, texts: bool = False) -> DataFrame:
    """Per row of docs: doc_id, n (code points), form, prefix_chars,
    middle_chars, output_sha256, restored_sha256, and with ``texts`` the
    transformed and the restored text.

    Defined results: null and empty texts are plain, as are texts that hold a
    sentinel; the two cuts may be equal or lie at an end, parts may be empty;
    rows that share a doc_id are cut by the same hash, each in its own text,
    and all come back; a null doc_id counts as an empty number; an empty table
    gives no rows; further columns are not read."""
    ship(docs.sparkSession)
    got = docs.select("doc_id", "text").mapInArrow(_rows(seed, texts), SCHEMA)
    return got if texts else got.drop("output", "restored")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) h FROM documents),
x AS (SELECT doc_id, t, length(t)::BIGINT n, ('0x' || substr(h, 1, 8))::BIGINT h1, ('0x' || substr(h, 9, 8))::BIGINT h2,
             ('0x' || substr(h, 17, 8))::BIGINT h3, ('0x' || substr(h, 25, 8))::BIGINT h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END form FROM x),
p AS (SELECT *, substr(t, 1, a) p, substr(t, a + 1, b - a) m, substr(t, b + 1) s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END prefix_chars, CASE WHEN form <> 'plain' THEN b - a END middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) output_sha256,
       sha256(t) restored_sha256 FROM p
"""
