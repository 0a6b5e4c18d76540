"""Operator 12: removal of repeated word runs by seed and extend.

A repeat is a window of ``width`` words whose word sequence also starts
anywhere else. Steps:

1. Seeds. Of the word n-grams in each window the one with the smallest hash is
   its anchor, the leftmost of equal ones (winnowing), so equal windows have
   equal anchors at equal places. Neighbouring windows mostly share theirs:
   they make one run, and one row per run leaves the task.
2. Join. Runs are joined on their anchors. An anchor that stands once seeds
   nothing. Of an anchor that stands more often each run is compared as a
   whole first: the hull, all words from its first window to its last. Runs
   with equal hulls match as far as their windows go in both directions.
3. Extend. Runs whose anchor meets others with different hulls are extended
   both ways: every window of the run is its anchor with a left and a right
   arm, and two runs match in a window when both arms are equal. Arms are
   compared by hash through one grouped count, with one representative for
   runs of equal hulls, so a group of any size emits no pairs.
4. Matching windows that follow one another are merged into maximal repeats,
   and the words they cover go.

The work is linear in the words whatever the size of a group: at most one row
per window. Words are compared by 64-bit hashes, windows by two of these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from titlepulse.llm.common import cut, rowed, ship
from titlepulse.llm.winnow import _sliding_min, prefix_sums, span_hash
from titlepulse.llm.words import BLACK, _powers, mix, spans

U = np.uint64
WIDTH = 35
GRAM = 10
#: Bytes hashed at once, words winnowed at once, texts opened at once.
SLAB, CHUNK, HELD = 1 << 20, 1 << 18, 8 << 20
#: Low bits of an anchor's rank hold its place in the chunk.
PLACE = 20


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word, found piece by piece."""
    a = np.frombuffer(raw, np.uint8)
    starts, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at = 0
    while at < len(a):
        to = min(len(a), at + SLAB)
        while to < len(a) and BLACK[a[to]]:  # a piece ends where a word does
            ahead = BLACK[a[to: to + SLAB]]
            to += len(ahead) if ahead.all() else int(ahead.argmin())
        s, e = spans(a[at:to], BLACK)
        starts.append(s + at)
        ends.append(e + at)
        at = to
    return np.concatenate(starts), np.concatenate(ends)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word of a text, case kept."""
    a = np.frombuffer(raw, np.uint8)
    s, e = word_spans(raw)
    out = np.empty(len(s), np.uint64)
    k = 0
    while k < len(s):
        if e[k] - s[k] > SLAB:  # one very long word
            out[k] = U(int.from_bytes(hashlib.blake2b(raw[s[k]: e[k]], digest_size=8).digest(), "little"))
            k += 1
            continue
        z = int(np.searchsorted(e, s[k] + SLAB, "right"))
        out[k:z] = span_hash(prefix_sums(a[s[k]: e[z - 1]]), s[k:z] - s[k], e[k:z] - s[k])
        k = z
    return out


def run_sums(words: np.ndarray, lane: int = 0) -> np.ndarray:
    """Prefix sums whose differences hash runs of words, each lane its own way."""
    p, _ = _powers(1 << max(21, int(len(words) + 1).bit_length()))
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words + U(lane * 0x9E3779B97F4A7C15)) * p[: len(words)], out=out[1:])
    return out


def chunks(words: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text with all but one word of a window in common."""
    for k in range(0, max(0, len(words) - width + 1), CHUNK):
        yield k, words[k: k + CHUNK + width - 1]


def anchors(words: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of one piece: (anchor hash, hull hash, first window,
    number of further windows, anchor's place in the first window)."""
    sums = run_sums(words)
    at = np.arange(len(words) - gram + 1)
    g = span_hash(sums, at, at + gram)
    low = U((1 << PLACE) - 1)
    place = (_sliding_min((g & ~low) | at.astype(np.uint64), width - gram + 1) & low).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    hi = np.concatenate([lo[1:], [len(place)]]) - 1
    p = place[lo]
    hull = mix(span_hash(sums, lo, hi + width) + (p - lo).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return g[p], hull, lo, hi - lo, p - lo


RUN = "g long, hull long, odd boolean, row long, lo long, more int"


def _seeds(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[list[np.ndarray]] = []
            size = 0

            def batch() -> pa.RecordBatch:
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["g", "hull", "odd", "row", "lo", "more"])

            for odd, row, text in zip(b.column("odd").to_pylist(), b.column("row").to_pylist(), b.column("text"), strict=True):
                for base, part in chunks(word_hashes(text.as_buffer().to_pybytes()), width):
                    g, hull, lo, more, _ = anchors(part, width, gram)
                    held.append([g.view(np.int64), hull.view(np.int64), np.full(len(g), odd), np.full(len(g), row, np.int64),
                                 lo + base, more.astype(np.int32)])
                    size += len(g)
                    if size > 1 << 16:
                        yield batch()
                        held, size = [], 0
            if size:
                yield batch()

    return run


def matched_runs(runs: DataFrame) -> DataFrame:
    """Runs that meet another one on their anchor: (odd, row, lo, more, same,
    open). ``same``: the whole run is repeated; ``open``: its windows are to
    be compared one by one, with those of runs that have the same anchor."""
    # Counts are written, so that each join deals both sides anew and may split a hot seed.
    seeds = cut(runs.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("hull").alias("h0"), F.max("hull").alias("h1"))
                .filter("n > 1").select("g", (F.col("h0") != F.col("h1")).alias("several")), "seed-counts")
    met = cut(runs.join(seeds, "g"), "seed-runs")
    own = F.struct("odd", "row", "lo")
    hulls = cut(met.filter("several").groupBy("g", "hull").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("first")), "hulls")
    cols = ["odd", "row", "lo", "more"]
    # A seed with one hull alone: all its runs are equal, nothing is to be extended.
    equal = met.filter("not several").select(*cols, F.lit(True).alias("same"), F.lit(False).alias("open"))
    mixed = met.filter("several").join(hulls, ["g", "hull"]) \
        .select(*cols, (F.col("n") > 1).alias("same"), (F.col("first") == own).alias("open"))
    return equal.unionByName(mixed)


OPENED = ("aside boolean, odd boolean, row long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, body string, "
          "spans array<long>, todo array<long>")
KINDS = pa.schema([("aside", pa.bool_()), ("odd", pa.bool_()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()), ("body", pa.string()),
                   ("spans", pa.list_(pa.int64())), ("todo", pa.list_(pa.int64()))])


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([np.flatnonzero(new)[1:], [len(s)]]) - 1]


def _final(row: dict, raw: bytes, s: np.ndarray, e: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: bool) -> dict:
    """Digest of what is left of a text without words [starts, ends)."""
    gone = np.zeros(len(s) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, ends, -1)
    left = np.cumsum(gone)[:-1] == 0
    kept = b" ".join([raw[x:y] for x, y in zip(s[left].tolist(), e[left].tolist(), strict=True)])
    return row | {"aside": False, "n_words": len(s), "n_removed": int((~left).sum()), "kept_sha256": hashlib.sha256(kept).hexdigest(),
                  "kept": kept.decode() if texts else None}


def _batches(rows: Iterator[tuple[int, dict]]) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    held = 0
    for size, r in rows:
        out.append(r)
        held += size
        if held > HELD:
            yield pa.RecordBatch.from_pylist(out, KINDS)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, KINDS)


def _open(width: int, texts: bool):
    """Finish texts without open runs; the others go aside with these."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        for b in batches:
            for odd, row, doc, text, runs in zip(*(b.column(c).to_pylist() for c in ("odd", "row", "doc_id")), b.column("text"),
                                                 b.column("runs").to_pylist(), strict=True):
                raw, runs = text.as_buffer().to_pybytes(), runs or []
                key = {"odd": odd, "row": row, "doc_id": doc}
                whole = [r for r in runs if r["same"]]
                a, z = merged(np.array([r["lo"] for r in whole], np.int64), np.array([r["lo"] + r["more"] + width for r in whole], np.int64))
                todo = [r for r in runs if r["open"]]
                if todo:
                    yield len(raw), key | {"aside": True, "body": raw.decode(), "spans": np.stack([a, z], 1).ravel().tolist(),
                                           "todo": [x for r in todo for x in (r["lo"], r["lo"] + r["more"])]}
                else:
                    yield (len(raw) if texts else 200), _final(key, raw, *word_spans(raw), a, z, texts)

    return lambda batches: _batches(rows(batches))


def _arms(width: int):
    """One row per window of open runs: the hash of its anchor and both arms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for odd, row, text, todo in zip(b.column("odd").to_pylist(), b.column("row").to_pylist(), b.column("body"),
                                            b.column("todo").to_pylist(), strict=True):
                want = np.unique(np.concatenate([np.arange(lo, hi + 1) for lo, hi in zip(todo[::2], todo[1::2], strict=True)]))
                for base, part in chunks(word_hashes(text.as_buffer().to_pybytes()), width):
                    at = want[(want >= base) & (want < base + CHUNK)] - base
                    if len(at):
                        w, v = (span_hash(run_sums(part, lane), at, at + width).view(np.int64) for lane in (0, 1))
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (w, v, np.full(len(at), odd), np.full(len(at), row, np.int64), at + base)],
                                                         names=["w", "v", "odd", "row", "at"])

    return run


def _finish(width: int, texts: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        for b in batches:
            for odd, row, doc, text, known, places in zip(*(b.column(c).to_pylist() for c in ("odd", "row", "doc_id")), b.column("body"),
                                                          b.column("spans").to_pylist(), b.column("places").to_pylist(), strict=True):
                raw, at = text.as_buffer().to_pybytes(), np.array(places or [], np.int64)
                a, z = merged(np.concatenate([np.array(known[::2], np.int64), at]), np.concatenate([np.array(known[1::2], np.int64), at + width]))
                yield (len(raw) if texts else 200), _final({"odd": odd, "row": row, "doc_id": doc}, raw, *word_spans(raw), a, z, texts)

    return lambda batches: _batches(rows(batches))


def remove_repeated_words(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256, and the kept
    words, joined by one space, where ``texts`` asks for them.

    Words are runs of characters other than space, tab, line feed, vertical
    tab, form feed and carriage return. Defined results: a null text has no
    words, and texts of fewer words than ``width`` keep all; every row is a
    text of its own and comes back, so rows that share a doc_id and rows
    without one are compared too, and repeated rows are repeats of each other;
    a window that overlaps its repeat counts; there are no ties, every copy
    goes; an empty table gives no rows; further columns are not read."""
    if not 1 <= gram <= width or width >= CHUNK:
        raise ValueError("1 <= gram <= width, and windows shorter than a chunk")
    ship(docs.sparkSession)
    rows = rowed(docs)
    runs = cut(rows.select("odd", "row", "text").mapInArrow(_seeds(width, gram), RUN), "seeds")
    found = (matched_runs(runs).groupBy(F.col("odd").alias("o"), F.col("row").alias("r"))
             # A text's own runs: their number is bounded by its length.
             .agg(F.collect_list(F.struct("lo", "more", "same", "open")).alias("runs")))
    opened = cut(rows.join(found, (F.col("odd") == F.col("o")) & (F.col("row") == F.col("r")), "left")
                 .select("odd", "row", "doc_id", "text", "runs").mapInArrow(_open(width, texts), OPENED), "opened")
    aside = opened.filter("aside").select("odd", "row", "doc_id", "body", "spans", "todo")
    arms = cut(aside.mapInArrow(_arms(width), "w long, v long, odd boolean, row long, at long"), "arms")
    again = cut(arms.groupBy("w", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "v"), "matches")
    places = (arms.join(again, ["w", "v"], "left_semi").groupBy(F.col("odd").alias("o"), F.col("row").alias("r"))
              .agg(F.collect_list("at").alias("places")))
    late = aside.join(places, (F.col("odd") == F.col("o")) & (F.col("row") == F.col("r")), "left") \
        .select("odd", "row", "doc_id", "body", "spans", "places").mapInArrow(_finish(width, texts), OPENED)
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])]
    return opened.filter("not aside").select(*cols).unionByName(late.select(*cols))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
win AS (SELECT r, s, array_to_string(w[s:s + 34], ' ') x FROM (SELECT r, w, unnest(range(1, len(w) - 33)) s FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, s FROM win WHERE x IN (SELECT x FROM win GROUP BY x HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) p FROM rep),
word AS (SELECT r, unnest(w) x, unnest(range(1, len(w) + 1)) p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) t FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
n AS (SELECT r, count(*) n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n, 0)::BIGINT n_removed, sha256(coalesce(t, '')) kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
