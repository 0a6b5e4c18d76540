"""Operator 6: removal of repeated 200-byte strings by a suffix array.

Not every suffix is sorted: of every 200 bytes one content-chosen suffix is
(see ``winnow``), and equal 200-byte strings always choose equal suffixes. A
chosen suffix stands for the run of strings that chose it; its key is its
leading bytes with a hash of its first 80 bytes, then the hash of all its
strings (hull), then its place. Steps:

1. Suffixes are range-partitioned by key with sampled splitters (Spark's range
   partitioning samples them); the place is part of the key, so equal leads,
   however many, spread over buckets. Each bucket is sorted by multikey
   quicksort and neighbours are compared; first and last runs of buckets are
   compared across boundaries.
2. Equal hulls: all strings of the run are repeated. A suffix that no other
   shares: none is. Else (the ends of passages) its strings become keys of a
   second suffix array, its leading bytes with the hash of its 200 bytes,
   sorted and compared in the same way.
3. Covered bytes are removed. Texts without open strings are finished when
   they are first opened, the others are kept aside until step 2 is done.

Buckets hold what Spark gives one shuffle partition; no run of equal keys is
collected in one task. Equality rests on 64-bit hashes with the lead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from titlepulse.llm.common import cut, keyed, renamed, ship, texts_by_row
from titlepulse.llm.winnow import choose, lead8, prefix_sums, span_hash
from titlepulse.llm.words import text_bytes

U = np.uint64
WIDTH = 200
GRAM = 80
CHUNK = 512
SMALL = 1 << 12


def multikey_quicksort(cols: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several columns: three-way partition on one column,
    the equal part goes on with the next; small parts are sorted directly."""
    order = np.arange(len(cols[0]))
    stack = [(0, len(order), 0)]
    while stack:
        a, z, d = stack.pop()
        if z - a < 2 or d == len(cols):
            continue
        part = order[a:z]
        if z - a <= SMALL:
            order[a:z] = part[np.lexsort([c[part] for c in cols[d:][::-1]])]
            continue
        v = cols[d][part]
        some = np.sort(v[:: max(1, len(v) // 255)])
        pivot = some[len(some) // 2]
        less, more = v < pivot, v > pivot
        x, y = int(less.sum()), int(more.sum())
        order[a:z] = np.concatenate([part[less], part[~(less | more)], part[more]])
        stack += [(a, a + x, d), (a + x, z - y, d + 1), (z - y, z, d)]
    return order


def _key(lead: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Four leading bytes, then 32 bits of a hash: sorts as the bytes do."""
    return (((lead >> U(32)) << U(32)) | (h >> U(32))).view(np.int64) ^ np.int64(-1 << 63)


def _suffixes(width: int, gram: int):
    """Keys of the chosen suffixes: k1, k2 (hull), doc_id, place, and packed
    distances to the first and last string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, CHUNK):
                part = b.slice(k, CHUNK)
                c = choose(text_bytes(part.column("text")), width, gram)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                reach = ((c.place - c.lo) << 20 | (c.hi - c.lo)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    _key(c.lead, c.gram), c.hull.view(np.int64), ids[c.doc].astype(np.int64), c.place.astype(np.int64), reach)],
                    names=["k1", "k2", "doc_id", "place", "reach"])

    return run


BUCKET = ("part int, k1 long, k2 long, doc_id long, place long, reach long, rep boolean, same boolean, lead boolean, "
          "first boolean, last boolean, edge boolean")


def _runs(k: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's run of equal keys, size of each run)."""
    new = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in k])])
    run = np.cumsum(new) - 1
    return run, np.bincount(run)


def _bucket(whole: bool):
    """Sort one bucket, compare neighbours, and keep the rows that share k1
    (with ``whole`` k2 too) with another, or might across the bucket's
    boundary: of these there are four at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        cols = [t.column(c).to_numpy() for c in ("k1", "k2", "doc_id", "place", "reach")]
        order = multikey_quicksort(cols)
        cols = [c[order] for c in cols]
        fresh = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cols])])
        cols = [c[fresh] for c in cols]  # a row that came twice is one place
        n = len(cols[0])
        twin, twins = _runs(cols[:2])
        share, shares = (twin, twins) if whole else _runs(cols[:1])
        same = twins[twin] > 1
        rep = shares[share] > 1
        first = (share == 0) & ~rep | (twin == 0) & ~same
        last = (share == share[-1]) & ~rep | (twin == twin[-1]) & ~same
        # One of each hull stands for it where the run has open strings, or might have.
        open_run = np.bincount(share, weights=~same) > 0
        lead = np.concatenate([[True], twin[1:] != twin[:-1]]) & same & (open_run[share] | (share == 0) | (share == share[-1]))
        edge = np.zeros(n, bool)
        edge[[0, -1]] = True
        keep = rep | first | last | edge
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(keep.sum(), part, np.int32)), *(pa.array(c[keep]) for c in (*cols, rep, same, lead, first, last, edge))],
            names=[c.split()[0] for c in BUCKET.split(", ")])

    return run


def repeats(rows: DataFrame, name: str, whole: bool = False) -> DataFrame:
    """rows(k1, k2, doc_id, place, reach) -> those that share k1 with another
    place, with ``same`` (k2 is shared too) and ``lead``; with ``whole`` only
    those that share both."""
    dealt = rows.repartitionByRange("k1", "k2", "doc_id", "place")
    got = cut(dealt.mapInArrow(_bucket(whole), BUCKET), name)
    # First and last row of each bucket: two rows a bucket, whatever the data.
    edges = got.filter("edge").groupBy("part").agg(F.min(F.struct("k1", "k2")).alias("lo"), F.max(F.struct("k1", "k2")).alias("hi"))
    by = Window.orderBy("part")
    near = edges.select("part", F.lag("hi").over(by).alias("prev"), F.lead("lo").over(by).alias("next"))
    here = F.struct("k1", "k2")
    side = got.filter("first or last").join(near, "part")
    yes = lambda c: F.coalesce(c, F.lit(False))
    side = side.withColumn("rep", F.col("rep") | yes(F.col("first") & (F.col("prev.k1") == F.col("k1"))) | yes(F.col("last") & (F.col("next.k1") == F.col("k1")))) \
        .withColumn("was", F.col("same")) \
        .withColumn("same", F.col("same") | yes(F.col("first") & (F.col("prev") == here)) | yes(F.col("last") & (F.col("next") == here))) \
        .withColumn("lead", F.col("lead") | (F.col("same") & ~F.col("was"))).drop("was", "prev", "next")
    cols = ["k1", "k2", "doc_id", "place", "reach", "same", "lead"]
    return got.filter("rep and not first and not last").select(*cols).unionByName(side.filter("same" if whole else "rep").select(*cols))


def _covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open spans."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, z in spans:
        kept.append(raw[at:a])
        at = z
    kept.append(raw[at:])
    return b"".join(kept)


OPENED = ("aside boolean, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, body binary, "
          "spans array<long>, todo array<long>")
KINDS = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _final(doc: int, raw: bytes, spans: list[tuple[int, int]], texts: bool) -> dict:
    kept = without(raw, spans)
    return {"aside": False, "doc_id": doc, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(spans),
            "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if texts else None}


def _open(width: int, texts: bool):
    """Finish texts without open strings; others go aside with the places of
    these."""
    schema = pa.schema([(c.split()[0], k) for c, k in zip(OPENED.split(", "), KINDS, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[dict] = []
            held = 0
            for doc, text, runs in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("runs").to_pylist(), strict=True):
                raw, runs = text.as_py().encode(), runs or []
                spans = _covered([(r["lo"], r["hi"] + width) for r in runs if r["same"]])
                todo = [r for r in runs if r["open"]]
                if todo:
                    out.append({"aside": True, "doc_id": doc, "body": raw, "spans": [x for s in spans for x in s],
                                "todo": [x for r in todo for x in (r["lo"], r["hi"])]})
                else:
                    out.append(_final(doc, raw, spans, texts))
                held += len(raw)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _strings(width: int):
    """Keys of the open strings of texts that are aside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, todo in zip(b.column("doc_id").to_pylist(), b.column("body"), b.column("todo").to_pylist(), strict=True):
                a = np.frombuffer(text.as_py(), np.uint8)
                at = np.unique(np.concatenate([np.arange(lo, hi + 1) for lo, hi in zip(todo[::2], todo[1::2], strict=True)]))
                h = span_hash(prefix_sums(a), at, at + width)
                for k in range(0, len(at), 1 << 18):
                    x = slice(k, k + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                        lead8(a, at[x]).view(np.int64) ^ np.int64(-1 << 63), h[x].view(np.int64), np.full(len(at[x]), doc, np.int64),
                        at[x].astype(np.int64), np.zeros(len(at[x]), np.int64))], names=["k1", "k2", "doc_id", "place", "reach"])

    return run


def _finish(width: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = KINDS[1:7]
        for b in batches:
            rows = [_final(r["doc_id"], r["body"], _covered([*zip(r["spans"][::2], r["spans"][1::2], strict=True),
                                                            *((p, p + width) for p in r["places"] or [])]), texts) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the
    kept bytes where ``texts`` asks for them.

    Defined results: a null text is empty, and texts shorter than ``width``
    bytes keep all; every row is a text of its own and comes back, so rows
    that share a doc_id and rows without one are compared too, and repeated
    rows are repeats of each other; a string that overlaps its repeat counts;
    there are no ties, every copy is removed; an empty table gives no rows;
    further columns are not read."""
    if width - gram >= 1 << 20 or not 8 <= gram <= width:
        raise ValueError("8 <= gram <= width, and strings of at most a megabyte")
    ship(docs.sparkSession)
    rows, odd = keyed(docs.select("doc_id", "text"))
    docs = texts_by_row(rows)
    keys = "k1 long, k2 long, doc_id long, place long, reach long"
    shared = repeats(docs.mapInArrow(_suffixes(width, gram), keys), "suffixes")
    lo = F.col("place") - F.shiftright("reach", 20)
    run = F.struct(lo.alias("lo"), (lo + F.col("reach").bitwiseAND((1 << 20) - 1)).alias("hi"), "same",
                   (~F.col("same") | F.col("lead")).alias("open"))
    # A text's own runs: their number is bounded by its length.
    runs = shared.groupBy("doc_id").agg(F.collect_list(run).alias("runs")).withColumnRenamed("doc_id", "of")
    opened = cut(docs.join(runs, F.col("doc_id") == F.col("of"), "left").select("doc_id", "text", "runs")
                 .mapInArrow(_open(width, texts), OPENED), "opened")
    aside = opened.filter("aside").select("doc_id", "body", "spans", "todo")
    found = repeats(aside.mapInArrow(_strings(width), keys), "strings", whole=True) \
        .groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("place").alias("places"))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    late = aside.join(found, F.col("doc_id") == F.col("of"), "left").select("doc_id", "body", "spans", "places") \
        .mapInArrow(_finish(width, texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = opened.filter("not aside").select(*cols).unionByName(late)
    return renamed(out if texts else out.drop("kept"), odd)
