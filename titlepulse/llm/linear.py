"""Sparse linear text classifiers shared by operators 5 and 9.

A text's features are the distinct hashes of its words and the bins of a few
shape measures (length, share of marks, share of distinct words, ...), all as
numbers below ``DIM``. Heads are logistic regressions with an L1 penalty,
fitted with accelerated proximal gradient steps on a bounded sample of
labelled rows (``FIT_ROWS``, chosen by the hash of their id). The sample's
features, not its texts, come to the driver; scoring covers every document
inside tasks and carries all its columns through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from titlepulse.llm.common import ship
from titlepulse.llm.words import ALNUM, BLACK, hash_words, spans, text_bytes

DIM = 1 << 18
BINS = 24
SHAPES = 7
#: Labelled rows that a fit reads at most.
FIT_ROWS = 5000
LEAST_DF = 4


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text one after the other, where each
    text's begin, and its number of white-space separated words."""
    n = len(texts)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
    size = np.maximum(1, np.asarray([len(t) for t in texts]))
    h, at = hash_words(texts, ALNUM)
    words = np.diff(at)
    w = np.maximum(1, words)
    doc = np.repeat(np.arange(n), words)
    low = SHAPES * BINS
    word = (h % np.uint64(DIM - low)).astype(np.int64) + low
    distinct = np.unique(doc * DIM + word)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), begin)

    starts = np.zeros(len(raw), bool)
    starts[spans(raw, BLACK)[0]] = True
    black = per_text(starts)
    again = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    shares = [
        per_text(~ALNUM[raw] & BLACK[raw]) / size * 4,
        np.bincount(distinct // DIM, minlength=n) / w,
        again / w,
        per_text((raw >= 48) & (raw <= 57)) / size * 4,
        (per_text(raw == 10) - 1) / w * 4,
        (black - words) / np.maximum(1, black) + 0.5,
    ]
    bins = [np.minimum(BINS - 1, (np.log2(w) * 1.5).astype(np.int64))]
    bins += [(np.clip(x, 0, 1) * (BINS - 1) + 0.5).astype(np.int64) for x in shares]
    shape = (np.arange(n)[:, None] * DIM + np.stack(bins, 1) + np.arange(SHAPES) * BINS).ravel()
    keys = np.sort(np.concatenate([shape, distinct]), kind="stable")
    return keys % DIM, np.searchsorted(keys, np.arange(n) * DIM), black


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            f, at, _ = features(text_bytes(part.column("text")))
            yield pa.RecordBatch.from_pydict({
                "labels": part.column("labels").cast(pa.list_(pa.float64())),
                "f": pa.ListArray.from_arrays(pa.array(np.append(at, len(f)), pa.int32()), pa.array(f, pa.int32()))})


def _fit_head(rows: np.ndarray, cols: np.ndarray, n: int, d: int, y: np.ndarray, l1: float, steps: int) -> tuple[np.ndarray, float]:
    """L1 logistic regression on binary features: FISTA with a fixed step."""
    df = np.bincount(cols, minlength=d)
    scale = 1 / np.sqrt(np.maximum(1, df / n * 40))  # frequent features take smaller steps
    w, v, b, vb, t = np.zeros(d), np.zeros(d), 0.0, 0.0, 1.0
    b = vb = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    rate = 4.0 / max(1.0, float(np.bincount(rows, weights=scale[cols] ** 2, minlength=n).max()))
    begin = np.searchsorted(rows, np.arange(n))
    for _ in range(steps):
        z = np.add.reduceat((v * scale)[cols], begin) + vb
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        step = v - rate * scale * np.bincount(cols, weights=g[rows], minlength=d)
        new = np.sign(step) * np.maximum(0, np.abs(step) - rate * l1)
        nb = vb - rate * 0.1 * g.sum() / max(1, n) * n ** 0.5
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
    return w * scale, b


def fit(labelled: DataFrame, heads: int, rows: int = FIT_ROWS, l1: float = 0.4, steps: int = 150, fetch: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """labelled(doc_id, text, labels array<double> of ``heads`` 0/1 values or
    nulls) -> (weights heads x DIM, intercepts, share of ones). A head is
    fitted on the first ``rows`` rows that have its label, of ``fetch`` (as
    many, if not given) in all. Without such rows its weights and intercept
    are 0 and its share is NaN."""
    spark = labelled.sparkSession
    ship(spark)
    picked = (labelled.select("text", "labels", F.xxhash64("doc_id").alias("h")).orderBy("h", F.xxhash64("text"))
              .limit(fetch or rows).select("text", "labels"))
    got = picked.mapInArrow(_sample_features, "labels array<double>, f array<int>").collect()
    weights, bias, share = np.zeros((heads, DIM), np.float32), np.zeros(heads), np.full(heads, np.nan)
    for k in range(heads):
        own = [x for x in got if x.labels[k] is not None][:rows]
        if not own:
            continue
        y = np.asarray([x.labels[k] for x in own])
        share[k] = (y.sum() + 1) / (len(own) + 2)
        if y.min() == y.max():
            bias[k] = 8.0 if y[0] else -8.0
            continue
        r, c = np.repeat(np.arange(len(own)), [len(x.f) for x in own]), np.concatenate([np.asarray(x.f) for x in own])
        often = np.bincount(c, minlength=DIM) >= min(LEAST_DF, len(own))
        keep = often[c]
        used, cols = np.unique(c[keep], return_inverse=True)
        w, bias[k] = _fit_head(r[keep], cols, len(own), len(used), y, l1, steps)
        weights[k, used] = w
    return weights, bias, share


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def with_scores(docs: DataFrame, weights: np.ndarray, bias: np.ndarray, scores: str, n_words: str,
                then: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """docs with two more columns: the heads' log-odds (or what ``then`` makes
    of a matrix of them) and the number of words, in one pass over the rows.
    The weights have a fixed size, whatever the data."""
    spark = docs.sparkSession
    ship(spark)
    # heads x DIM 4-byte numbers
    model = spark.sparkContext.broadcast((weights.astype(np.float32), bias))
    schema = StructType([*docs.schema.fields, StructField(scores, ArrayType(DoubleType())), StructField(n_words, LongType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b0 = model.value
        for b in batches:
            if not b.num_rows:
                continue
            parts, sizes = [], []
            for k in range(0, b.num_rows, 256):
                f, at, n = features(text_bytes(b.column(place).slice(k, 256)))
                parts.append(np.add.reduceat(w[:, f], at, axis=1).T.astype(float) + b0)
                sizes.append(n)
            z = np.concatenate(parts)
            z = then(z) if then else z
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(list(z), pa.list_(pa.float64())), pa.array(np.concatenate(sizes), pa.int64())],
                names=[*b.schema.names, scores, n_words])

    return docs.mapInArrow(run, schema)



