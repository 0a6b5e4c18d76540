"""Operator 5: mixing to target weights with soft domain membership.

A classifier fitted on labelled rows gives every document a posterior over
domains. Document rates r >= 0 are fitted so that the expected domain token
totals, the sum of r * tokens * posterior, meet the target shares of all
tokens: nonnegative least squares in the metric of the documents' tokens, by
distributed projected gradient. The gradient of a document is p . d for one
number d per domain, the totals' residual, scaled by the inverse of the k x k
moment matrix, for which a step of 1 always descends. Steps are summed before
the projection (r = max(0, 1 - p . m), m the sum of the steps so far), so the
rates are those nearest to r = 1 of all that meet the targets, no state is
kept per document, and a lost executor costs one pass at most. One step is one
distributed sum of k totals; steps carry momentum, which is dropped (restart)
when it points uphill. If the targets cannot be met, further steps without the
scaling lead to the totals that are nearest to them in plain least squares.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from titlepulse.llm.common import cut, ship
from titlepulse.llm.linear import FIT_ROWS, fit, fresh, with_scores

TOLERANCE = 1e-4
#: Most steps in either scaling; and steps in which the residual has to shrink by a thousandth.
STEPS, PATIENCE = 400, 20
MAX_DOMAINS = 64


def posterior(z: np.ndarray) -> np.ndarray:
    """One-against-rest log-odds to probabilities that sum to 1."""
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30))) + 1e-9
    return p / p.sum(1, keepdims=True)


def rates(p: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Rates of documents with posteriors ``p``."""
    return np.maximum(0.0, 1 - p @ m)


def totals(p: np.ndarray, t: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The k sums of t r p."""
    return (t * rates(p, m)) @ p


def descend(sums: Callable[[np.ndarray], np.ndarray], target: np.ndarray, scale: np.ndarray, m: np.ndarray, near: float) -> tuple[np.ndarray, float]:
    """Steps from ``m`` along the scaled residual until no total is further
    than ``near`` from its target, or the scaled residual stops shrinking.
    Returns the best point met and its largest difference."""
    at, last, speed, gap = m, m, 1.0, np.inf
    best, off, least, since = m, np.inf, np.inf, 0
    for _ in range(STEPS):
        left = sums(at) - target
        gap = np.abs(left).max()
        size = float(left @ scale @ left)
        since = 0 if size < least * 0.999 else since + 1
        if size < least:
            best, off, least = at, gap, size
        if gap <= near:
            return at, float(gap)
        if since >= PATIENCE:
            break
        m = at + scale @ left
        if left @ (m - last) < 0:  # momentum points uphill
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        at, last, speed = m + (speed - 1) / faster * (m - last), m, faster
    return best, float(off)


def solve(sums: Callable[[np.ndarray], np.ndarray], moment: np.ndarray, target: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """sums(m) -> ``totals`` of all documents, whose tokens sum to 1; moment
    is the sum of t p p'. Returns m and the largest difference from ``target``."""
    near = tolerance * max(1e-9, target.max())
    start = np.zeros(len(target))
    m, off = descend(sums, target, np.linalg.pinv(moment, rcond=1e-12, hermitian=True), start, near)
    if off > near:
        m, off = descend(sums, target, np.eye(len(target)) / max(1e-12, np.linalg.eigvalsh(moment)[-1]), m, near)
    return m, off


def fit_rates(members: DataFrame, target: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """members(t, p) -> the m of their rates and the largest difference of a
    domain's share from its target, which is warned of if not within
    ``tolerance`` of the largest target."""
    ship(members.sparkSession)
    k = len(target)
    total = members.agg(F.sum("t").alias("t")).first()["t"] or 0
    if not total:
        return np.zeros(k), 0.0

    def summed(width: int, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            s = np.zeros(width)
            for f in frames:
                if len(f):
                    s += part(np.stack(f["p"].to_numpy()), f["t"].to_numpy() / total)
            yield pd.DataFrame({"d": np.arange(width), "s": s})

        out = np.zeros(width)
        for g in members.mapInPandas(run, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).collect():
            out[g["d"]] = g["s"]
        return out

    moment = summed(k * k, lambda p, t: ((p * t[:, None]).T @ p).ravel()).reshape(k, k)
    m, off = solve(lambda m: summed(k, lambda p, t: totals(p, t, m)), moment, target, tolerance)
    if off > tolerance * max(1e-9, target.max()):
        warnings.warn(f"the fitted rates miss a target share by {off:.2g}, the least that least squares reached", stacklevel=2)
    return m, off


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], fit_rows: int = FIT_ROWS) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns (their names are returned): posteriors in
    the order of sorted ``targets``, number of words, rate. ``labelled`` is
    (doc_id, text, domain); targets are shares of all tokens."""
    if not 1 <= len(targets) <= MAX_DOMAINS:
        raise ValueError(f"1 to {MAX_DOMAINS} domains")
    names = sorted(targets)
    target = np.asarray([targets[d] for d in names], float)
    target = target / target.sum()
    heads = labelled.filter(F.col("domain").isin(names)).select(
        "doc_id", "text", F.array(*[(F.col("domain") == d).cast("double") for d in names]).alias("labels"))
    weights, bias, _ = fit(heads, len(names), fit_rows)
    p, n, rate = fresh(docs, "posterior"), fresh(docs, "n_tokens_mixed"), fresh(docs, "rate")
    members = cut(with_scores(docs, weights, bias, p, n, posterior)
                  .select(F.col(n).cast("double").alias("t"), F.col(p).alias("p")), "members")
    m, _ = fit_rates(members, target)

    def with_rate(z: np.ndarray) -> np.ndarray:
        v = posterior(z)
        return np.column_stack([v, rates(v, m)])

    # Posteriors and rate come from one pass: a task needs one Python worker, not two.
    scored = with_scores(docs, weights, bias, p, n, with_rate)
    return scored.withColumn(rate, F.element_at(p, -1)).withColumn(p, F.slice(p, 1, len(names))), p, n, rate


def soft_mixing(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, p_<domain> ..., rate.

    Defined results: a null text is empty, has no tokens and so no weight,
    and gets the rate of its posterior; repeated rows are rows of their own;
    labelled rows without a domain in ``targets`` are not used; without any,
    posteriors are equal and rates 1 unless the targets are unequal; targets
    that no rates can meet are met as nearly as least squares allow, with a
    warning that names the difference; an empty
    table gives no rows; further columns are not read."""
    out, p, n, rate = mixed(docs.select("doc_id", "text"), labelled, targets, fit_rows)
    return out.select("doc_id", F.col(n).alias("n_tokens"),
                      *[F.col(p)[i].alias(f"p_{d}") for i, d in enumerate(sorted(targets))], F.col(rate).alias("rate"))


def resampled(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its rate says: the
    fraction is settled by the hash of its id and text, so a repeated run
    gives the same rows and the expected count is the rate."""
    out, p, n, rate = mixed(docs, labelled, targets, fit_rows)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = F.floor(F.col(rate) + share).cast("int")
    return out.withColumn(rate, F.explode(F.array_repeat(F.lit(0), copies))).select(*docs.columns)
