"""Sketches built in parts and merged, against numpy and exact counts."""

from collections import Counter

import numpy as np
import pytest

from titlepulse.operators import sketches as S
from titlepulse.plans.catalog import QUERIES


def test_merged_quantiles_within_their_rank_error(spark):
    rng = np.random.default_rng(2)
    # Group a holds most rows and many ties; days differ, so that parts are not alike.
    rows = [("a" if i % 4 else "b", int(i % 9), float(x)) for i, x in enumerate(rng.lognormal(3, 1, 60_000).round(1) + np.arange(60_000) % 9)]
    df = spark.createDataFrame(rows + [("a", 1, None), ("none", 1, None), ("b", 2, float("nan"))], "g string, day int, v double")
    parts = S.quantile_sketches(df, "v", ["g", "day"])
    assert parts.count() == 18
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = S.merged_quantiles(parts, ["g"], probs).collect()
    assert len(got) == 10
    for r in got:
        v = np.sort([x for g, _, x in rows if g == r["g"]])
        low, high = np.searchsorted(v, r["quantile"]) / len(v), np.searchsorted(v, r["quantile"], "right") / len(v)
        assert r["n"] == len(v) and low - r["rank_error"] <= r["p"] <= high + r["rank_error"]
    assert S.merged_quantiles(parts.filter("false"), ["g"], probs).collect() == []


@pytest.mark.parametrize("tracked", [64, 4096])
def test_heavy_hitters_within_their_error(spark, tracked):
    rng = np.random.default_rng(3)
    rows = [("x" if i % 3 else "y", int(i % 5), f"w{min(w, 5000)}") for i, w in enumerate(rng.zipf(1.4, 40_000))]
    df = spark.createDataFrame(rows + [("x", 1, None)], "g string, day int, w string")
    got = S.merged_heavy_hitters(S.frequency_sketches(df, "w", ["g", "day"], tracked), ["g"], 8, tracked).collect()
    for g in "xy":
        exact = Counter(w for k, _, w in rows if k == g)
        mine = {r["item"]: r["freq"] for r in got if r["g"] == g}
        error, total = next((r["error"], r["total"]) for r in got if r["g"] == g)
        assert total == sum(exact.values()) and len(mine) == 8
        assert all(abs(n - exact[w]) <= error for w, n in mine.items())
        assert all(w in mine for w, n in exact.items() if n > min(mine.values()) + error)


def test_queries(spark, sf):
    words = QUERIES["heavy_words"](spark, sf).collect()
    assert words and all(r["freq"] <= r["total"] for r in words)
    quantiles = QUERIES["like_quantiles"](spark, sf).collect()
    assert {r["p"] for r in quantiles} == {0.25, 0.5, 0.75} and all(r["n"] > 0 for r in quantiles)
