"""Mergeable summaries with an error bound: quantiles and frequent items.

A sketch table has one row of a fixed size for each combination of keys (a
group and a day, say). It is built by one map-side combined aggregate, can be
written and appended to as data arrives, and is merged for any coarser
grouping without reading the data again; its size grows neither with the rows
nor with the distinct values, as a value histogram does.

Quantiles are KLL sketches (Karnin, Lang, Liberty 2016), frequent items the
counters of Misra and Gries in Spark's approximate top-k aggregates. The bound
of each stands in the result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K = 400
TRACKED = 4096


def rank_error(k: int = KLL_K) -> float:
    """Largest difference of a quantile's rank from the one asked for, as a
    share of the rows, with 99 percent confidence."""
    return 2.296 / k ** 0.9723


def count_error(tracked: int = TRACKED) -> float:
    """Largest error of an item's count, as a share of all rows: counters fill
    three quarters of a table whose size is a power of two."""
    return 3.5 / 2 ** math.ceil(math.log2(tracked / 0.75))


def quantile_sketches(df: DataFrame, value: str, keys: list[str], k: int = KLL_K) -> DataFrame:
    """keys, n, sketch. Nulls and NaN are not counted; groups without a value
    have no row."""
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], probs: list[float], k: int = KLL_K) -> DataFrame:
    """by, p, quantile, n, rank_error from the rows of a sketch table."""
    one = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    at = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return (one.select(*by, "n", F.explode(F.array(*at)).alias("q"))
            .select(*by, "q.p", "q.quantile", "n", F.lit(rank_error(k)).alias("rank_error")))


def frequency_sketches(df: DataFrame, item: str, keys: list[str], tracked: int = TRACKED) -> DataFrame:
    """keys, n, sketch. Null items are not counted."""
    return df.filter(F.col(item).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(`{item}`, {int(tracked)})").alias("sketch"))


def merged_heavy_hitters(sketches: DataFrame, by: list[str], n: int, tracked: int = TRACKED) -> DataFrame:
    """by, item, freq, error, total: the ``n`` most frequent items of each
    group. A count differs from ``freq`` by ``error`` at most, so every item
    more frequent than the last ``freq`` plus ``error`` is among them."""
    one = sketches.groupBy(*by).agg(F.sum("n").alias("total"), F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))
    return (one.select(*by, "total", F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(n)})")).alias("e"))
            .select(*by, F.col("e.item").alias("item"), F.col("e.count").alias("freq"),
                    F.ceil(F.col("total") * F.lit(count_error(tracked))).alias("error"), "total"))
