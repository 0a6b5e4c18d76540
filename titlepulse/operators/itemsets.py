"""Frequent itemsets of long baskets by two-pass partition mining.

An itemset that is frequent in all baskets is frequent, by the same share, in
at least one part of them. Pass one mines each part by itself (depth first
over the rows that hold an item), which gives the candidates with their counts
in the parts that found them. A candidate found everywhere has its count; one
whose other parts cannot lift it to the threshold goes; only the rest are
counted again over all baskets, by an equi-join on their rarest item. No power
set is formed, and a task holds one part of at most about ``PART`` distinct
baskets, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.operators.partitioning import cut_lineage

#: Distinct baskets of a part, on average.
PART = 20_000


def local_itemsets(weighted: DataFrame, min_support: float, parts: int) -> DataFrame:
    """(items, n, part_w): the sets that are frequent in a part, their count in
    it and the part's weight."""
    def mine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        w = np.concatenate([f["w"].to_numpy() for f in held])
        least = min_support * float(w.sum()) * (1 - 1e-12)
        where: dict = {}
        for row, basket in enumerate(b for f in held for b in f["items"]):
            for item in basket:
                where.setdefault(item, []).append(row)
        single = [(x, np.asarray(rows)) for x, rows in sorted(where.items())]
        open_ = [((), [(x, rows) for x, rows in single if w[rows].sum() >= least])]
        found: list = []
        while open_:
            prefix, tails = open_.pop()
            for i, (x, rows) in enumerate(tails):
                found.append((list(prefix) + [x], int(w[rows].sum())))
                shared = [(y, np.intersect1d(rows, other, assume_unique=True)) for y, other in tails[i + 1:]]
                longer = [(y, both) for y, both in shared if len(both) and w[both].sum() >= least]
                if longer:
                    open_.append((prefix + (x,), longer))
            if len(found) > 10_000:
                yield pd.DataFrame(found, columns=["items", "n"]).assign(part_w=int(w.sum()))
                found = []
        yield pd.DataFrame(found, columns=["items", "n"]).assign(part_w=int(w.sum()))

    return weighted.select("items", "w").repartition(parts, "items").mapInPandas(mine, "items array<string>, n long, part_w long")


def exact_counts(candidates: DataFrame, weighted: DataFrame) -> DataFrame:
    """(items, freq) of each candidate over all baskets. Each is looked up under
    its rarest item only; counts are combined before they are shuffled."""
    single = weighted.select(F.explode("items").alias("item"), "w").groupBy("item").agg(F.sum("w").alias("n"))
    rarest = (candidates.select("items", F.explode("items").alias("item")).join(single, "item")
              .groupBy("items").agg(F.min(F.struct("n", "item")).alias("r")).select("items", F.col("r.item").alias("item")))
    held = weighted.select(F.explode("items").alias("item"), F.col("items").alias("basket"), "w")
    return (rarest.join(held, "item").filter(F.forall("items", lambda x: F.array_contains("basket", x)))
            .groupBy("items").agg(F.sum("w").alias("freq")))


def partition_itemsets(weighted: DataFrame, min_support: float, part: int = PART) -> DataFrame:
    """(items sorted, freq) of the sets in at least ceil(min_support * baskets)
    baskets. ``weighted``: distinct baskets (items: array<string>, w), a table
    that may be read several times (``weighted_baskets``).

    Defined results: null items are no items, an item counts once a basket, empty baskets count as baskets,
    no baskets give no rows. ``min_support`` has to be over 0; the result
    itself may be exponential where nearly all baskets share a long set."""
    if not 0 < min_support <= 1:
        raise ValueError("min_support is a share over 0")
    weighted = weighted.select(F.array_distinct(F.array_compact("items")).alias("items"), "w")
    size = weighted.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).first()
    parts = max(1, -(-size["n"] // part))
    least = int(np.ceil(min_support * float(size["w"] or 0)))
    local = cut_lineage(local_itemsets(weighted, min_support, parts), "local_itemsets")
    met = local.groupBy("items").agg(F.sum("n").alias("freq"), F.sum("part_w").alias("seen"))
    # In a part that did not find it a set has less than its share of that part.
    rest = F.lit(float(min_support)) * (F.lit(float(size["w"] or 0)) - F.col("seen"))
    met = met.filter(F.col("freq") + rest > least - 0.5)
    if parts == 1:
        return met.filter(F.col("freq") >= least).select("items", "freq")
    met = cut_lineage(met, "candidates")
    whole = F.col("seen") == F.lit(size["w"])
    counted = exact_counts(met.filter(~whole).select("items"), weighted)
    return met.filter(whole).select("items", "freq").unionByName(counted).filter(F.col("freq") >= least)
