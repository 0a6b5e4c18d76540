"""Two-pass partition mining against FP-Growth and brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from titlepulse.operators import mining as M
from titlepulse.operators.itemsets import partition_itemsets


def brute(baskets, least):
    items = sorted({x for b in baskets for x in b})
    out = {}
    for k in range(1, len(items) + 1):
        found = {c: n for c in itertools.combinations(items, k) if (n := sum(set(c) <= b for b in baskets)) >= least}
        if not found:
            break
        out |= found
    return out


@pytest.fixture(scope="module")
def baskets(spark):
    rnd = random.Random(3)
    # A third of all baskets are equal; parts differ, since each leans to some of the items.
    rows = [["a", "b", "c"]] * 100 + [[x for x in "abcdefghijkl" if rnd.random() < (0.8 if (i + ord(x)) % 3 else 0.2)] for i in range(199)] + [[]]
    return rows, spark.createDataFrame([(r,) for r in rows], "items array<string>")


@pytest.mark.parametrize("part", [7, 40, 1000])
@pytest.mark.parametrize("support", [0.1, 0.35])
def test_equals_brute_force_at_any_part_size(baskets, part, support):
    rows, df = baskets
    got = partition_itemsets(M.weighted_baskets(df), support, part=part).collect()
    want = brute([set(r) for r in rows], -(-support * len(rows) // 1))
    assert {tuple(r["items"]): r["freq"] for r in got} == want and len(got) == len(want)


def test_default_for_long_baskets_equals_fp_growth(spark, baskets):
    _, df = baskets
    a = {(tuple(r["items"]), r["freq"]) for r in M.frequent_itemsets(df, 0.2).collect()}
    b = {(tuple(r["items"]), r["freq"]) for r in M.frequent_itemsets(df, 0.2, method="fpgrowth").collect()}
    assert a == b and a


def test_forty_items_in_a_basket(spark):
    rows = [([f"i{k:02d}" for k in range(40) if k % 5 == j % 5 or k == j % 40],) for j in range(200)]
    got = M.frequent_itemsets(spark.createDataFrame(rows, "items array<string>"), 0.2)
    # Every fifth basket holds the same eight items: their 255 subsets, for each of five groups.
    assert got.count() == 5 * 255 and got.agg(F.max(F.size("items"))).first()[0] == 8


def test_nulls_and_no_baskets(spark):
    df = spark.createDataFrame([(["a", None, "a"], 2), ([], 1), ([None], 1)], "items array<string>, w long")
    assert [(r["items"], r["freq"]) for r in partition_itemsets(df, 0.5).collect()] == [(["a"], 2)]
    assert partition_itemsets(df.filter("false"), 0.5).collect() == []
    with pytest.raises(ValueError):
        partition_itemsets(df, 0.0)
