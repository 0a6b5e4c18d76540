import math
from collections import Counter

import numpy as np
import pytest

from titlepulse import fixtures as X
from titlepulse.functions.text import ENGLISH_STOP_WORDS
from titlepulse.operators import mining as M
from titlepulse.operators.clean import clean_review


@pytest.fixture(scope="module")
def reviews(spark, sf):
    return clean_review(X.raw_review(spark, sf)).cache()


def test_histogram_matches_numpy(spark, reviews):
    got = M.histogram(reviews, "star", 12).orderBy("bin").collect()
    stars = np.array([r.star for r in reviews.select("star").collect() if r.star is not None], dtype=float)
    counts, edges = np.histogram(stars, bins=12)
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.bin_lo for r in got], edges[:-1]) and math.isclose(got[-1].bin_hi, edges[-1])


def test_box_stats_match_numpy(spark, reviews):
    from titlepulse.functions.labels import sentiment_label
    got = {r.group: r for r in M.box_stats(reviews, "like", sentiment_label("star")).collect()}
    pdf = reviews.select(sentiment_label("star").alias("s"), "like").toPandas().dropna()
    for s, g in pdf.groupby("s"):
        v = g["like"].astype(float).values
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[s]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert r.whisker_lo == v[v >= lo].min() and r.whisker_hi == v[v <= hi].max()
        assert r.n_outliers == int(((v < lo) | (v > hi)).sum())


def test_powerset_itemsets_equal_fpgrowth(spark, reviews):
    b = M.baskets(reviews)
    ps = {tuple(r["items"]): r.freq for r in M.frequent_itemsets(b, 0.1, method="powerset").collect()}
    fp = {tuple(r["items"]): r.freq for r in M.frequent_itemsets(b, 0.1, method="fpgrowth").collect()}
    assert ps == fp and len(ps) > 5


def test_rules_equal_fpgrowth(spark, reviews):
    b = M.baskets(reviews)
    w = M.weighted_baskets(b)
    ours = M.association_rules(M.itemsets_from_weighted(w, 0.1), M.basket_count(w), 0.1)
    theirs = M.fp_growth_rules(b, 0.1, 0.1)

    def key(df):
        return sorted((tuple(r.antecedent), tuple(r.consequent), round(r.confidence, 9),
                       round(r.lift, 9), round(r.support, 9)) for r in df.collect())
    assert key(ours) == key(theirs)


def test_rule_text_shortening(spark):
    df = spark.createDataFrame([(["a" * 30, "b" * 20], ["c"]), (["x"], ["y"])],
                               "antecedent array<string>, consequent array<string>")
    got = {r.rule: r.rule_short for r in M.rule_text(df).collect()}
    long_rule = "a" * 30 + "," + "b" * 20 + " → c"
    assert got[long_rule] == long_rule[:40] + "..." and got["x → y"] == "x → y"


def test_bigrams_match_brute_force(spark, sf):
    import regex
    docs = X.table(spark, sf, "documents").select("text")
    stop = set(ENGLISH_STOP_WORDS)
    pat = regex.compile(M.WORD_RE)
    pairs = Counter()
    for (t,) in docs.collect():
        w = pat.findall((t or "").lower())
        for a, b in zip(w, w[1:]):
            if a not in stop and b not in stop and not a.isdigit() and not b.isdigit():
                pairs[(a, b)] += 1
    got = {(r.w1, r.w2): (r.n, r.g2) for r in M.bigram_counts(docs, "text", ENGLISH_STOP_WORDS).collect()}
    assert {k: v[0] for k, v in got.items()} == dict(pairs)
    n = sum(pairs.values())
    left, right = Counter(), Counter()
    for (a, b), c in pairs.items():
        left[a] += c
        right[b] += c
    (a, b), k11 = pairs.most_common(1)[0]
    k12, k21 = left[a] - k11, right[b] - k11
    k22 = n - k11 - k12 - k21
    cells = [(k11, left[a], right[b]), (k12, left[a], n - right[b]),
             (k21, n - left[a], right[b]), (k22, n - left[a], n - right[b])]
    g2 = 2 * sum(k * math.log(k * n / (r * c)) for k, r, c in cells if k > 0)
    assert got[(a, b)][1] == pytest.approx(g2)


def test_corr_matrix(spark, reviews):
    got = {(r.x, r.y): r.corr for r in M.corr_matrix(reviews, ["star", "like"]).collect()}
    pdf = reviews.select("star", "like").toPandas().astype(float)
    assert got[("star", "like")] == pytest.approx(pdf.corr().loc["star", "like"])
    assert got[("like", "like")] == pytest.approx(1.0)


def test_box_stats_approx_close_to_exact(spark, reviews):
    from titlepulse.functions.labels import sentiment_label
    exact = {r.group: r for r in M.box_stats(reviews, "like", sentiment_label("star")).collect()}
    approx = {r.group: r for r in M.box_stats(reviews, "like", sentiment_label("star"), approx=True).collect()}
    assert exact.keys() == approx.keys()
    for g in exact:
        assert approx[g].n == exact[g].n and approx[g].median >= exact[g].q1 and approx[g].median <= exact[g].q3


def test_scatter_log_bins(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (5, 7), (6, 4), (1000, 1)], "like long, dislike long")
    got = {(r.like, r.dislike): r.n for r in M.scatter_points(df, "like", "dislike", log_bins=True).collect()}
    assert got == {(0, 0): 1, (1, 2): 1, (4, 4): 2, (512, 1): 1}


def test_bigrams_split_a_text_once_and_join_by_hash(spark):
    docs = spark.createDataFrame([("red fox and red fox 12 x9 fox",), (None,), ("a",), ("",)], "text string")
    df = M.bigram_counts(docs, "text", ["and"], materialize=False)
    counts = df._jdf.queryExecution().executedPlan().toString()
    assert counts.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in counts
    assert {(r.w1, r.w2): r.n for r in df.collect()} == {("red", "fox"): 2, ("x9", "fox"): 1}
    for line in counts.splitlines():
        assert line.count("regexp_extract_all") <= 1
