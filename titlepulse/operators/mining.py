"""Exploratory mining, computed on the cluster as small chart-data tables.

The original pulled whole tables to pandas and drew images; here every chart
is a grouped aggregate whose size is bounded by its bins / labels / distinct
values, never by the number of reviews. Where a step needs a data-wide scalar
(histogram bounds, number of bigrams, number of baskets) it is a scalar
subquery of the same plan (``DataFrame.scalar()``), not a driver round trip.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions.labels import sentiment_label
from titlepulse.operators.itemsets import partition_itemsets
from titlepulse.operators.partitioning import cut_lineage
from titlepulse.schemas import DISLIKE_HIGH_OVER, LIKE_HIGH_OVER

#: Longest basket whose power set is formed.
POWERSET_ITEMS = 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ M1 histogram
def histogram(df: DataFrame, col: str, bins: int = 12) -> DataFrame:
    """Equal-width bins from min to max (last bin closed), nulls skipped,
    empty bins reported as 0. Same edges as numpy's ``histogram``; a constant
    column gets the range (v - 0.5, v + 0.5). The bounds are scalar
    subqueries of the same plan, not a separate action."""
    x = F.col(col).cast("double")
    mn = df.agg(F.min(x)).scalar()
    mx = df.agg(F.max(x)).scalar()
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    nb = F.lit(float(bins))
    idx = F.least(F.floor(((x - lo) * nb) / (hi - lo)), F.lit(bins - 1))
    counts = df.filter(x.isNotNull()).groupBy(idx.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    b = F.col("id")
    edges = df.sparkSession.range(bins).select(
        b.alias("bin"), (lo + b * (hi - lo) / nb).alias("bin_lo"),
        F.when(b == bins - 1, hi).otherwise(lo + (b + 1) * (hi - lo) / nb).alias("bin_hi"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n")))


# --------------------------------------------------------- M2 / W3 distribution
def value_counts(df: DataFrame, col, name: str = "value") -> DataFrame:
    """Frequency of each value, most frequent first (ties by value)."""
    out = df.groupBy(_c(col).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), F.asc(name))


def sentiment_distribution(review: DataFrame) -> DataFrame:
    return value_counts(review, sentiment_label("star"), "sentiment")


# ------------------------------------------------------------------ M3 scatter
def scatter_points(df: DataFrame, x: str, y: str, log_bins: bool = False) -> DataFrame:
    """Point counts by (x, y): a scatter drawn from at most #distinct pairs rows.

    ``log_bins=True`` replaces each value v >= 0 by the lower edge of its
    power-of-two bin (0, 1, 2, 4, 8, ...), so the point count stays small
    however many distinct values there are."""
    pts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    if log_bins:
        def edge(c):
            v = F.col(c).cast("double")
            return F.when(v < 1, F.floor(v)).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(v)))).cast("bigint")
        pts = pts.select(edge(x).alias(x), edge(y).alias(y))
    return pts.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ M4 box plot
def box_stats(df: DataFrame, value: str, by, approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Quartiles (linear interpolation), whiskers at the outermost points within
    1.5 IQR of the box, and the number of outliers, per group.

    Exact ``percentile`` keeps a count per distinct value of the group
    (partial aggregation, so bounded by the value domain, not by the rows);
    ``approx=True`` uses ``percentile_approx`` (a fixed-size sketch, relative
    rank error 1/accuracy) for value domains that are not bounded. The fences
    (one row per group) are joined to the value histogram, not to the rows.
    """
    v = F.col(value).cast("double")
    g = _c(by).alias("group") if not isinstance(by, str) else F.col(by).alias("group")
    rows = df.select(g, v.alias("v")).filter(F.col("v").isNotNull())
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    # The value histogram is written: quartiles and whiskers both come from it.
    rows = cut_lineage(rows.groupBy("group", "v").agg(F.count(F.lit(1)).alias("c")), "box_histogram")
    quart = (F.percentile_approx("v", probs, accuracy) if approx else F.percentile("v", probs, F.col("c")))
    source = df.select(g, v.alias("v")).filter(F.col("v").isNotNull()) if approx else rows
    q = source.groupBy("group").agg(quart.alias("q"), (F.count(F.lit(1)) if approx else F.sum("c")).alias("n"))
    q = q.select("group", "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    fences = q.select("*", (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    inside = (F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))
    return (rows.join(fences, "group")
            .groupBy("group", "n", "q1", "median", "q3")
            .agg(F.min(F.when(F.col("v") >= F.col("_lo"), F.col("v"))).alias("whisker_lo"),
                 F.max(F.when(F.col("v") <= F.col("_hi"), F.col("v"))).alias("whisker_hi"),
                 F.sum(F.when(inside, 0).otherwise(F.col("c"))).cast("bigint").alias("n_outliers")))


# ------------------------------------------------------------ M6 correlations
def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form (x, y, corr),
    all pairs from one aggregation pass."""
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
            for a, b in pairs]
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"),
                                           F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]))
    return wide.select(stacked.alias("_p")).select("_p.*")


# ------------------------------------------------------------------ M7 baskets
def baskets(review: DataFrame) -> DataFrame:
    """[sentiment, star as text, like_high|like_low, dislike_high|dislike_low];
    a null star leaves its slot out."""
    items = F.array(sentiment_label("star"), F.col("star").cast("string"),
                    F.when(F.col("like") > LIKE_HIGH_OVER, "like_high").otherwise("like_low"),
                    F.when(F.col("dislike") > DISLIKE_HIGH_OVER, "dislike_high").otherwise("dislike_low"))
    return review.select(F.array_compact(items).alias("items"))


# ------------------------------------------------ M8 / M9 itemsets and rules
def weighted_baskets(basket_df: DataFrame, items: str = "items", materialize: bool = True) -> DataFrame:
    """Distinct baskets (items sorted) with their multiplicity ``w``.

    The reduction is map-side combined, and its result is bounded by the
    number of distinct baskets, not of reviews; ``materialize`` writes it to
    the shared folder so the itemset, count and rule branches read that small
    table instead of each rescanning the reviews."""
    w = (basket_df.select(F.array_sort(F.array_distinct(F.col(items))).alias("items"))
         .groupBy("items").agg(F.count(F.lit(1)).alias("w")))
    return cut_lineage(w, "baskets") if materialize and not w.isStreaming else w


def itemsets_from_weighted(w: DataFrame, min_support: float) -> DataFrame:
    """Every non-empty subset of each distinct basket, weighted, counted, and
    kept when its frequency >= ceil(min_support * #baskets) (FP-Growth's rule,
    same double arithmetic)."""
    min_count = F.ceil(F.lit(float(min_support)) * w.agg(F.sum("w").cast("double")).scalar())
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size("items")).cast("int") - 1)
    subsets = w.select("items", "w", F.explode(masks).alias("m")).select(
        F.filter("items", lambda x, i: F.col("m").bitwiseAND(F.pow(F.lit(2), i).cast("int")) != 0)
        .alias("items"),
        "w")
    return (subsets.groupBy("items").agg(F.sum("w").alias("freq"))
            .filter(F.col("freq") >= min_count))


def frequent_itemsets(basket_df: DataFrame, min_support: float, items: str = "items",
                      method: str = "auto") -> DataFrame:
    """Itemsets with frequency >= ceil(min_support * #baskets): (items sorted, freq).

    ``powerset``: exact counting over the power set of each distinct basket.
    ``partitions``: two-pass partition mining, exact, for long baskets.
    ``fpgrowth``: Spark ML's parallel FP-Growth.
    ``auto`` (default): ``powerset`` while no basket has more than
    ``POWERSET_ITEMS`` items, else ``partitions``; both give the same rows.
    """
    if method == "fpgrowth":
        model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=1.0).fit(
            basket_df.select(F.array_distinct(F.col(items)).alias(items)))
        return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    w = weighted_baskets(basket_df, items)
    if method == "auto":
        longest = w.agg(F.max(F.size("items"))).first()[0] or 0
        method = "powerset" if longest <= POWERSET_ITEMS else "partitions"
    return itemsets_from_weighted(w, min_support) if method == "powerset" else partition_itemsets(w, min_support)


def association_rules(itemsets: DataFrame, n_baskets, min_confidence: float) -> DataFrame:
    """Rules X -> {c} from frequent itemsets: confidence, lift, support.

    For every itemset of two or more items and every item c in it, the
    antecedent is the itemset without c; both the antecedent and {c} are
    frequent (downward closure), so plain equi-joins on the itemset find them.
    ``n_baskets`` is a number or a scalar column (``basket_count``).
    """
    nb = F.lit(float(n_baskets)) if isinstance(n_baskets, (int, float)) else n_baskets.cast("double")
    big = itemsets.filter(F.size("items") >= 2)
    sides = big.select("items", "freq", F.explode("items").alias("c")).select(
        F.array_remove("items", F.col("c")).alias("antecedent"), F.col("c").alias("consequent"),
        F.col("freq").alias("f_all"))
    ante = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("f_ante"))
    cons = itemsets.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("consequent"), F.col("freq").alias("f_cons"))
    conf = F.col("f_all") / F.col("f_ante")
    return (sides.join(ante, "antecedent").join(cons, "consequent")
            .select("antecedent", F.array("consequent").alias("consequent"),
                    conf.alias("confidence"),
                    (conf / (F.col("f_cons") / nb)).alias("lift"),
                    (F.col("f_all") / nb).alias("support"))
            .filter(F.col("confidence") >= min_confidence))


def fp_growth_rules(basket_df: DataFrame, min_support: float, min_confidence: float,
                    items: str = "items") -> DataFrame:
    """The same rules straight from Spark ML's FP-Growth (for long baskets and
    as a cross-check)."""
    model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence).fit(
        basket_df.select(F.array_distinct(F.col(items)).alias(items)))
    return model.associationRules.select(F.array_sort("antecedent").alias("antecedent"),
                                         "consequent", "confidence", "lift", "support")


def basket_count(weighted: DataFrame) -> Column:
    """Number of baskets (sum of the weights) as a scalar-subquery column."""
    return weighted.agg(F.sum("w")).scalar()


# ------------------------------------------------------------ M10 / M11 text
def rule_text(rules: DataFrame, max_len: int = 40) -> DataFrame:
    """``a,b → c`` and its shortened form (first 40 characters + ``...``)."""
    rule = F.concat(F.array_join("antecedent", ","), F.lit(" → "), F.array_join("consequent", ","))
    short = F.when(F.length(rule) > max_len, F.concat(F.left(rule, F.lit(max_len)), F.lit("...")))
    return rules.select("*", rule.alias("rule"), F.coalesce(short, rule).alias("rule_short"))


# ------------------------------------------------------------ M5 words
# Token rule (documented, not the drawing library's): lower-case, runs of
# letters / digits / underscore / apostrophe of two or more characters that
# start with a letter, digit or underscore; stop words and all-digit tokens
# are dropped.
WORD_RE = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"
DIGITS_RE = r"^\p{N}+$"


def words(df: DataFrame, text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD_RE), 0)


def _kept(w: Column, stop: list[str]) -> Column:
    return ~w.isin(stop) & ~w.rlike(DIGITS_RE)


def word_counts(df: DataFrame, text: str, stop: list[str]) -> DataFrame:
    w = F.col("word")
    return (df.select(F.explode(words(df, text)).alias("word")).filter(_kept(w, stop))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def bigram_counts(df: DataFrame, text: str, stop: list[str], materialize: bool = True) -> DataFrame:
    """Adjacent word pairs (neither a stop word nor digits), with their count and
    Dunning's log-likelihood ratio G^2 against independence (Dunning 1993).

    The pair counts are written to the shared folder, so the corpus is read
    once; ``materialize=False`` computes them for each use. The marginals are
    grouped sums of the pair counts (combined map-side) that are joined back,
    where Spark may split a word with very many partners."""
    # One column for the words, so that a text is split once; one look at a word for both of its pairs.
    t = df.select(F.transform(words(df, text), lambda w: F.when(_kept(w, stop), w)).alias("t"))
    nxt = F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))
    pairs = (t.select(F.explode(F.arrays_zip(F.col("t").alias("w1"), nxt.alias("w2"))).alias("p"))
             .select("p.w1", "p.w2")
             .filter(F.col("w1").isNotNull() & F.col("w2").isNotNull()))
    counts = pairs.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))
    if materialize and not counts.isStreaming:
        counts = cut_lineage(counts, "bigram_counts")
    first = counts.groupBy("w1").agg(F.sum("n").alias("n1"))
    second = counts.groupBy("w2").agg(F.sum("n").alias("n2"))
    n = first.agg(F.sum("n1").cast("double")).scalar()
    # A row per word is hashed by the partition, so that the pairs need no sort.
    j = counts.join(first.hint("shuffle_hash"), "w1").join(second.hint("shuffle_hash"), "w2")
    k11 = F.col("n").cast("double")
    r1, c1 = F.col("n1").cast("double"), F.col("n2").cast("double")
    k12, k21 = r1 - k11, c1 - k11
    k22 = n - r1 - c1 + k11
    r2, c2 = n - r1, n - c1

    def term(k, r, c):
        return F.when(k > 0, k * F.log((k * n) / (r * c))).otherwise(F.lit(0.0))

    g2 = F.lit(2.0) * (term(k11, r1, c1) + term(k12, r1, c2) + term(k21, r2, c1) + term(k22, r2, c2))
    return j.select("w1", "w2", "n", g2.alias("g2"))
