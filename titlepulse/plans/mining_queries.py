"""Mining chart data, rules, rankings and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.functions.cleaning import not_junk
from titlepulse.functions.labels import sentiment_label
from titlepulse.functions.text import ENGLISH_STOP_WORDS, sql_list
from titlepulse.operators import lookups as L
from titlepulse.operators import mining as M
from titlepulse.operators import sketches as S
from titlepulse.operators.topk import top_k
from titlepulse.plans.catalog import register, rounded
from titlepulse.plans.core_queries import actors, movies, reviews
from titlepulse.plans.oracle_views import (
    ACTOR_NUM, MOVIE_NUM, RAW_ACTOR, REVIEW_NUM, SENTIMENT_SQL, with_views,
)
from titlepulse.session import scratch_path

# The mining parameters of the original job.
MIN_SUPPORT = 0.1
MIN_CONFIDENCE = 0.1
HIST_BINS = 12

_BASKET_SQL = f"""list_filter([{SENTIMENT_SQL}, cast(star AS varchar),
    CASE WHEN "like" > 500 THEN 'like_high' ELSE 'like_low' END,
    CASE WHEN dislike > 100 THEN 'dislike_high' ELSE 'dislike_low' END], lambda x: x IS NOT NULL)"""

_ITEMSETS_SQL = f""",
b AS (SELECT list_sort(list_distinct({_BASKET_SQL})) AS items FROM review_num),
wb AS (SELECT items, count(*) AS w FROM b GROUP BY items),
tot AS (SELECT cast(sum(w) AS double) AS nb FROM wb),
sub AS (SELECT list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items, w
        FROM wb, (SELECT range AS m FROM range(1, 4096)) masks WHERE m < (1 << len(items))),
fi AS (SELECT items, sum(w) AS freq FROM sub GROUP BY items
       HAVING sum(w) >= (SELECT ceil({MIN_SUPPORT} * nb) FROM tot))"""

_RULES_SQL = _ITEMSETS_SQL + f""",
r AS (SELECT items, freq, unnest(items) AS c FROM fi WHERE len(items) >= 2),
x AS (SELECT list_filter(r.items, lambda y: y <> r.c) AS ante, r.c AS cons, r.freq AS f_all FROM r),
rules AS (
  SELECT array_to_string(ante, ',') AS antecedent, cons AS consequent,
    f_all / a.freq AS confidence, (f_all / a.freq) / (k.freq / nb) AS lift, f_all / nb AS support
  FROM x JOIN fi a ON a.items = x.ante JOIN fi k ON k.items = [x.cons] CROSS JOIN tot
  WHERE f_all / a.freq >= {MIN_CONFIDENCE}),
texts AS (
  SELECT *, antecedent || ' → ' || consequent AS rule FROM rules),
shortened AS (
  SELECT *, CASE WHEN length(rule) > 40 THEN left(rule, 40) || '...' ELSE rule END AS rule_short
  FROM texts)"""


# ----------------------------------------------------------------- charts
@register("star_histogram", with_views(REVIEW_NUM) + """,
s AS (SELECT cast(min(star) AS double) AS mn, cast(max(star) AS double) AS mx FROM review_num),
bd AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM s),
c AS (SELECT cast(least(floor(((cast(star AS double) - lo) * 12.0) / (hi - lo)), 11) AS bigint) AS bin,
             count(*) AS n
      FROM review_num CROSS JOIN bd WHERE star IS NOT NULL GROUP BY 1),
bins AS (SELECT range AS bin FROM range(12))
SELECT bins.bin, round(lo + bins.bin * (hi - lo) / 12.0, 6) AS bin_lo,
  round(CASE WHEN bins.bin = 11 THEN hi ELSE lo + (bins.bin + 1) * (hi - lo) / 12.0 END, 6) AS bin_hi,
  coalesce(c.n, 0) AS n
FROM bins CROSS JOIN bd LEFT JOIN c ON c.bin = bins.bin""")
def q_star_histogram(spark, d):
    return rounded(M.histogram(reviews(spark, d), "star", HIST_BINS))


@register("sentiment_distribution", with_views(REVIEW_NUM) + f"""
SELECT {SENTIMENT_SQL} AS sentiment, count(*) AS n FROM review_num GROUP BY 1""")
def q_sentiment_distribution(spark, d):
    return M.sentiment_distribution(reviews(spark, d))


@register("like_dislike_points", with_views(REVIEW_NUM) + """
SELECT "like", dislike, count(*) AS n FROM review_num
WHERE "like" IS NOT NULL AND dislike IS NOT NULL GROUP BY 1, 2""")
def q_like_dislike_points(spark, d):
    return M.scatter_points(reviews(spark, d), "like", "dislike")


@register("like_boxplot", with_views(REVIEW_NUM) + f""",
r AS (SELECT {SENTIMENT_SQL} AS sentiment, cast("like" AS double) AS v FROM review_num
      WHERE "like" IS NOT NULL),
q AS (SELECT sentiment, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM r GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.sentiment, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN v >= lo THEN v END), 6) AS whisker_lo,
  round(max(CASE WHEN v <= hi THEN v END), 6) AS whisker_hi,
  cast(sum(CASE WHEN v >= lo AND v <= hi THEN 0 ELSE 1 END) AS bigint) AS n_outliers
FROM r JOIN f USING (sentiment) GROUP BY f.sentiment, n, q1, median, q3""")
def q_like_boxplot(spark, d):
    out = M.box_stats(reviews(spark, d), "like", sentiment_label("star"))
    return rounded(out.withColumnRenamed("group", "sentiment"))


@register("like_quantiles")
def q_like_quantiles(spark, d):
    """Quartiles of the likes by sentiment, merged from a sketch for each
    sentiment and day, with their rank error. SQL has no such sketch: tested
    against numpy."""
    r = reviews(spark, d).select(sentiment_label("star").alias("sentiment"), F.to_date("review_ts").alias("day"), "like")
    return S.merged_quantiles(S.quantile_sketches(r, "like", ["sentiment", "day"]), ["sentiment"], [0.25, 0.5, 0.75])


_CORR_COLS = ["star", "like", "dislike"]


def _q(c):
    return '"like"' if c == "like" else c


@register("corr_matrix", with_views(REVIEW_NUM) + ", c AS (SELECT " + ", ".join(
    f"corr(cast({_q(a)} AS double), cast({_q(b)} AS double)) AS {a}__{b}"
    for a in _CORR_COLS for b in _CORR_COLS) + " FROM review_num)\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round({a}__{b}, 9) AS corr FROM c"
    for a in _CORR_COLS for b in _CORR_COLS))
def q_corr_matrix(spark, d):
    return rounded(M.corr_matrix(reviews(spark, d), _CORR_COLS), 9)


# ----------------------------------------------------------------- words
_STOP_SQL = sql_list(ENGLISH_STOP_WORDS)
_WORDS_SQL = (f"regexp_extract_all(lower(coalesce(text, '')), "
              f"'{M.WORD_RE.replace(chr(39), chr(39) * 2)}')")


def _kept_sql(w):
    return f"NOT list_contains({_STOP_SQL}, {w}) AND NOT regexp_matches({w}, '{M.DIGITS_RE}')"


@register("word_counts", f"""
WITH t AS (SELECT unnest({_WORDS_SQL}) AS word FROM documents)
SELECT word, count(*) AS n FROM t WHERE {_kept_sql('word')} GROUP BY word""")
def q_word_counts(spark, d):
    return M.word_counts(X.table(spark, d, "documents"), "text", ENGLISH_STOP_WORDS)


def _term_sql(k, r, c):
    return f"CASE WHEN {k} > 0 THEN {k} * ln(({k} * nn) / ({r} * {c})) ELSE 0.0 END"


@register("bigram_counts", f"""
WITH d AS (SELECT {_WORDS_SQL} AS t FROM documents),
p AS (SELECT z[1] AS w1, z[2] AS w2 FROM (SELECT unnest(list_zip(t, list_slice(t, 2, len(t)))) AS z FROM d)),
c AS (SELECT w1, w2, count(*) AS n FROM p
      WHERE w2 IS NOT NULL AND {_kept_sql('w1')} AND {_kept_sql('w2')} GROUP BY 1, 2),
l AS (SELECT w1, sum(n) AS n1 FROM c GROUP BY 1),
r AS (SELECT w2, sum(n) AS n2 FROM c GROUP BY 1),
tot AS (SELECT cast(sum(n) AS double) AS nn FROM c),
j AS (SELECT w1, w2, n, cast(n AS double) AS k11, cast(n1 AS double) AS r1,
             cast(n2 AS double) AS c1, nn FROM c JOIN l USING (w1) JOIN r USING (w2) CROSS JOIN tot)
SELECT w1, w2, n, round(2.0 * ({_term_sql('k11', 'r1', 'c1')} + {_term_sql('(r1 - k11)', 'r1', '(nn - c1)')}
  + {_term_sql('(c1 - k11)', '(nn - r1)', 'c1')}
  + {_term_sql('(nn - r1 - c1 + k11)', '(nn - r1)', '(nn - c1)')}), 6) AS g2
FROM j""")
def q_bigram_counts(spark, d):
    return rounded(M.bigram_counts(X.table(spark, d, "documents"), "text", ENGLISH_STOP_WORDS))


@register("heavy_words")
def q_heavy_words(spark, d):
    """The twenty most frequent words of each language, merged from a sketch
    for each source, with the error of their counts. Tested against exact counts."""
    t = X.table(spark, d, "documents")
    w = t.select("lang", "source", F.explode(M.words(t, "text")).alias("word")).filter(~F.col("word").isin(ENGLISH_STOP_WORDS))
    return S.merged_heavy_hitters(S.frequency_sketches(w, "word", ["lang", "source"]), ["lang"], 20)


# ----------------------------------------------------------------- baskets / rules
@register("baskets", with_views(REVIEW_NUM) + f"""
SELECT array_to_string({_BASKET_SQL}, ',') AS basket, count(*) AS n FROM review_num GROUP BY 1""")
def q_baskets(spark, d):
    b = M.baskets(reviews(spark, d))
    return b.groupBy(F.array_join("items", ",").alias("basket")).agg(F.count(F.lit(1)).alias("n"))


def _itemsets(spark, d):
    w = M.weighted_baskets(M.baskets(reviews(spark, d)))
    return w, M.itemsets_from_weighted(w, MIN_SUPPORT)


@register("frequent_itemsets", with_views(REVIEW_NUM) + _ITEMSETS_SQL + """
SELECT array_to_string(items, ',') AS itemset, cast(len(items) AS bigint) AS n_items,
  cast(freq AS bigint) AS freq FROM fi""")
def q_frequent_itemsets(spark, d):
    _, fi = _itemsets(spark, d)
    return fi.select(F.array_join("items", ",").alias("itemset"),
                     F.size("items").cast("bigint").alias("n_items"), "freq")


AUDIENCE_SUPPORT = 0.8

_LEVELS_SQL = """[cast(star AS varchar), CASE WHEN "like" > 500 THEN 'like_high' ELSE 'like_low' END,
    CASE WHEN dislike > 100 THEN 'dislike_high' ELSE 'dislike_low' END]"""


@register("audience_itemsets", with_views(REVIEW_NUM).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
occ AS (SELECT DISTINCT movie_id, item FROM (SELECT movie_id, unnest({_LEVELS_SQL}) AS item FROM review_num) t WHERE item IS NOT NULL),
b AS (SELECT movie_id, list(item) AS items FROM occ GROUP BY movie_id),
least AS (SELECT ceil({AUDIENCE_SUPPORT} * count(*)) AS c FROM b),
fs AS (SELECT [item] AS items, count(*) AS freq FROM occ GROUP BY item HAVING count(*) >= (SELECT c FROM least)
  UNION ALL
  SELECT list_append(f.items, o.item) AS items, count(*) AS freq
  FROM fs f JOIN b ON list_has_all(b.items, f.items) JOIN occ o ON o.movie_id = b.movie_id AND o.item > f.items[-1]
  GROUP BY 1 HAVING count(*) >= (SELECT c FROM least))
SELECT array_to_string(items, ',') AS itemset, cast(len(items) AS bigint) AS n_items, cast(freq AS bigint) AS freq FROM fs""")
def q_audience_itemsets(spark, d):
    """Sets of stars and reaction levels that the reviews of a title hold
    together: baskets of up to 14 items, one for each title."""
    levels = F.array(F.col("star").cast("string"), F.when(F.col("like") > 500, "like_high").otherwise("like_low"),
                     F.when(F.col("dislike") > 100, "dislike_high").otherwise("dislike_low"))
    per_title = (reviews(spark, d).select("movie_id", F.explode(levels).alias("item")).filter("item IS NOT NULL")
                 .groupBy("movie_id").agg(F.collect_set("item").alias("items")))
    fi = M.frequent_itemsets(per_title, AUDIENCE_SUPPORT)
    return fi.select(F.array_join("items", ",").alias("itemset"), F.size("items").cast("bigint").alias("n_items"), "freq")


def _rules(spark, d):
    w, fi = _itemsets(spark, d)
    return M.rule_text(M.association_rules(fi, M.basket_count(w), MIN_CONFIDENCE))


@register("association_rules", with_views(REVIEW_NUM) + _RULES_SQL + """
SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(lift, 9) AS lift,
  round(support, 9) AS support FROM rules""")
def q_association_rules(spark, d):
    r = _rules(spark, d)
    return rounded(r.select(F.array_join("antecedent", ",").alias("antecedent"),
                            F.array_join("consequent", ",").alias("consequent"),
                            "confidence", "lift", "support"), 9)


@register("rules_text", with_views(REVIEW_NUM) + _RULES_SQL + """
SELECT rule, rule_short, round(confidence, 9) AS confidence FROM shortened""")
def q_rules_text(spark, d):
    return rounded(_rules(spark, d).select("rule", "rule_short", "confidence"), 9)


@register("rules_top20", with_views(REVIEW_NUM) + _RULES_SQL + """
SELECT rule, rule_short, round(confidence, 9) AS confidence FROM shortened
ORDER BY confidence DESC, rule LIMIT 20""")
def q_rules_top20(spark, d):
    r = _rules(spark, d).select("rule", "rule_short", "confidence")
    return rounded(top_k(r, 20, [F.desc("confidence"), F.asc("rule")]), 9)


# ----------------------------------------------------------------- rankings / look-ups
@register("top_directors_ranked", with_views(MOVIE_NUM, RAW_ACTOR, ACTOR_NUM) + """
SELECT director, round(avg(rating), 6) AS avg_rating, count(movie_id) AS total_movies,
  cast(sum(revenue) AS bigint) AS total_revenue
FROM actor_num JOIN movie_num USING (movie_id) GROUP BY director
ORDER BY avg(rating) DESC NULLS LAST, sum(revenue) DESC NULLS LAST, director LIMIT 5""")
def q_top_directors_ranked(spark, d):
    return rounded(L.top_directors(actors(spark, d), movies(spark, d), 5))


@register("top_movies_per_country", with_views(MOVIE_NUM) + """
SELECT country, movie_id, title, rating, revenue, rank FROM (
  SELECT country, movie_id, title, rating, revenue, row_number() OVER (PARTITION BY country
    ORDER BY rating DESC NULLS LAST, revenue DESC NULLS LAST, movie_id) AS rank
  FROM movie_num) t WHERE rank <= 3""")
def q_top_movies_per_country(spark, d):
    out = L.top_movies_per_country(movies(spark, d), 3)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


_FILTER_COUNTRIES = ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"]


def _filter_sql(where: str, dominant: str) -> str:
    return with_views(MOVIE_NUM, RAW_ACTOR, ACTOR_NUM, REVIEW_NUM) + f""",
s AS (SELECT movie_id, count(review_id) AS total_review,
        cast(sum(CASE WHEN star >= 8 THEN 1 ELSE 0 END) AS bigint) AS Positive,
        cast(sum(CASE WHEN star < 5 THEN 1 ELSE 0 END) AS bigint) AS Negative,
        cast(sum(CASE WHEN star >= 5 AND star < 8 THEN 1 ELSE 0 END) AS bigint) AS Neutral
      FROM review_num GROUP BY movie_id),
j AS (SELECT movie_id, title, country, rating, director,
        coalesce(total_review, 0) AS total_review, coalesce(Positive, 0) AS Positive,
        coalesce(Negative, 0) AS Negative, coalesce(Neutral, 0) AS Neutral
      FROM movie_num JOIN actor_num USING (movie_id) LEFT JOIN s USING (movie_id)
      WHERE {where}),
k AS (SELECT *, CASE WHEN total_review = 0 THEN NULL
        WHEN Positive >= Negative AND Positive >= Neutral THEN 'Positive'
        WHEN Neutral >= Negative THEN 'Neutral' ELSE 'Negative' END AS dominant FROM j)
SELECT * FROM k WHERE dominant = '{dominant}'"""


_IN_COUNTRIES = f"""country IN ({", ".join(f"'{c}'" for c in _FILTER_COUNTRIES)})"""


@register("movie_filter", _filter_sql(f"rating >= 5.0 AND {_IN_COUNTRIES}", "Negative"))
def q_movie_filter(spark, d):
    return L.movie_filter(movies(spark, d), actors(spark, d), reviews(spark, d), min_rating=5.0,
                          countries=_FILTER_COUNTRIES, sentiment="Negative")


@register("indexed_movie_filter", _filter_sql(f"rating >= 2.0 AND {_IN_COUNTRIES} AND contains(lower(director), 'r#00000000')", "Negative"))
def q_indexed_movie_filter(spark, d):
    path = scratch_path(spark, "movie-index")
    L.index_movies(movies(spark, d), actors(spark, d), reviews(spark, d), path)
    return L.indexed_movie_filter(spark, path, min_rating=2.0, countries=_FILTER_COUNTRIES,
                                  director_contains="R#00000000", sentiment="Negative")


@register("revenue_rating_corr", with_views(MOVIE_NUM) + """
SELECT CASE WHEN grouping(country) = 1 THEN 'ALL' ELSE country END AS country,
  round(corr(cast(revenue AS double), rating), 9) AS corr, count(*) AS n
FROM movie_num GROUP BY ROLLUP (country)""")
def q_revenue_rating_corr(spark, d):
    return rounded(L.revenue_rating_corr(movies(spark, d)), 9)


_PERSON = "brand#1"


_PERSON_SQL = with_views(MOVIE_NUM, RAW_ACTOR) + f""",
c AS (SELECT movie_id, director AS person, 'director' AS role FROM raw_actor
      UNION ALL SELECT movie_id, unnest(from_json(writers, '["VARCHAR"]')), 'writer' FROM raw_actor
      UNION ALL SELECT movie_id, unnest(from_json(stars, '["VARCHAR"]')), 'star' FROM raw_actor)
SELECT person, role, round(avg(rating), 6) AS avg_rating, count(movie_id) AS total_movies,
  cast(sum(revenue) AS bigint) AS total_revenue
FROM c JOIN movie_num USING (movie_id) WHERE contains(lower(person), '{_PERSON}')
GROUP BY person, role"""


@register("person_search", _PERSON_SQL)
def q_person_search(spark, d):
    actor = X.raw_actor(spark, d).filter(not_junk("actor_id"))
    return rounded(L.person_search(actor, movies(spark, d), _PERSON))


@register("indexed_person_search", _PERSON_SQL)
def q_indexed_person_search(spark, d):
    path = scratch_path(spark, "people-index")
    L.index_people(X.raw_actor(spark, d).filter(not_junk("actor_id")), movies(spark, d), path)
    return rounded(L.indexed_person_search(spark, path, _PERSON))
