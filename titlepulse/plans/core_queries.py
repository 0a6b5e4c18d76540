"""Cleaning, labels, deduplication and the five result tables (batch)."""

from __future__ import annotations

from titlepulse import fixtures as X
from titlepulse.functions.labels import sentiment_label, sentiment_number
from titlepulse.operators import analytics as A
from titlepulse.operators.clean import clean_actor, clean_movie, clean_review
from titlepulse.operators.dedupe import dedupe_latest
from titlepulse.plans.catalog import register, rounded
from titlepulse.plans.oracle_views import (
    ACTOR_NUM, LABEL_SQL, MOVIE_NUM, RAW_ACTOR, REVIEW_NUM, SENTIMENT_SQL, with_views,
)


def movies(spark, d):
    return clean_movie(X.raw_movie(spark, d))


def actors(spark, d):
    return clean_actor(X.raw_actor(spark, d))


def reviews(spark, d):
    return clean_review(X.raw_review(spark, d))


# ------------------------------------------------------------------ cleaning
@register("clean_movie", with_views(MOVIE_NUM) + """
SELECT movie_id, title, rating, year, vote_count, country, language, company,
       budget, revenue, movie_ts FROM movie_num""")
def q_clean_movie(spark, d):
    return movies(spark, d)


@register("clean_actor", with_views(RAW_ACTOR, ACTOR_NUM) + """
SELECT actor_id, director, writers, stars, movie_id, actor_ts FROM actor_num""")
def q_clean_actor(spark, d):
    return actors(spark, d)


@register("clean_review", with_views(REVIEW_NUM) + """
SELECT review_id, movie_id, star, "like", dislike, review_ts FROM review_num""")
def q_clean_review(spark, d):
    return reviews(spark, d)


@register("sentiment_label", with_views(REVIEW_NUM) + f"""
SELECT review_id, movie_id, star, {SENTIMENT_SQL} AS sentiment, {LABEL_SQL} AS label
FROM review_num""")
def q_sentiment_label(spark, d):
    return reviews(spark, d).select("review_id", "movie_id", "star",
                                    sentiment_label("star").alias("sentiment"),
                                    sentiment_number("star").alias("label"))


@register("dedupe_reviews", with_views(REVIEW_NUM) + """
SELECT review_id, movie_id, star, "like", dislike, review_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id, movie_id
    ORDER BY review_ts NULLS FIRST, star NULLS FIRST, "like" NULLS FIRST,
             dislike NULLS FIRST) AS rn
  FROM review_num) t WHERE rn = 1""")
def q_dedupe_reviews(spark, d):
    return dedupe_latest(reviews(spark, d), ["review_id", "movie_id"],
                         ["review_ts", "star", "like", "dislike"], keep="first")


# -------------------------------------------------------------- five results
@register("top_country", with_views(MOVIE_NUM) + """
SELECT country, language, movie_ts, round(avg(rating), 6) AS avg_rating,
  cast(sum(revenue) AS bigint) AS total_revenue, count(movie_id) AS total_movie,
  cast(sum(budget) AS bigint) AS total_budget,
  round(avg(CASE WHEN revenue > 0 THEN revenue - budget ELSE 0 END), 6) AS avg_profit
FROM movie_num GROUP BY country, language, movie_ts""")
def q_top_country(spark, d):
    return rounded(A.ordered(A.top_country(movies(spark, d)), "top_country"))


@register("top_user_sentiment", with_views(MOVIE_NUM, REVIEW_NUM) + """
SELECT title, rating, review_ts, count(review_id) AS total_review,
  cast(sum("like") AS bigint) AS total_like, cast(sum(dislike) AS bigint) AS total_dislike,
  round(CASE WHEN sum("like") + sum(dislike) > 0
             THEN sum("like") / (sum("like") + sum(dislike)) ELSE 0.0 END, 6) AS like_ratio
FROM review_num JOIN movie_num USING (movie_id)
GROUP BY title, rating, review_ts""")
def q_top_user_sentiment(spark, d):
    out = A.top_user_sentiment(reviews(spark, d), movies(spark, d))
    return rounded(A.ordered(out, "top_user_sentiment"))


@register("top_director_rate", with_views(MOVIE_NUM, RAW_ACTOR, ACTOR_NUM) + """
SELECT director, actor_ts, round(avg(rating), 6) AS avg_rating,
  count(movie_id) AS total_movies, cast(sum(revenue) AS bigint) AS total_revenue
FROM actor_num JOIN movie_num USING (movie_id)
GROUP BY director, actor_ts""")
def q_top_director_rate(spark, d):
    out = A.top_director_rate(actors(spark, d), movies(spark, d))
    return rounded(A.ordered(out, "top_director_rate"))


@register("rating_per_year", with_views(MOVIE_NUM, REVIEW_NUM) + """
SELECT year, review_ts, round(avg(rating), 6) AS avg_rating,
  count(movie_id) AS total_movie, count(review_id) AS total_review
FROM (SELECT *, row_number() OVER (PARTITION BY review_id, movie_id
        ORDER BY review_ts, year, rating) AS rn
      FROM review_num JOIN movie_num USING (movie_id)) t
WHERE rn = 1 GROUP BY year, review_ts""")
def q_rating_per_year(spark, d):
    out = A.rating_per_year(reviews(spark, d), movies(spark, d))
    return rounded(A.ordered(out, "rating_per_year"))


_TOP_SENTIMENT_AGG = """
SELECT title, year, rating, review_ts, count(review_id) AS total_review,
  cast(sum(CASE WHEN star >= 8 THEN 1 ELSE 0 END) AS bigint) AS Positive,
  cast(sum(CASE WHEN star < 5 THEN 1 ELSE 0 END) AS bigint) AS Negative,
  cast(sum(CASE WHEN star >= 5 AND star < 8 THEN 1 ELSE 0 END) AS bigint) AS Neutral
"""


@register("top_sentiment", with_views(MOVIE_NUM, REVIEW_NUM) + _TOP_SENTIMENT_AGG + """
FROM review_num JOIN movie_num USING (movie_id)
GROUP BY title, year, rating, review_ts""")
def q_top_sentiment(spark, d):
    out = A.top_sentiment(reviews(spark, d), movies(spark, d))
    return A.ordered(out, "top_sentiment")


@register("top_sentiment_dedup", with_views(MOVIE_NUM, REVIEW_NUM) + _TOP_SENTIMENT_AGG + """
FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY movie_id, review_ts,
        star NULLS FIRST, "like" NULLS FIRST, dislike NULLS FIRST, title, year, rating) AS rn
      FROM review_num JOIN movie_num USING (movie_id)) t
WHERE rn = 1 GROUP BY title, year, rating, review_ts""")
def q_top_sentiment_dedup(spark, d):
    out = A.top_sentiment(reviews(spark, d), movies(spark, d), dedupe=True)
    return A.ordered(out, "top_sentiment")
