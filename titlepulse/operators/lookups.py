"""Interactive look-ups and rankings: filter movies, revenue-rating correlation,
person search, best directors, best movies per country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlepulse.functions.labels import sentiment_indicators
from titlepulse.operators.postings import search_bitmaps, search_grams, write_bitmap_index, write_gram_index
from titlepulse.operators.topk import top_k


def review_summary(review: DataFrame) -> DataFrame:
    """One row per movie: review count and Positive / Negative / Neutral sums
    (map-side combined before the shuffle)."""
    ind = review.select("movie_id", "review_id", *sentiment_indicators("star"))
    return ind.groupBy("movie_id").agg(
        F.count("review_id").alias("total_review"), F.sum("Positive").alias("Positive"),
        F.sum("Negative").alias("Negative"), F.sum("Neutral").alias("Neutral"))


def dominant_sentiment() -> F.Column:
    p, n, u = F.col("Positive"), F.col("Negative"), F.col("Neutral")
    return (F.when(F.col("total_review") == 0, F.lit(None).cast("string"))
            .when((p >= n) & (p >= u), "Positive").when(u >= n, "Neutral").otherwise("Negative"))


def movie_filter(movie: DataFrame, actor: DataFrame, review: DataFrame,
                 min_rating: float | None = None, countries: list[str] | None = None,
                 director_contains: str | None = None, sentiment: str | None = None) -> DataFrame:
    """Conjunctive filter over movie x director x review sentiment counts.

    Movie-side predicates are applied before the joins so they reach the scan.
    """
    m = movie.select("movie_id", "title", "country", "rating")
    if min_rating is not None:
        m = m.filter(F.col("rating") >= min_rating)
    if countries:
        m = m.filter(F.col("country").isin(countries))
    a = actor.select("movie_id", "director")
    if director_contains:
        a = a.filter(F.lower("director").contains(director_contains.lower()))
    zero = F.lit(0).cast("bigint")
    out = (m.join(a, "movie_id").join(review_summary(review), "movie_id", "left")
           .select("movie_id", "title", "country", "rating", "director",
                   *[F.coalesce(c, zero).alias(c) for c in
                     ("total_review", "Positive", "Negative", "Neutral")]))
    out = out.withColumn("dominant", dominant_sentiment())
    if sentiment:
        out = out.filter(F.col("dominant") == sentiment)
    return out


def index_movies(movie: DataFrame, actor: DataFrame, review: DataFrame, path: str) -> None:
    """Write what ``movie_filter`` gives without a filter, indexed by country,
    prevailing sentiment and the grams of the director's name."""
    write_bitmap_index(movie_filter(movie, actor, review), ["movie_id"], ["country", "dominant"], path, names=("director",))


def indexed_movie_filter(spark: SparkSession, path: str, min_rating: float | None = None, countries: list[str] | None = None,
                         director_contains: str | None = None, sentiment: str | None = None) -> DataFrame:
    """``movie_filter`` from the tables of ``index_movies``."""
    values = {"country": countries or [], "dominant": [sentiment] if sentiment else []}
    return search_bitmaps(spark, path, {f: v for f, v in values.items() if v},
                          {"director": director_contains} if director_contains else {},
                          None if min_rating is None else F.col("rating") >= min_rating)


def revenue_rating_corr(movie: DataFrame, by: str = "country", all_label: str = "ALL") -> DataFrame:
    """corr(revenue, rating) per group and overall, one pass (ROLLUP)."""
    out = movie.rollup(by).agg(F.corr(F.col("revenue").cast("double"), F.col("rating")).alias("corr"),
                               F.count(F.lit(1)).alias("n"), F.grouping(by).alias("_g"))
    return out.select(F.when(F.col("_g") == 1, F.lit(all_label)).otherwise(F.col(by)).alias(by),
                      "corr", "n")


def credits(actor: DataFrame) -> DataFrame:
    """(movie_id, person, role) for directors, writers and stars (from the raw
    JSON lists, so names may contain commas)."""
    arr = T.ArrayType(T.StringType())
    roles = F.concat(
        F.array(F.struct(F.col("director").alias("person"), F.lit("director").alias("role"))),
        F.transform(F.coalesce(F.from_json("writers", arr), F.array().cast(arr)),
                    lambda x: F.struct(x.alias("person"), F.lit("writer").alias("role"))),
        F.transform(F.coalesce(F.from_json("stars", arr), F.array().cast(arr)),
                    lambda x: F.struct(x.alias("person"), F.lit("star").alias("role"))))
    return actor.select("movie_id", F.explode(roles).alias("_p")).select("movie_id", "_p.*")


def person_search(actor: DataFrame, movie: DataFrame, term: str) -> DataFrame:
    """People whose name contains ``term`` (case-insensitive), with the
    director-table aggregates per (person, role)."""
    return person_totals(credits(actor).filter(F.lower("person").contains(term.lower())), movie)


def person_totals(credit: DataFrame, movie: DataFrame) -> DataFrame:
    """The director table's aggregates per (person, role)."""
    m = movie.select("movie_id", "rating", "revenue")
    return (credit.join(m, "movie_id").groupBy("person", "role")
            .agg(F.avg("rating").alias("avg_rating"), F.count("movie_id").alias("total_movies"),
                 F.sum("revenue").alias("total_revenue")))


def index_people(actor: DataFrame, movie: DataFrame, path: str) -> None:
    """Write the totals of every (person, role), posted under the name's grams."""
    write_gram_index(person_totals(credits(actor), movie), "person", path)


def indexed_person_search(spark: SparkSession, path: str, term: str) -> DataFrame:
    """``person_search`` from the postings of ``index_people`` alone."""
    return search_grams(spark, path, "person", term)


def director_totals(actor: DataFrame, movie: DataFrame) -> DataFrame:
    m = movie.select("movie_id", "rating", "revenue")
    return (actor.select("movie_id", "director").join(m, "movie_id").groupBy("director")
            .agg(F.avg("rating").alias("avg_rating"), F.count("movie_id").alias("total_movies"),
                 F.sum("revenue").alias("total_revenue")))


def top_directors(actor: DataFrame, movie: DataFrame, n: int = 5) -> DataFrame:
    """Best directors by average rating, then revenue (ties by name)."""
    order = [F.desc_nulls_last("avg_rating"), F.desc_nulls_last("total_revenue"), F.asc("director")]
    return top_k(director_totals(actor, movie), n, order)


def top_movies_per_country(movie: DataFrame, n: int = 3) -> DataFrame:
    """Best ``n`` movies of each country by rating, then revenue (ties by id)."""
    order = [F.desc_nulls_last("rating"), F.desc_nulls_last("revenue"), F.asc("movie_id")]
    m = movie.select("country", "movie_id", "title", "rating", "revenue")
    return top_k(m, n, order, partition_by=["country"], rank_col="rank")
