import pytest
from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.operators import analytics as A
from titlepulse.operators.clean import clean_actor, clean_movie, clean_review


def rows(df, places=6):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, places) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data(spark, sf):
    m = clean_movie(X.raw_movie(spark, sf))
    # duplicate movie and actor records, as a replayed topic would produce
    m = m.unionByName(m.limit(20))
    a = clean_actor(X.raw_actor(spark, sf))
    a = a.unionByName(a.limit(10))
    r = clean_review(X.raw_review(spark, sf))
    return m, a, r


@pytest.mark.parametrize("name", ["top_user_sentiment", "top_director_rate", "top_sentiment"])
def test_eager_equals_join_first(spark, data, name):
    m, a, r = data
    fn = getattr(A, name)
    left = r if name != "top_director_rate" else a
    eager = fn(left, m, pre_aggregate=True)
    plain = fn(left, m, pre_aggregate=False)
    assert rows(A.ordered(eager, name)) == rows(A.ordered(plain, name))


def test_rating_per_year_eager_equals_dedupe_after_join(spark, sf):
    m = clean_movie(X.raw_movie(spark, sf))
    r = clean_review(X.raw_review(spark, sf))
    r = r.unionByName(r.limit(50))  # exact duplicate reviews
    eager = A.rating_per_year(r, m, pre_aggregate=True)
    plain = A.rating_per_year(r, m, pre_aggregate=False)
    assert rows(A.ordered(eager, "rating_per_year")) == rows(A.ordered(plain, "rating_per_year"))


def test_top_country_profit_rules(spark):
    m = spark.createDataFrame(
        [("t1", "US", "en", 8.0, 100, 40), ("t2", "US", "en", 6.0, 0, 50), ("t3", "US", "en", None, 10, None)],
        "movie_id string, country string, language string, rating double, revenue bigint, budget bigint"
    ).withColumn("movie_ts", X._hour_of_2024(F.lit(1)))
    r = A.top_country(m).collect()[0]
    # t1: 60, t2: no revenue -> 0 (not a loss), t3: unknown budget -> null (skipped)
    assert r.avg_profit == 30.0 and r.total_movie == 3 and r.avg_rating == 7.0 and r.total_budget == 90


def test_director_replay_dedupe(spark, sf):
    m = clean_movie(X.raw_movie(spark, sf))
    a = clean_actor(X.raw_actor(spark, sf))
    replayed = a.unionByName(a)
    once = rows(A.ordered(A.top_director_rate(a, m), "top_director_rate"))
    twice = rows(A.ordered(A.top_director_rate(replayed, m), "top_director_rate"))
    fixed = rows(A.ordered(A.top_director_rate(replayed, m, dedupe=True), "top_director_rate"))
    assert twice != once and fixed == once


def test_sentiment_dedupe_before_join_equals_after(spark, data):
    m, _, r = data
    r = r.unionByName(r.limit(40).withColumn("star", F.lit(3)))  # same review_id, other star
    got = A.ordered(A.top_sentiment(r, m, dedupe=True), "top_sentiment")
    order = ["movie_id", "review_ts", "star", "like", "dislike", "title", "year", "rating"]
    j = r.join(m.select("movie_id", "title", "year", "rating"), "movie_id")
    ref = (j.groupBy("review_id").agg(F.min(F.struct(*order)).alias("_r")).select("review_id", "_r.*"))
    from titlepulse.functions.labels import sentiment_indicators
    ref = ref.select("*", *sentiment_indicators("star")).groupBy("title", "year", "rating", "review_ts").agg(
        F.count("review_id").alias("total_review"), F.sum("Positive").alias("Positive"),
        F.sum("Negative").alias("Negative"), F.sum("Neutral").alias("Neutral"))
    assert rows(got) == rows(A.ordered(ref, "top_sentiment"))
