"""Raw and result schemas, and the label constants shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw records as the crawler emits them. All text fields are nullable strings;
# rating is read as double (a float widens 9.3 to 9.300000190734863) and year
# as string, cast afterwards, because the crawler writes it as text.
MOVIE_FIELDS = [
    ("movie_id", T.StringType()), ("title", T.StringType()),
    ("rating", T.DoubleType()), ("year", T.StringType()),
    ("vote_count", T.StringType()), ("runtime", T.StringType()),
    ("items", T.StringType()), ("country", T.StringType()),
    ("language", T.StringType()), ("company", T.StringType()),
    ("budget", T.StringType()), ("revenue", T.StringType()),
    ("plot", T.StringType()), ("poster", T.StringType()), ("url", T.StringType()),
]
ACTOR_FIELDS = [
    ("actor_id", T.StringType()), ("director", T.StringType()),
    ("writers", T.StringType()), ("stars", T.StringType()),
    ("movie_id", T.StringType()),
]
REVIEW_FIELDS = [
    ("review_id", T.StringType()), ("title_review", T.StringType()),
    ("comment", T.StringType()), ("star", T.StringType()),
    ("like", T.StringType()), ("dislike", T.StringType()),
    ("date", T.StringType()), ("user_name", T.StringType()),
    ("movie_id", T.StringType()),
]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


MOVIE = _struct(MOVIE_FIELDS)
ACTOR = _struct(ACTOR_FIELDS)
REVIEW = _struct(REVIEW_FIELDS)

RECORD_SCHEMAS = {"movie": MOVIE, "actor": ACTOR, "review": REVIEW}
ID_COLUMNS = {"movie": "movie_id", "actor": "actor_id", "review": "review_id"}
TS_COLUMNS = {"movie": "movie_ts", "actor": "actor_ts", "review": "review_ts"}

# A message on a topic: key, JSON-array value, broker time (the event time).
MESSAGE = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("ts_ms", T.LongType(), True),
])

# Message sizes per topic used by the producer.
MESSAGE_SIZES = {"movie": 10, "actor": 10, "review": 100}

# Sentiment thresholds on the 0-10 star scale.
POSITIVE_MIN_STAR = 8
NEUTRAL_MIN_STAR = 5

# Numeric training label for each sentiment name. The web page of
# the original decoded predictions with the reverse map for 0 and 1; here one
# constant serves both directions.
LABEL_OF = {"Negative": 0, "Positive": 1, "Neutral": 2}
NAME_OF = {v: k for k, v in LABEL_OF.items()}

# The basket thresholds of the association-rule mining.
LIKE_HIGH_OVER = 500
DISLIKE_HIGH_OVER = 100

# Result column orders (the code's, not the README's DDL).
RESULT_COLUMNS = {
    "top_country": ["country", "language", "movie_ts", "avg_rating",
                    "total_revenue", "total_movie", "total_budget", "avg_profit"],
    "top_user_sentiment": ["title", "rating", "review_ts", "total_review",
                           "total_like", "total_dislike", "like_ratio"],
    "top_director_rate": ["director", "actor_ts", "avg_rating", "total_movies",
                          "total_revenue"],
    "rating_per_year": ["year", "review_ts", "avg_rating", "total_movie",
                        "total_review"],
    "top_sentiment": ["title", "year", "rating", "review_ts", "total_review",
                      "Positive", "Negative", "Neutral"],
}
