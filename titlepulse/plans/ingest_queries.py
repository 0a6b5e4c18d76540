"""Envelope, tagging, routing, page extraction, list ops and per-key caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.operators import ingest as I
from titlepulse.operators.topk import top_k
from titlepulse.plans.catalog import register
from titlepulse.plans.core_queries import reviews
from titlepulse.plans.oracle_views import RAW_ACTOR, RAW_MOVIE, RAW_REVIEW, REVIEW_NUM, with_views
from titlepulse.schemas import MESSAGE_SIZES, MOVIE
from titlepulse.sources.envelope import pack_envelope, parse_envelope, to_message_rows

MOVIE_COLS = ["movie_id", "title", "rating", "year", "vote_count", "country", "language",
              "company", "budget", "revenue", "movie_ts"]
REVIEW_COLS = ["review_id", "movie_id", "star", "like", "dislike", "review_ts"]


@register("parse_envelope", with_views(RAW_MOVIE) + f"""
SELECT {", ".join(MOVIE_COLS)} FROM raw_movie""")
def q_parse_envelope(spark, d):
    """Pack the movie records into messages of 10 (one message time each),
    then parse the messages back: the round trip must give every record."""
    raw = X.raw_movie(spark, d)
    packed = pack_envelope(raw, "movie", ["movie_id"], MESSAGE_SIZES["movie"],
                           group_cols=("movie_ts",))
    msgs = to_message_rows(packed, "movie_ts").withColumn("timestamp",
                                                          F.timestamp_millis("ts_ms"))
    rows = parse_envelope(msgs, MOVIE, "timestamp", "movie_ts")
    return rows.select(*[F.col(c).try_cast("int").alias(c) if c == "year"
                         else F.col(c).cast("timestamp_ntz").alias(c) if c == "movie_ts"
                         else F.col(c) for c in MOVIE_COLS])


@register("pack_envelope", with_views(RAW_REVIEW) + """,
n AS (SELECT *, row_number() OVER (ORDER BY review_id NULLS FIRST, movie_id NULLS FIRST) AS rn FROM raw_review)
SELECT 'review' AS topic, cast((rn - 1) // 100 AS bigint) AS msg_no,
  count(*) AS n_records, arg_min(review_id, rn) AS first_id, arg_max(review_id, rn) AS last_id
FROM n GROUP BY (rn - 1) // 100""")
def q_pack_envelope(spark, d):
    packed = pack_envelope(X.raw_review(spark, d), "review", ["review_id", "movie_id"],
                           MESSAGE_SIZES["review"])
    return packed.select("topic", "msg_no", "n_records", "first_id", "last_id")


def _tagged(spark, d):
    return I.tag_union({"movie": X.raw_movie(spark, d), "actor": X.raw_actor(spark, d),
                        "review": X.raw_review(spark, d)})


@register("tag_union", with_views(RAW_MOVIE, RAW_ACTOR, RAW_REVIEW) + """
SELECT 'movie' AS _type, movie_id AS record_id FROM raw_movie
UNION ALL SELECT 'actor', actor_id FROM raw_actor
UNION ALL SELECT 'review', review_id FROM raw_review""")
def q_tag_union(spark, d):
    return I.line_ids(_tagged(spark, d))


@register("route_by_tag", with_views(RAW_REVIEW) + f"""
SELECT {", ".join('"like"' if c == "like" else c for c in REVIEW_COLS)} FROM raw_review""")
def q_route_by_tag(spark, d):
    schema = X.raw_review(spark, d).schema
    return I.route_by_tag(_tagged(spark, d), "review", schema).select(*REVIEW_COLS)


@register("page_fields", f"""
SELECT page_id, url,
  trim(regexp_extract(html, '{I.TITLE_RE}', 1)) AS title,
  trim(regexp_extract(html, '{I.H1_RE}', 1)) AS h1,
  regexp_extract(html, '{I.LANG_RE}', 1) AS lang,
  cast(len(regexp_extract_all(html, '{I.LINK_RE}', 1)) AS bigint) AS n_links,
  cast(length(trim(regexp_replace(regexp_extract(html, '{I.ARTICLE_RE}', 1), '{I.TAG_RE}', '', 'g')))
       AS bigint) AS article_chars
FROM pages""")
def q_page_fields(spark, d):
    out = I.page_fields(X.table(spark, d, "pages"))
    return out.select("page_id", "url", "title", "h1", "lang",
                      F.col("n_links").cast("bigint").alias("n_links"),
                      F.col("article_chars").cast("bigint").alias("article_chars"))


@register("page_url_id", f"""
SELECT page_id, split_part(url, '?', 1) AS url_base,
  string_split(split_part(url, '?', 1), '/')[-2] AS path_id,
  regexp_extract(url, '{I.HOST_RE}', 1) AS host
FROM pages""")
def q_page_url_id(spark, d):
    return I.url_parts(X.table(spark, d, "pages"))


@register("list_ops", with_views(RAW_ACTOR) + """,
a AS (SELECT actor_id, director, from_json(stars, '["VARCHAR"]') AS s,
        from_json(writers, '["VARCHAR"]') AS w FROM raw_actor)
SELECT actor_id, array_to_string(list_slice(s, 1, 3), '|') AS top_stars,
  array_to_string(list_filter(list_slice(list_concat([director], w), 2, 4), lambda x: x <> s[1]), '|')
    AS writers_wo_lead,
  s[1] AS star_1, s[2] AS star_2, s[3] AS star_3, cast(len(s) AS bigint) AS n_stars
FROM a""")
def q_list_ops(spark, d):
    out = I.list_ops(X.raw_actor(spark, d))
    return out.withColumn("n_stars", F.col("n_stars").cast("bigint"))


@register("cap_per_key", with_views(REVIEW_NUM) + """
SELECT review_id, movie_id, star, "like", dislike, review_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY review_id NULLS FIRST,
    star NULLS FIRST, "like" NULLS FIRST, dislike NULLS FIRST, review_ts NULLS FIRST) AS rn
  FROM review_num) t WHERE rn <= 20""")
def q_cap_per_key(spark, d):
    """At most 20 reviews per movie, exact per movie: the crawler's cap (300 by
    default there) at a number that binds on the test data."""
    order = [F.col(c).asc_nulls_first() for c in ["review_id", "star", "like", "dislike", "review_ts"]]
    return top_k(reviews(spark, d), 20, order, partition_by=["movie_id"]).select(*REVIEW_COLS)
