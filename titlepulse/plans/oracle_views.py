"""DuckDB CTEs for the oracle side.

``*_num`` views compute the *cleaned* values straight from the numeric
columns of the test tables (see FIXTURES.md), never from the text, so the
Spark cleaning is checked against an independent derivation. ``raw_*`` views
are the text tables, for operators that work on text.
"""

RAW_MOVIE = """raw_movie AS (
  SELECT CASE WHEN p_partkey % 50 = 49 THEN '{junk'
              ELSE concat('tt', lpad(cast(p_partkey AS varchar), 7, '0')) END AS movie_id,
    p_name AS title, cast((p_size % 40) / 4.0 AS double) AS rating,
    cast(1950 + p_partkey % 75 AS integer) AS year,
    CASE p_partkey % 3
      WHEN 0 THEN concat(cast(p_partkey % 30 AS varchar), '.', cast(p_size % 10 AS varchar), 'M')
      WHEN 1 THEN concat(cast(p_partkey % 900 + 1 AS varchar), 'K')
      ELSE cast(p_partkey % 999 AS varchar) END AS vote_count,
    n_name AS country, p_type AS language, p_brand AS company,
    CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'DEM 2,300,000 (estimated)'
      ELSE concat('$', cast(p_size AS varchar), ',', lpad(cast(p_partkey % 1000 AS varchar), 3, '0'),
                  ',000 (estimated)') END AS budget,
    CASE WHEN p_partkey % 7 = 0 THEN ''
      ELSE concat('$', cast((p_partkey * 37) % 400 + 1 AS varchar), ',',
                  lpad(cast(p_size AS varchar), 3, '0'), ',000') END AS revenue,
    timestamp '2024-01-01 00:00:00' + (p_partkey % 24) * interval '1' hour AS movie_ts,
    p_partkey
  FROM part JOIN nation ON n_nationkey = p_partkey % 25
)"""

MOVIE_NUM = """movie_num AS (
  SELECT concat('tt', lpad(cast(p_partkey AS varchar), 7, '0')) AS movie_id,
    p_name AS title, cast((p_size % 40) / 4.0 AS double) AS rating,
    cast(1950 + p_partkey % 75 AS integer) AS year,
    cast(CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 30) * 1000000 + (p_size % 10) * 100000
              WHEN 1 THEN (p_partkey % 900 + 1) * 1000 ELSE 0 END AS bigint) AS vote_count,
    n_name AS country, p_type AS language, p_brand AS company,
    cast(CASE WHEN p_partkey % 10 = 0 THEN 0 WHEN p_partkey % 10 = 1 THEN NULL
              ELSE p_size * 1000000 + (p_partkey % 1000) * 1000 END AS bigint) AS budget,
    cast(CASE WHEN p_partkey % 7 = 0 THEN 0
              ELSE ((p_partkey * 37) % 400 + 1) * 1000000 + p_size * 1000 END AS bigint) AS revenue,
    timestamp '2024-01-01 00:00:00' + (p_partkey % 24) * interval '1' hour AS movie_ts
  FROM part JOIN nation ON n_nationkey = p_partkey % 25
  WHERE p_partkey % 50 <> 49
)"""

RAW_ACTOR = """raw_actor AS (
  SELECT concat('A00', cast(p_partkey AS varchar)) AS actor_id, s_name AS director,
    concat('["', s_name, '","', p_brand, '"]') AS writers,
    concat('["', p_type, '","', p_brand, '","', p_name, '"]') AS stars,
    concat('tt', lpad(cast(p_partkey AS varchar), 7, '0')) AS movie_id,
    timestamp '2024-01-01 00:00:00' + (p_partkey % 24) * interval '1' hour AS actor_ts,
    s_name, p_brand, p_type, p_name, p_partkey
  FROM part JOIN supplier ON s_suppkey = p_partkey % 10
)"""

ACTOR_NUM = """actor_num AS (
  SELECT actor_id, director, concat(s_name, ',', p_brand) AS writers,
    concat(p_type, ',', p_brand, ',', p_name) AS stars, movie_id, actor_ts
  FROM raw_actor
)"""

RAW_REVIEW = """raw_review AS (
  SELECT concat('R00', cast(l_orderkey * 10 + l_linenumber AS varchar)) AS review_id,
    concat('tt', lpad(cast(l_partkey AS varchar), 7, '0')) AS movie_id,
    CASE WHEN cast(l_quantity AS int) % 11 = 0 THEN ''
      ELSE cast(cast(l_quantity AS int) % 10 + 1 AS varchar) END AS star,
    CASE cast(l_quantity AS int) % 3 WHEN 0 THEN ''
      WHEN 1 THEN concat(cast(cast(l_quantity AS int) AS varchar), '.5K')
      ELSE concat(cast(l_linenumber * 7 AS varchar), ' ') END AS "like",
    CASE cast(l_quantity AS int) % 4 WHEN 0 THEN '' WHEN 1 THEN '1.2K'
      ELSE cast(l_linenumber * 3 AS varchar) END AS dislike,
    timestamp '2024-01-01 00:00:00'
      + ((l_orderkey * 10 + l_linenumber) % 48) * interval '1' hour AS review_ts
  FROM lineitem
)"""

REVIEW_NUM = """review_num AS (
  SELECT concat('R00', cast(l_orderkey * 10 + l_linenumber AS varchar)) AS review_id,
    concat('tt', lpad(cast(l_partkey AS varchar), 7, '0')) AS movie_id,
    cast(CASE WHEN cast(l_quantity AS int) % 11 = 0 THEN 0
              ELSE cast(l_quantity AS int) % 10 + 1 END AS integer) AS star,
    cast(CASE cast(l_quantity AS int) % 3 WHEN 0 THEN 0
              WHEN 1 THEN cast(l_quantity AS int) * 1000 + 500
              ELSE l_linenumber * 7 END AS bigint) AS "like",
    cast(CASE cast(l_quantity AS int) % 4 WHEN 0 THEN 0 WHEN 1 THEN 1200
              ELSE l_linenumber * 3 END AS bigint) AS dislike,
    timestamp '2024-01-01 00:00:00'
      + ((l_orderkey * 10 + l_linenumber) % 48) * interval '1' hour AS review_ts
  FROM lineitem
)"""

# Sentiment name and number (same thresholds as titlepulse.schemas).
SENTIMENT_SQL = ("CASE WHEN star >= 8 THEN 'Positive' WHEN star >= 5 THEN 'Neutral' "
                 "ELSE 'Negative' END")
LABEL_SQL = "CASE WHEN star >= 8 THEN 1 WHEN star >= 5 THEN 2 ELSE 0 END"


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
