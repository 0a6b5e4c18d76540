"""Raw movie / actor / review text tables derived from the test tables.

The text columns are produced from numeric columns (see FIXTURES.md), so the
DuckDB oracle can compute the cleaned numbers directly from the same numbers
and a cleaning bug cannot hide on both sides. Every frame here is a plain
projection / broadcast-sized join of the parquet tables: its size grows with
``part`` and ``lineitem``.

Timestamps are TIMESTAMP_NTZ so that results do not depend on the session
time zone; streams cast them to TIMESTAMP before watermarking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour_of_2024(n) -> F.Column:
    """2024-01-01 00:00 plus ``n`` hours, as TIMESTAMP_NTZ."""
    return F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) \
        + F.make_dt_interval(hours=n.cast("int"))


def _s(c) -> F.Column:
    return c.cast("string")


def raw_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    movie_id = (F.when(k % 50 == 49, F.lit("{junk"))
                .otherwise(F.concat(F.lit("tt"), F.lpad(_s(k), 7, "0"))))
    vote = (F.when(k % 3 == 0, F.concat(_s(k % 30), F.lit("."), _s(size % 10), F.lit("M")))
            .when(k % 3 == 1, F.concat(_s(k % 900 + 1), F.lit("K")))
            .otherwise(_s(k % 999)))
    budget = (F.when(k % 10 == 0, F.lit(""))
              .when(k % 10 == 1, F.lit("DEM 2,300,000 (estimated)"))
              .otherwise(F.concat(F.lit("$"), _s(size), F.lit(","),
                                  F.lpad(_s(k % 1000), 3, "0"), F.lit(",000 (estimated)"))))
    revenue = (F.when(k % 7 == 0, F.lit(""))
               .otherwise(F.concat(F.lit("$"), _s((k * 37) % 400 + 1), F.lit(","),
                                   F.lpad(_s(size), 3, "0"), F.lit(",000"))))
    return (part.join(nation, F.col("n_nationkey") == k % 25)
            .select(movie_id.alias("movie_id"), F.col("p_name").alias("title"),
                    ((size % 40) / 4.0).cast("double").alias("rating"),
                    (F.lit(1950) + k % 75).cast("int").alias("year"),
                    vote.alias("vote_count"), F.col("n_name").alias("country"),
                    F.col("p_type").alias("language"), F.col("p_brand").alias("company"),
                    budget.alias("budget"), revenue.alias("revenue"),
                    _hour_of_2024(k % 24).alias("movie_ts")))


def raw_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (part.join(supplier, F.col("s_suppkey") == k % 10)
            .select(F.concat(F.lit("A00"), _s(k)).alias("actor_id"),
                    F.col("s_name").alias("director"),
                    F.concat(F.lit('["'), F.col("s_name"), F.lit('","'), F.col("p_brand"),
                             F.lit('"]')).alias("writers"),
                    F.concat(F.lit('["'), F.col("p_type"), F.lit('","'), F.col("p_brand"),
                             F.lit('","'), F.col("p_name"), F.lit('"]')).alias("stars"),
                    F.concat(F.lit("tt"), F.lpad(_s(k), 7, "0")).alias("movie_id"),
                    _hour_of_2024(k % 24).alias("actor_ts")))


def raw_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    ln = F.col("l_linenumber")
    seq = F.col("l_orderkey") * 10 + ln
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    star = F.when(q % 11 == 0, F.lit("")).otherwise(_s(q % 10 + 1))
    like = (F.when(q % 3 == 0, F.lit(""))
            .when(q % 3 == 1, F.concat(_s(q), F.lit(".5K")))
            .otherwise(F.concat(_s(ln * 7), F.lit(" "))))
    dislike = (F.when(q % 4 == 0, F.lit("")).when(q % 4 == 1, F.lit("1.2K"))
               .otherwise(_s(ln * 3)))
    return li.select(F.concat(F.lit("R00"), _s(seq)).alias("review_id"),
                     F.concat(F.lit("tt"), F.lpad(_s(F.col("l_partkey")), 7, "0")).alias("movie_id"),
                     star.alias("star"), like.alias("like"), dislike.alias("dislike"),
                     _hour_of_2024(seq % 48).alias("review_ts"))
