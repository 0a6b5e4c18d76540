"""The five result tables, for batch and streaming frames.

Batch plans aggregate the big review / actor side *before* the join
("eager aggregation"): reviews are reduced map-side to one row per
(movie_id, event time) and only that reduced frame meets the movie table. The
result is exactly the join-then-aggregate result (sums and counts distribute
over the join's row multiplication), but the shuffle shrinks from all reviews
to the partial aggregates, and a movie holding a third of all reviews is
collapsed by the map-side combine instead of landing in one join task.

No broadcast hints: whether the movie side is broadcast is decided by
``spark.sql.autoBroadcastJoinThreshold`` on its estimated size and re-decided
by AQE on the real shuffle size, with a sort-merge join (and AQE skew-join
splitting) beyond the threshold.

Streaming frames are reduced before the join as well, which keeps the partial
aggregates in join state instead of every review; ``rating_per_year`` removes
its duplicates on each side, so that it can do the same, and counts the
reviews of a movie within each micro-batch, without state of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.functions.labels import sentiment_indicators
from titlepulse.schemas import RESULT_COLUMNS


def _eager(pre_aggregate: bool | None) -> bool:
    return True if pre_aggregate is None else pre_aggregate


def with_movie(left: DataFrame, movie: DataFrame, cols: list[str], ts: str,
               time_bound: str | None = None, movie_ts: str = "movie_ts") -> DataFrame:
    """Inner join on movie_id, keeping ``cols`` of the movie.

    Streams: without ``time_bound`` this is the original unbounded
    stream-stream join (state is never dropped). With e.g. ``"2 hours"`` the
    join also requires |ts - movie_ts| <= time_bound, so Spark can drop state
    rows once the watermarks pass them; a record arriving later than that
    after its movie no longer joins.
    """
    if time_bound is None or not (left.isStreaming and movie.isStreaming):
        return left.join(movie.select("movie_id", *cols), "movie_id")
    m = movie.select(F.col("movie_id").alias("_mid"), F.col(movie_ts).alias("_mts"), *cols)
    bound = F.expr(f"INTERVAL {time_bound}")
    cond = ((F.col("movie_id") == F.col("_mid")) & (F.col(ts) >= F.col("_mts") - bound)
            & (F.col(ts) <= F.col("_mts") + bound))
    return left.join(m, cond).drop("_mid", "_mts")


def _weighted_avg(x: str, w: str) -> F.Column:
    """avg(x) over rows repeated w times (nulls of x skipped, as avg does)."""
    return F.sum(F.col(x) * F.col(w)) / F.sum(F.when(F.col(x).isNotNull(), F.col(w)))


# ---------------------------------------------------------------- top_country
def top_country(movie: DataFrame, ts: str = "movie_ts") -> DataFrame:
    profit = F.when(F.col("revenue") > 0, F.col("revenue") - F.col("budget")).otherwise(0)
    return (movie.groupBy("country", "language", ts)
            .agg(F.avg("rating").alias("avg_rating"),
                 F.sum("revenue").alias("total_revenue"),
                 F.count("movie_id").alias("total_movie"),
                 F.sum("budget").alias("total_budget"),
                 F.avg(profit).alias("avg_profit")))


# --------------------------------------------------------- top_user_sentiment
def top_user_sentiment(review: DataFrame, movie: DataFrame, ts: str = "review_ts",
                       pre_aggregate: bool | None = None, time_bound: str | None = None) -> DataFrame:
    if _eager(pre_aggregate):
        part = (review.groupBy("movie_id", ts)
                .agg(F.count("review_id").alias("_n"), F.sum("like").alias("_l"),
                     F.sum("dislike").alias("_d")))
        g = with_movie(part, movie, ["title", "rating"], ts, time_bound).groupBy("title", "rating", ts)
        n, like, dislike = F.sum("_n"), F.sum("_l"), F.sum("_d")
    else:
        g = with_movie(review, movie, ["title", "rating"], ts, time_bound).groupBy("title", "rating", ts)
        n, like, dislike = F.count("review_id"), F.sum("like"), F.sum("dislike")
    out = g.agg(n.alias("total_review"), like.alias("total_like"), dislike.alias("total_dislike"))
    total = F.col("total_like") + F.col("total_dislike")
    return out.withColumn("like_ratio", F.when(total > 0, F.col("total_like") / total)
                          .otherwise(F.lit(0.0)))


# ---------------------------------------------------------- top_director_rate
def top_director_rate(actor: DataFrame, movie: DataFrame, ts: str = "actor_ts",
                      pre_aggregate: bool | None = None, time_bound: str | None = None,
                      dedupe: bool = False) -> DataFrame:
    """avg rating, movie count and revenue per (director, ts), counted per
    credit record. A replayed topic repeats records and inflates the counts;
    ``dedupe=True`` keeps one record per (actor_id, movie_id) first (batch:
    the one with the smallest ts)."""
    if dedupe:
        from titlepulse.operators.dedupe import dedupe_latest
        actor = dedupe_latest(actor, ["actor_id", "movie_id"], [ts])
    if _eager(pre_aggregate):
        part = actor.groupBy("movie_id", "director", ts).agg(F.count(F.lit(1)).alias("_w"))
        return (with_movie(part, movie, ["rating", "revenue"], ts, time_bound).groupBy("director", ts)
                .agg(_weighted_avg("rating", "_w").alias("avg_rating"),
                     F.sum("_w").alias("total_movies"),
                     F.sum(F.col("revenue") * F.col("_w")).alias("total_revenue")))
    return (with_movie(actor, movie, ["rating", "revenue"], ts, time_bound).groupBy("director", ts)
            .agg(F.avg("rating").alias("avg_rating"), F.count("movie_id").alias("total_movies"),
                 F.sum("revenue").alias("total_revenue")))


# ------------------------------------------------------------ rating_per_year
#: Reviews that ``_counts_per_movie`` holds at once; the most entries of one row's lists.
COUNT_ROWS = 1 << 17


def _in_key_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Dealt out as a stateful operator on ``keys`` deals its rows, in the
    order of its store's keys (lengths come first there), so that new keys go
    in one after the other and the store's files need no merging."""
    return df.repartition(*keys).sortWithinPartitions(*[F.octet_length(k) for k in keys], *keys)


def _counts_per_movie(review: DataFrame, ts: str) -> DataFrame:
    """movie_id and lists of _ts, _w (rows) and _r (review ids): one row per
    movie and run of ``COUNT_ROWS`` rows of a partition of a micro-batch."""
    most = COUNT_ROWS

    def count(batches):
        import pyarrow as pa

        def counted(held):
            t = pa.Table.from_batches(held)
            t = t.group_by(["movie_id", "_ts"], use_threads=False).aggregate([([], "count_all"), ("review_id", "count")])
            t = t.rename_columns(["movie_id", "_ts", "_w", "_r"])
            t = t.group_by(["movie_id"], use_threads=False).aggregate([(c, "list") for c in ("_ts", "_w", "_r")])
            return t.rename_columns(["movie_id", "_ts", "_w", "_r"]).to_batches(max_chunksize=10_000)

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= most:
                yield from counted(held)
                held, n = [], 0
        if n:
            yield from counted(held)

    rows = review.select("movie_id", "review_id", F.col(ts).alias("_ts"))
    return rows.mapInArrow(count, "movie_id string, _ts array<timestamp>, _w array<bigint>, _r array<bigint>")


def rating_per_year(review: DataFrame, movie: DataFrame, ts: str = "review_ts",
                    pre_aggregate: bool | None = None, time_bound: str | None = None,
                    dedupe_within_watermark: bool = False, key_order: bool = False) -> DataFrame:
    """Join, keep one row per (review_id, movie_id), then by (year, ts).

    avg_rating is weighted by review; total_movie counts rows, not distinct
    movies (it equals total_review), as in the original job.

    Batch: the surviving row of a duplicate group is the smallest
    (ts, year, rating), which is what min over the review duplicates paired
    with min over the movie duplicates gives, so both sides are reduced before
    the join.

    Streams: repeated reviews and movies go before the join, the first that
    came stays, and reviews meet the movies as counts: one row per movie and
    micro-batch, which lists them by event time.
    ``dedupe_within_watermark`` forgets ids that the watermark passed; with a
    ``time_bound`` as well every state of the plan expires: ids and open
    groups behind the watermark, join rows behind the watermark and the bound;
    counts are then rows per (movie_id, ts), kept until the watermark passes.
    ``key_order`` sorts a micro-batch's rows by the keys of the state they go
    into; Spark refuses any sort in a stream, so it is for a stream started
    with ``runner.SORTED_INSERTS``.
    """
    if review.isStreaming and movie.isStreaming and pre_aggregate is None:
        def once(df: DataFrame, keys: list[str]) -> DataFrame:
            if key_order:
                df = _in_key_order(df, keys)
            return df.dropDuplicatesWithinWatermark(keys) if dedupe_within_watermark else df.dropDuplicates(keys)

        r = once(review.select("review_id", "movie_id", ts), ["review_id", "movie_id"])
        m = once(movie, ["movie_id"])
        if time_bound is None:
            counts = _counts_per_movie(_in_key_order(r, ["movie_id"]) if key_order else r.repartition("movie_id"), ts)
            j = with_movie(counts, m, ["year", "rating"], ts).select("year", "rating", F.inline(F.arrays_zip("_ts", "_w", "_r")))
            # The times in the lists are the reviews' own, so they are under the reviews' watermark.
            j = j.select("year", "rating", "_w", "_r", F.col("_ts").alias(ts, metadata=review.schema[ts].metadata))
        else:
            r = r.groupBy("movie_id", ts).agg(F.count(F.lit(1)).alias("_w"), F.count("review_id").alias("_r"))
            j = with_movie(r, m, ["year", "rating"], ts, time_bound)
        return (j.groupBy("year", ts)
                .agg(_weighted_avg("rating", "_w").alias("avg_rating"),
                     F.sum("_w").alias("total_movie"), F.sum("_r").alias("total_review")))
    if not (not review.isStreaming if pre_aggregate is None else pre_aggregate):
        j = with_movie(review, movie, ["year", "rating"], ts, time_bound)
        keys = ["review_id", "movie_id"]
        j = (j.dropDuplicatesWithinWatermark(keys) if dedupe_within_watermark and j.isStreaming
             else j.dropDuplicates(keys))
        return (j.groupBy("year", ts)
                .agg(F.avg("rating").alias("avg_rating"), F.count("movie_id").alias("total_movie"),
                     F.count("review_id").alias("total_review")))
    r = review.groupBy("review_id", "movie_id").agg(F.min(ts).alias(ts))
    r = (r.groupBy("movie_id", ts)
         .agg(F.count(F.lit(1)).alias("_w"), F.count("review_id").alias("_r")))
    m = (movie.groupBy("movie_id").agg(F.min(F.struct("year", "rating")).alias("_m"))
         .select("movie_id", "_m.year", "_m.rating"))
    return (r.join(m, "movie_id").groupBy("year", ts)
            .agg(_weighted_avg("rating", "_w").alias("avg_rating"),
                 F.sum("_w").alias("total_movie"), F.sum("_r").alias("total_review")))


# --------------------------------------------------------------- top_sentiment
def top_sentiment(review: DataFrame, movie: DataFrame, ts: str = "review_ts",
                  dedupe: bool = False, pre_aggregate: bool | None = None,
                  time_bound: str | None = None) -> DataFrame:
    """Review count and Positive / Negative / Neutral sums per (title, year, rating, ts).

    The original job built a review_id-deduplicated frame and then aggregated
    the frame *without* it, so duplicates count; ``dedupe=True`` aggregates the
    deduplicated frame (batch: the surviving row is the smallest
    (movie_id, ts, star, like, dislike, title, year, rating)).
    """
    keys = ["title", "year", "rating", ts]
    ind = review.select("*", *sentiment_indicators("star"))
    if dedupe and (review.isStreaming or movie.isStreaming):
        j = with_movie(ind, movie, ["title", "year", "rating"], ts, time_bound)
        g = j.dropDuplicates(["review_id"]).groupBy(*keys)
        cnt, pos, neg, neu = (F.count("review_id"), F.sum("Positive"), F.sum("Negative"),
                              F.sum("Neutral"))
    elif dedupe:
        # Survivor = smallest joined (movie_id, ts, star, like, dislike, title,
        # year, rating). The review fields lead, and once movies are reduced to
        # their smallest (title, year, rating) per id the rest follows from
        # movie_id, so the narrow review rows are deduplicated *before* the
        # join; only reviews whose movie exists compete (semi join), as in an
        # inner join. The indicators follow from star.
        order = ["movie_id", ts, "star", "like", "dislike"]
        cand = review.join(movie.select("movie_id"), "movie_id", "left_semi")
        r = (cand.groupBy("review_id").agg(F.min(F.struct(*order)).alias("_r"))
             .select("review_id", "_r.*"))
        m1 = (movie.groupBy("movie_id").agg(F.min(F.struct("title", "year", "rating")).alias("_m"))
              .select("movie_id", "_m.*"))
        j = r.join(m1, "movie_id").select("*", *sentiment_indicators("star"))
        g = j.groupBy(*keys)
        cnt, pos, neg, neu = (F.count("review_id"), F.sum("Positive"), F.sum("Negative"),
                              F.sum("Neutral"))
    elif _eager(pre_aggregate):
        part = (ind.groupBy("movie_id", ts)
                .agg(F.count("review_id").alias("_n"), F.sum("Positive").alias("_p"),
                     F.sum("Negative").alias("_ng"), F.sum("Neutral").alias("_nu")))
        g = with_movie(part, movie, ["title", "year", "rating"], ts, time_bound).groupBy(*keys)
        cnt, pos, neg, neu = F.sum("_n"), F.sum("_p"), F.sum("_ng"), F.sum("_nu")
    else:
        g = with_movie(ind, movie, ["title", "year", "rating"], ts, time_bound).groupBy(*keys)
        cnt, pos, neg, neu = (F.count("review_id"), F.sum("Positive"), F.sum("Negative"),
                              F.sum("Neutral"))
    return g.agg(cnt.alias("total_review"), pos.alias("Positive"), neg.alias("Negative"),
                 neu.alias("Neutral"))


def ordered(df: DataFrame, name: str) -> DataFrame:
    """Project a result to its documented column order."""
    return df.select(*RESULT_COLUMNS[name])
