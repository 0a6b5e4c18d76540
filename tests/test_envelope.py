from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.operators.clean import clean_movie
from titlepulse.schemas import MOVIE, REVIEW
from titlepulse.sources.envelope import pack_envelope, parse_envelope, to_message_rows


def msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").withColumn(
        "timestamp", F.current_timestamp())


def test_parse_edge_cases(spark):
    assert parse_envelope(msgs(spark, ["garbage", '[{"movie_id": "tt1"', "[]"]), MOVIE).count() == 0
    one = parse_envelope(msgs(spark, ['{"movie_id": "tt1", "year": "1994"}']), MOVIE).collect()
    assert len(one) == 1 and one[0].movie_id == "tt1" and one[0].year == "1994"
    two = parse_envelope(msgs(spark, ['[{"movie_id": "a", "year": 1999, "rating": 9.3}, {"movie_id": "b"}]']),
                         MOVIE)
    cleaned = clean_movie(two).orderBy("movie_id").collect()
    assert [(r.movie_id, r.year, r.rating) for r in cleaned] == [("a", 1999, 9.3), ("b", None, None)]


def test_pack_parse_round_trip(spark, sf):
    raw = X.raw_review(spark, sf)
    packed = pack_envelope(raw, "review", ["review_id", "movie_id"], 100, group_cols=("review_ts",))
    stats = packed.groupBy("review_ts").agg(
        F.max("n_records").alias("mx"), F.sum(F.when(F.col("n_records") < 100, 1).otherwise(0)).alias("partial"))
    assert stats.filter((F.col("mx") > 100) | (F.col("partial") > 1)).count() == 0
    assert stats.count() == raw.select("review_ts").distinct().count()
    back = parse_envelope(to_message_rows(packed, "review_ts").withColumn(
        "timestamp", F.timestamp_millis("ts_ms")), REVIEW, "timestamp", "review_ts")
    got = back.select("review_id", "movie_id", "star", "like", "dislike",
                      F.col("review_ts").cast("timestamp_ntz").alias("review_ts"))
    assert got.exceptAll(raw).count() == 0 and raw.exceptAll(got).count() == 0
    # every key is the hash of its value, so a resend of a message has the same key
    assert packed.filter(F.col("key") != F.sha2("value", 256)).count() == 0


def test_pack_fills_messages_in_key_order(spark):
    """Over several partitions, with repeated and null keys and a hot group:
    every message but a group's last is full, and messages follow the keys."""
    rows = [(None if i % 50 == 0 else f"k{i % 700:04d}", i, "hot" if i % 3 else f"g{i % 4}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, g string").repartition(7)
    for group in ((), ("g",)):
        got = pack_envelope(df, "t", ["k", "v"], 30, group_cols=group).collect()
        want: dict = {}
        for k, v, g in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
            want.setdefault(g if group else "", []).append((k, v))
        chunks = {(g, n): x[30 * n: 30 * n + 30] for g, x in want.items() for n in range(-(-len(x) // 30))}
        assert {(r["g"] if group else "", r.msg_no): (r.n_records, r.first_id, r.last_id) for r in got} == {
            at: (len(c), c[0][0], c[-1][0]) for at, c in chunks.items()}
    assert pack_envelope(df.limit(0), "t", ["k", "v"], 30).count() == 0


def test_numbering_broadcasts_the_small_side(spark):
    from titlepulse.sources.envelope import numbered

    rows = spark.range(100).selectExpr("cast(id as string) k", "id % 3 g")
    df = numbered(rows, ["k"], ("g",))
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.g, r._rn) for r in df.collect()) == sorted((g, n) for g in range(3) for n in range(34 if g == 0 else 33))
