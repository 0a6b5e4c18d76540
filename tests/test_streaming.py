import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from titlepulse.operators import analytics as A
from titlepulse.plans.stream_queries import run_stream
from titlepulse.plans.core_queries import movies
from titlepulse.streaming import jobs as J
from titlepulse.streaming.runner import await_done, run_all, start
from titlepulse.streaming.sinks import parquet_batch_writer


def ms(hour):
    return int(datetime(2024, 1, 1, hour, tzinfo=timezone.utc).timestamp() * 1000)


def movie_msg(movie_id, hour, country="US"):
    rec = {"movie_id": movie_id, "title": movie_id, "rating": 8.0, "country": country,
           "language": "en", "revenue": "$100", "budget": "$40", "vote_count": "1K"}
    return ("k" + movie_id, json.dumps([rec]), "movie", ms(hour))


def write_file(spark, path, msgs):
    spark.createDataFrame(msgs, "key string, value string, topic string, ts_ms long") \
        .coalesce(1).write.mode("append").json(path)


def run(spark, src, out, ckpt, writer=None):
    stream = J.load_topic(spark, src, "movie", max_files_per_trigger=1)
    q = start(A.top_country(stream), writer or parquet_batch_writer(out), ckpt)
    await_done(q, 300)
    return q


def groups(spark, out):
    return sorted(r.movie_ts.hour for r in spark.read.parquet(out).collect())


def test_late_rows_restart_and_idempotence(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12)])  # watermark -> 11:50
    # Late rows are filtered with the previous batch's watermark, so 09:00 in
    # the batch right after the advance still counts ...
    write_file(spark, src, [movie_msg("c", 9), movie_msg("d", 13)])  # watermark -> 12:50
    # ... and 08:00 two batches later is dropped.
    write_file(spark, src, [movie_msg("e", 8), movie_msg("f", 15)])  # watermark -> 14:50
    q = run(spark, src, out, ckpt)
    dropped = sum(s.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for s in p.get("stateOperators", []))
    assert dropped == 1
    assert groups(spark, out) == [9, 10, 12, 13]  # 15:00 is still open
    # restart with no new data: nothing new
    run(spark, src, out, ckpt)
    assert groups(spark, out) == [9, 10, 12, 13]
    # new data moves the watermark past 15:00
    write_file(spark, src, [movie_msg("g", 17)])
    run(spark, src, out, ckpt)
    assert groups(spark, out) == [9, 10, 12, 13, 15]


def test_failing_sink_does_not_lose_the_batch(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12)])

    def broken(df, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(Exception):
        run(spark, src, out, ckpt, writer=broken)
    run(spark, src, out, ckpt)  # retried from the checkpoint
    assert groups(spark, out) == [10]


def test_sink_replay_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "out")
    w = parquet_batch_writer(out)
    df = spark.range(5)
    w(df, 3)
    w(df, 3)
    assert spark.read.parquet(out).count() == 5


def test_run_all_waits_for_every_query(spark, tmp_path):
    src = str(tmp_path / "in")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12)])
    qs = []
    for i in range(2):
        stream = J.load_topic(spark, src, "movie")
        qs.append(start(A.top_country(stream), parquet_batch_writer(str(tmp_path / f"o{i}")),
                        str(tmp_path / f"c{i}")))
    run_all(spark, qs, 300)
    assert all(not q.isActive for q in qs)


def test_stream_equals_batch_on_closed_groups(spark, sf):
    got = run_stream(spark, sf, "top_country")
    batch = A.ordered(A.top_country(movies(spark, sf)), "top_country")
    bound = batch.agg(F.max("movie_ts")).first()[0]
    from datetime import timedelta
    exp = batch.filter(F.col("movie_ts") <= F.lit(bound - timedelta(minutes=10)))
    key = lambda df: sorted((r.country, r.language, r.movie_ts, r.total_movie,
                             round(r.avg_rating, 6)) for r in df.collect())
    assert key(got) == key(exp)


def review_msg(review_id, movie_id, hour, minute, star="9"):
    rec = {"review_id": review_id, "movie_id": movie_id, "star": star, "like": "1K", "dislike": "2"}
    return ("k" + review_id, json.dumps([rec]), "review", ms(hour) + minute * 60000)


def test_time_bounded_join(spark, tmp_path):
    """Bounded and unbounded joins give the same closed groups when every
    review is within the bound of its movie; the bounded one drops join state
    and emits later (its output watermark lags by the bound)."""
    mv, rv = str(tmp_path / "movie"), str(tmp_path / "review")
    write_file(spark, mv, [movie_msg("a", 10), movie_msg("b", 11), movie_msg("z", 20)])
    write_file(spark, rv, [review_msg("r1", "a", 10, 30), review_msg("r2", "a", 10, 30),
                           review_msg("r3", "b", 11, 20), review_msg("r9", "z", 20, 10)])
    results, state_rows = {}, {}
    for bound in (None, "1 hour"):
        frames = {"movie": J.load_topic(spark, mv, "movie"), "review": J.load_topic(spark, rv, "review")}
        out = str(tmp_path / f"out_{bound}")
        q = start(A.top_user_sentiment(frames["review"], frames["movie"], time_bound=bound),
                  parquet_batch_writer(out), str(tmp_path / f"ck_{bound}"))
        await_done(q, 300)
        results[bound] = sorted((r.title, r.review_ts.hour, r.review_ts.minute, r.total_review)
                                for r in spark.read.parquet(out).collect())
        last = [p for p in q.recentProgress if p.get("stateOperators")][-1]
        state_rows[bound] = sum(o["numRowsTotal"] for o in last["stateOperators"]
                                if o.get("operatorName") == "symmetricHashJoin")
    assert results[None] == [("a", 10, 30, 2), ("b", 11, 20, 1)]
    assert results["1 hour"] == results[None]
    assert state_rows["1 hour"] < state_rows[None]


def test_batch_counts_are_observed(spark, tmp_path):
    counts = {}
    w = parquet_batch_writer(str(tmp_path / "o"), counts=counts)
    w(spark.range(7), 0)
    assert counts == {0: 7}


def test_processing_time_trigger_and_json_lines(spark, tmp_path):
    from titlepulse.streaming.sinks import write_json_lines
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12)])
    stream = J.load_topic(spark, src, "movie")
    q = start(stream.select("movie_id", "movie_ts"), parquet_batch_writer(out), str(tmp_path / "ck"),
              trigger="1 second")
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    assert sorted(r.movie_id for r in got.collect()) == ["a", "b"]
    write_json_lines(got.drop("batch_id"), str(tmp_path / "json"))
    back = spark.read.json(str(tmp_path / "json"))
    assert sorted(r.movie_id for r in back.collect()) == ["a", "b"]


def test_start_all_five(spark, sf, tmp_path):
    from titlepulse import fixtures as X
    raw = {"movie": X.raw_movie, "actor": X.raw_actor, "review": X.raw_review}
    paths = {}
    for kind, fn in raw.items():
        paths[kind] = str(tmp_path / "in" / kind)
        J.write_messages(fn(spark, sf), kind, paths[kind])
    qs = J.start_all(spark, paths, str(tmp_path / "out"), str(tmp_path / "ck"), state_partitions=4)
    run_all(spark, qs, 600)
    for name in J.INPUTS:
        assert spark.read.parquet(str(tmp_path / "out" / name)).count() > 0
    direct = run_stream(spark, sf, "top_director_rate")
    together = spark.read.parquet(str(tmp_path / "out" / "top_director_rate")).drop("batch_id")
    assert direct.count() == together.count()


def test_stream_into_jdbc(spark, tmp_path):
    from titlepulse.streaming.sinks import jdbc_batch_writer, jdbc_options
    src = str(tmp_path / "movie")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12)])
    opts = jdbc_options(f"jdbc:derby:{tmp_path / 'db'};create=true", "TOP_COUNTRY",
                        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    qs = J.start_all(spark, {"movie": src}, str(tmp_path / "out"), str(tmp_path / "ck"),
                     names=("top_country",), state_partitions=2,
                     writer_factory=lambda name: jdbc_batch_writer(opts))
    run_all(spark, qs, 300)
    rows = spark.read.format("jdbc").options(**opts).load().collect()
    assert len(rows) == 1  # the 10:00 group; 12:00 is still open


def test_jdbc_batches_replace_their_own_output(spark, tmp_path):
    from titlepulse.streaming.sinks import jdbc_batch_writer, jdbc_options

    opts = jdbc_options(f"jdbc:derby:{tmp_path / 'db2'};create=true", "RESULT",
                        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    write = jdbc_batch_writer(opts)
    five = spark.range(5).selectExpr("id", "id * 2 as v")
    write(five, 2)
    write(five, 3)
    write(five, 3)  # a replay
    read = lambda: spark.read.format("jdbc").options(**opts).load().groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in read()} == {2: 5, 3: 5}
    # One partition is written, another fails: a retry, or the reject path, leaves nothing of the first try.
    broken = spark.range(0, 4, 1, 2).selectExpr("id", "case when id = 3 then raise_error('bad') else id end as v")
    try:
        write(broken, 4)
        raise AssertionError("no error")
    except Exception as e:
        assert "bad" in str(e)
    write(five, 4)
    assert {r["batch_id"]: r["count"] for r in read()} == {2: 5, 3: 5, 4: 5}
    aside = jdbc_batch_writer(jdbc_options(opts["url"], "RESULT", driver=opts["driver"], nosuchoption="x"), "skip", str(tmp_path / "rejects"))
    odd = five.selectExpr("id", "cast(null as map<int,int>) as v")  # JDBC has no such type
    try:
        aside(odd, 5)
    except Exception:
        raise AssertionError("the batch should go aside") from None
    assert {r["batch_id"] for r in read()} == {2, 3, 4} and spark.read.parquet(str(tmp_path / "rejects")).count() == 5


def test_skipped_parquet_batch_goes_aside(spark, tmp_path):
    from titlepulse.streaming.sinks import parquet_batch_writer

    (tmp_path / "out").write_text("a file where the sink's folder should be")
    parquet_batch_writer(str(tmp_path / "out"), "skip", str(tmp_path / "rejects"))(spark.range(3), 1)
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 3


def test_streams_aggregate_before_they_join(spark, tmp_path):
    """One movie holds a third of the reviews; state keeps partial aggregates."""
    from titlepulse.operators import analytics as A

    review = spark.range(300).selectExpr("cast(id as string) review_id", "case when id % 3 = 0 then 'm0' else 'm' || (id % 7) end movie_id",
                                         "cast(id % 10 + 1 as int) star", "id as `like`", "cast(1 as bigint) dislike",
                                         "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id div 100 as int)) review_ts")
    movie = spark.range(7).selectExpr("'m' || id movie_id", "'t' || id title", "cast(7.5 as double) rating", "timestamp'2024-01-01 00:00:00' movie_ts")
    frames = {}
    for name, df, ts in (("review", review, "review_ts"), ("movie", movie, "movie_ts")):
        late = df.limit(1).withColumn(ts, F.expr("timestamp'2024-02-01 00:00:00'")).withColumn("movie_id", F.lit("none"))
        df.unionByName(late).write.parquet(str(tmp_path / name))
        frames[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / name)).withWatermark(ts, "10 minutes")
    plan = A.top_user_sentiment(frames["review"], frames["movie"])
    q = plan.writeStream.format("memory").queryName("eager_join").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.processAllAvailable()
    q.stop()
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert key(spark.table("eager_join")) == key(A.top_user_sentiment(review, movie))
    most = max(sum(s["numRowsTotal"] for s in p["stateOperators"] if "oin" in s["operatorName"]) for p in q.recentProgress if p["stateOperators"])
    assert most < 60


def test_yearly_ratings_keep_counts_in_join_state(spark, tmp_path):
    """Repeated reviews and movies count once; the join holds a row per movie and time, not per review."""
    review = spark.range(600).selectExpr("cast(id % 300 as string) review_id", "'m' || (id % 300 % 7) movie_id",
                                         "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 300 div 100 as int)) review_ts")
    movie = spark.range(14).selectExpr("'m' || id % 7 movie_id", "cast(2000 + id % 7 % 2 as int) year", "cast(id % 7 as double) rating",
                                       "timestamp'2024-01-01 00:00:00' movie_ts")
    frames = {}
    for name, df, ts in (("review", review, "review_ts"), ("movie", movie, "movie_ts")):
        late = df.limit(1).withColumn(ts, F.expr("timestamp'2024-02-01 00:00:00'")).withColumn("movie_id", F.lit("none"))
        df.unionByName(late).write.parquet(str(tmp_path / name))
        frames[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / name)).withWatermark(ts, "10 minutes")
    q = start(A.rating_per_year(frames["review"], frames["movie"]), parquet_batch_writer(str(tmp_path / "out")), str(tmp_path / "c"), state_partitions=2)
    await_done(q, 300)
    key = lambda d: sorted(map(tuple, d.select("year", "review_ts", "avg_rating", "total_movie", "total_review").collect()))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(A.rating_per_year(review, movie))
    most = max(sum(s["numRowsTotal"] for s in p["stateOperators"] if "oin" in s["operatorName"]) for p in q.recentProgress if p["stateOperators"])
    assert most < 60


def test_stream_queries_keep_state_off_the_heap(spark, sf, monkeypatch):
    from titlepulse.plans import stream_queries as S
    from titlepulse.streaming.runner import ROCKSDB

    seen = []

    def started(*a, **kw):
        q = start(*a, **kw)
        await_done(q, 300)
        seen.extend(k for p in q.recentProgress for s in p.get("stateOperators", []) for k in s["customMetrics"])
        return q

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    monkeypatch.setattr(S, "start", started)
    S.run_stream(spark, sf, "top_country")
    assert any(k.startswith("rocksdb") for k in seen)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before != ROCKSDB
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", None) is None


@pytest.mark.parametrize("key_order", [False, True])
def test_yearly_ratings_count_a_movie_once_per_batch(spark, tmp_path, key_order, monkeypatch):
    """Many event times of a movie make one row of join state in a micro-batch; reviews and movies with null fields count as in the batch."""
    from titlepulse.streaming.runner import ROCKSDB, SORTED_INSERTS

    monkeypatch.setattr(A, "COUNT_ROWS", 4096)
    review = spark.range(900).selectExpr("case when id % 300 = 5 then null else cast(id % 300 as string) end review_id",
                                         "case when id % 300 = 6 then null else 'm' || (id % 300 % 7) end movie_id",
                                         "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 300 % 48 as int)) review_ts")
    movie = spark.range(14).selectExpr("'m' || id % 7 movie_id", "cast(2000 + id % 7 % 2 as int) year", "case when id % 7 < 6 then cast(id % 7 as double) end rating",
                                       "timestamp'2024-01-01 00:00:00' movie_ts")
    frames = {}
    for name, df, ts in (("review", review, "review_ts"), ("movie", movie, "movie_ts")):
        late = df.limit(1).withColumn(ts, F.expr("timestamp'2024-02-01 00:00:00'")).withColumn("movie_id", F.lit("none"))
        df.unionByName(late).write.parquet(str(tmp_path / name))
        frames[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / name)).withWatermark(ts, "10 minutes")
    check = spark.conf.get("spark.sql.streaming.unsupportedOperationCheck")
    q = start(A.rating_per_year(frames["review"], frames["movie"], key_order=key_order), parquet_batch_writer(str(tmp_path / "out")), str(tmp_path / "c"),
              state_partitions=2, state_store=ROCKSDB if key_order else None, state_options=SORTED_INSERTS if key_order else None)
    await_done(q, 300)
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck") == check == "true"
    key = lambda d: sorted(map(tuple, d.select("year", "review_ts", "avg_rating", "total_movie", "total_review").collect()), key=str)
    got, want = key(spark.read.parquet(str(tmp_path / "out"))), key(A.rating_per_year(review, movie))
    assert got == [(*w[:2], None if w[2] is None else pytest.approx(w[2]), *w[3:]) for w in want] and sum(w[3] for w in want) == 299
    most = max(sum(s["numRowsTotal"] for s in p["stateOperators"] if "oin" in s["operatorName"]) for p in q.recentProgress if p["stateOperators"])
    assert most <= 2 * (8 + 8)
    # Sorted where the state is: the shuffles are those of the stateful operators, and one by movie.
    plan = q._jsq.explainInternal(False)
    assert plan.count("Sort [octet_length") == (3 if key_order else 0) and plan.count("Exchange hashpartitioning") == 5


def test_parquet_topics_hold_the_same_messages(spark, sf, tmp_path):
    """A topic in Parquet has the JSON lines' messages and gives the same records as a stream."""
    from titlepulse import fixtures as X
    from titlepulse.schemas import MESSAGE

    odd = spark.createDataFrame([("tt1", 'a "b" \\ \n ', None), ("tt2", None, 1.5)], "movie_id string, title string, rating double") \
        .selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' movie_ts")
    for name, records in (("raw", X.raw_movie(spark, sf)), ("odd", odd)):
        got = {}
        for fmt in ("json", "parquet"):
            path = str(tmp_path / name / fmt)
            J.write_messages(records, "movie", path, fmt)
            messages = spark.read.schema(MESSAGE).format(fmt).load(path)
            q = start(J.load_topic(spark, path, "movie", fmt=fmt), parquet_batch_writer(f"{path}-out"), f"{path}-ck")
            await_done(q, 300)
            got[fmt] = [sorted(map(repr, d.collect())) for d in (messages.select("key", "value", "topic", "ts_ms"), spark.read.parquet(f"{path}-out"))]
        assert got["json"] == got["parquet"] and got["json"][1]
