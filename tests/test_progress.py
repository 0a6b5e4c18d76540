"""Moving time: state that expires, and the table of the streams' progress."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from titlepulse.operators import analytics as A
from titlepulse.streaming import jobs as J
from titlepulse.streaming.late import ROCKSDB
from titlepulse.streaming.progress import ProgressTable, progress_row, progress_table
from titlepulse.streaming.runner import await_done, run_all, start
from titlepulse.streaming.sinks import parquet_batch_writer

HOURS = 14


def at(hour, minute=0):
    return int(datetime(2024, 1, 1, hour, minute, tzinfo=timezone.utc).timestamp() * 1000)


def write(spark, path, kind, when, records):
    spark.createDataFrame([("k", json.dumps(records), kind, when)], "key string, value string, topic string, ts_ms long") \
        .coalesce(1).write.mode("append").json(path)


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    """One file an hour: two movies, and reviews of which a third are of one
    movie and some come twice."""
    base = tmp_path_factory.mktemp("topics")
    mv, rv = str(base / "movie"), str(base / "review")
    for h in range(HOURS):
        write(spark, mv, "movie", at(h), [{"movie_id": f"m{h}-{k}", "title": "t", "rating": 5.0 + k, "year": "2000",
                                           "revenue": "odd" if h == 3 else "$5", "budget": "$1"} for k in range(2)])
        reviews = [{"review_id": f"r{h}-{i}", "movie_id": f"m{h}-{int(i % 3 > 0)}", "star": "9", "like": "1", "dislike": "1"} for i in range(30)]
        write(spark, rv, "review", at(h, 5), reviews + reviews[:4])
    return {"movie": mv, "review": rv}


def moved(spark, topics, base, expiring):
    """Run hour by hour; state rows after each batch, and the result."""
    options = {"time_bound": "30 minutes", "dedupe_within_watermark": True} if expiring else {}
    frames = {k: J.load_topic(spark, topics[k], k, max_files_per_trigger=1) for k in ("movie", "review")}
    q = start(J.build("rating_per_year", frames, **options), parquet_batch_writer(f"{base}/out"), f"{base}/ck",
              state_partitions=2, state_store=ROCKSDB if expiring else None)
    await_done(q, 600)
    states = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress if p.get("stateOperators")]
    return states, {r["review_ts"]: (r["avg_rating"], r["total_movie"], r["total_review"]) for r in spark.read.parquet(f"{base}/out").collect()}


def test_state_expires_and_closed_groups_equal_batch(spark, topics, tmp_path):
    grown, _ = moved(spark, topics, tmp_path / "a", False)
    bounded, got = moved(spark, topics, tmp_path / "b", True)
    # Without expiry state grows with the hours; with it, it holds the last few of them.
    hour = 30 + 2 + 2 + 2
    assert grown[-1] >= HOURS * 30 and max(bounded) <= 4 * hour and max(bounded[HOURS // 2:]) <= max(bounded[:HOURS // 2]) + hour
    ts = lambda h: datetime.fromtimestamp(at(h, 5) / 1000)
    whole = {ts(h): (pytest.approx((10 * 5.0 + 20 * 6.0) / 30), 30, 30) for h in range(HOURS)}
    assert got == {t: whole[t] for t in got}
    # The last watermark, ten minutes behind 13:00, less the bound closes all up to 12:05.
    assert set(got) >= {ts(h) for h in range(HOURS - 2)}


def test_progress_table_of_all_five(spark, topics, tmp_path):
    actors = str(tmp_path / "actor")
    for h in (1, 12, 2):
        write(spark, actors, "actor", at(h), [{"actor_id": f"a{h}", "director": "d", "writers": "[]", "stars": "[]", "movie_id": f"m{h}-0"}])
    listener = ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        qs = J.start_all(spark, {**topics, "actor": actors}, str(tmp_path / "out"), str(tmp_path / "ck"), state_partitions=2)
        run_all(spark, qs, 600)
        # Reports are delivered after their batches.
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert listener.errors == []
    table = progress_table(spark, listener.path)
    assert table.groupBy("id", "batch_id").count().filter("count > 1").count() == 0
    rows = {r["query"]: r for r in table.groupBy("query").agg(F.sum("input_rows").alias("n"), F.max("state_rows").alias("s"),
                                                               F.sum(F.col("rejected")["movie.revenue"]).alias("bad")).collect()}
    assert set(rows) == set(J.INPUTS)
    assert rows["top_country"]["n"] == HOURS and rows["top_user_sentiment"]["n"] == 2 * HOURS
    assert all(r["s"] > 0 for r in rows.values())
    assert rows["top_country"]["bad"] == 2  # both movies of 03:00


def test_late_rows_and_state_in_the_row():
    p = {"name": "q", "id": "x", "batchId": 4, "timestamp": "t", "eventTime": {"watermark": "w"}, "sources": [{"numInputRows": 3}, {"numInputRows": 4}],
         "stateOperators": [{"numRowsDroppedByWatermark": 2, "numRowsTotal": 5, "memoryUsedBytes": 7}, {"numRowsTotal": 1}],
         "observedMetrics": {"rejects_review": {"rejected_star": 2, "rejected_like": None}, "other": {"n": 1}}}
    assert progress_row(p) == ("q", "x", 4, "t", "w", 7, 2, 6, 7, {"review.star": 2})
    assert progress_row({"id": "x", "batchId": 0})[5:] == (0, 0, 0, 0, {})
