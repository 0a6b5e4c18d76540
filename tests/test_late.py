"""Late rows kept aside: late plus closed plus open rows are all rows, over batches, restarts and a join."""
import json

from pyspark.sql import functions as F

from test_streaming import movie_msg, ms, write_file
from titlepulse.operators import analytics as A
from titlepulse.streaming import jobs as J
from titlepulse.streaming import late as L
from titlepulse.streaming.runner import await_done, start
from titlepulse.streaming.sinks import parquet_batch_writer


def run(spark, src, tmp, kind="movie"):
    stream = J.load_topic(spark, src, kind, max_files_per_trigger=1)
    split = L.split_late(stream, f"{kind}_ts", ["movie_id"], buckets=3)
    writer = L.side_writer(stream.schema, parquet_batch_writer(f"{tmp}/closed"), parquet_batch_writer(f"{tmp}/late"))
    await_done(start(split, writer, f"{tmp}/ck", state_partitions=2, state_store=L.ROCKSDB), 300)


def ids(spark, path):
    return sorted(r["movie_id"] for r in spark.read.parquet(path).collect())


def test_every_row_once(spark, tmp_path):
    src = str(tmp_path / "in")
    write_file(spark, src, [movie_msg("a", 10), movie_msg("b", 12), movie_msg("b2", 12)])
    write_file(spark, src, [movie_msg("c", 13)])
    write_file(spark, src, [movie_msg("late1", 8), movie_msg("d", 15)])
    run(spark, src, tmp_path)
    assert ids(spark, f"{tmp_path}/late") == ["late1"]
    assert ids(spark, f"{tmp_path}/closed") == ["a", "b", "b2", "c"]  # d is open
    # Restart: the open row is in state, more late rows come.
    write_file(spark, src, [movie_msg("late2", 9), movie_msg("late3", 13), movie_msg("e", 20)])
    run(spark, src, tmp_path)
    assert ids(spark, f"{tmp_path}/late") == ["late1", "late2", "late3"]
    assert ids(spark, f"{tmp_path}/closed") == ["a", "b", "b2", "c", "d"]
    # Closed rows of a time leave together, so a batch function on them is complete.
    closed = spark.read.parquet(f"{tmp_path}/closed")
    assert closed.groupBy("movie_ts").agg(F.count_distinct("batch_id").alias("n")).filter("n > 1").isEmpty()
    assert A.top_country(closed.drop("batch_id")).count() == 4  # one group per closed time
    assert spark.read.parquet(f"{tmp_path}/late").filter("title is null or rating <> 8.0").isEmpty()


def review_msg(review_id, movie_id, hour, star="8"):
    rec = {"review_id": review_id, "movie_id": movie_id, "star": star, "like": "3", "dislike": "1", "date": "Jan 1, 2024", "user_name": "u"}
    return ("k" + review_id, json.dumps([rec]), "review", ms(hour))


def test_late_rows_at_a_join(spark, tmp_path):
    """Closed and late rows of both sides make up the whole join; the closed ones alone miss what came late."""
    movies, reviews = str(tmp_path / "m"), str(tmp_path / "r")
    write_file(spark, movies, [movie_msg("a", 10), movie_msg("b", 14)])
    write_file(spark, movies, [movie_msg("end", 22)])
    write_file(spark, movies, [movie_msg("c", 11), movie_msg("end2", 23)])
    write_file(spark, reviews, [review_msg("r1", "a", 10), review_msg("r2", "b", 15)])
    write_file(spark, reviews, [review_msg("r9", "end", 22)])
    write_file(spark, reviews, [review_msg("r3", "a", 9), review_msg("r4", "c", 12), review_msg("r10", "end2", 23)])
    run(spark, movies, tmp_path / "mo")
    run(spark, reviews, tmp_path / "ro", "review")
    read = lambda part: spark.read.parquet(f"{tmp_path}/{part}").drop("batch_id")
    closed = read("ro/closed").join(read("mo/closed"), "movie_id")
    assert sorted(r["review_id"] for r in closed.collect()) == ["r1", "r2", "r9"]
    both = read("ro/closed").unionByName(read("ro/late")).join(read("mo/closed").unionByName(read("mo/late")), "movie_id")
    assert sorted(r["review_id"] for r in both.collect()) == ["r1", "r2", "r3", "r4", "r9"]


class _Map(dict):
    calls = 0

    def containsKey(self, k):
        _Map.calls += 1
        return k in self

    def getValue(self, k):
        _Map.calls += 1
        return self[k]

    def updateValue(self, k, v):
        _Map.calls += 1
        self[k] = v

    def removeKey(self, k):
        _Map.calls += 1
        del self[k]


class _Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return _Map()

    def registerTimer(self, at):
        self.timers.append(at)


class _Timer:
    def __init__(self, at):
        self.getExpiryTimeInMs = lambda: at
        self.getCurrentWatermarkInMs = lambda: 5


def test_state_is_called_by_the_chunk():
    """Every call on state is a round trip; rows go in and out in chunks, each once, over several batches."""
    splitter, handle = L.LateSplitter(), _Handle()
    splitter.init(handle)
    _Map.calls = 0
    rows = [{"event_ms": 10 + i % 3, "row": str(i)} for i in range(9000)] + [{"event_ms": t, "row": f"late{t}"} for t in (None, 4)]
    late = [r["row"] for part in (rows[:5000], rows[5000:]) for r in splitter.handleInputRows((0,), iter(part), _Timer(0))]
    assert late == ["lateNone", "late4"] and sorted(handle.timers) == [10, 11, 12]
    out = [r["row"] for at in handle.timers for r in splitter.handleExpiredTimer((0,), _Timer(5), _Timer(at))]
    assert sorted(out, key=int) == [str(i) for i in range(9000)] and not splitter.rows and not splitter.sizes
    assert _Map.calls < 500
    # Many open times: what is held stays bounded, each row still comes out once.
    many = [{"event_ms": 10 + i, "row": str(i)} for i in range(3 * L.HELD)]
    assert not list(splitter.handleInputRows((0,), iter(many), _Timer(0)))
    assert len(splitter.rows) == 3 * L.HELD
