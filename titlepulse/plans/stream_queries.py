"""The five results as streams (and scoring as a stream), read back for checking.

Each query packs the raw records of its topics into message files (a "topic"
folder under the shared checkpoint folder) and then runs its streaming job over those topics with ``availableNow``, a fresh checkpoint
and an idempotent parquet sink, and returns the sink's contents. The oracle is the batch result restricted to the groups the
watermark has closed: event time <= min(max time of each input) - 10 minutes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.operators.term_model import score_by_terms
from titlepulse.plans.catalog import ORACLE, register, rounded
from titlepulse.plans.text_queries import spelled, trained
from titlepulse.schemas import RESULT_COLUMNS, TS_COLUMNS
from titlepulse.session import scratch_path
from titlepulse.streaming import jobs as J
from titlepulse.streaming.late import parsed, split_late
from titlepulse.streaming.runner import LARGE_STATE, ROCKSDB, SORTED_INSERTS, await_done, start
from titlepulse.streaming.sinks import parquet_batch_writer
from titlepulse.streaming.topk import best_items, current_top
from titlepulse.plans.oracle_views import RAW_ACTOR, RAW_MOVIE, RAW_REVIEW

STREAM_TIMEOUT_S = 1800
TOPIC_FORMAT = "parquet"
_RAW = {"movie": X.raw_movie, "actor": X.raw_actor, "review": X.raw_review}


def state_partitions(spark) -> int:
    """One state partition per task slot: spreads the join and aggregation
    state over the whole cluster without making every micro-batch pay for
    many nearly empty state stores (measured: 2x slots was 15 % slower)."""
    return spark.sparkContext.defaultParallelism


def topic_folder(spark, d, kind) -> str:
    """The message folder ("topic") of one kind for a data folder: packs the
    raw records, as a producer would. Every call writes its own."""
    path = scratch_path(spark, f"topic_{kind}")
    J.write_messages(_RAW[kind](spark, d), kind, path, TOPIC_FORMAT)
    return path


def run_stream(spark, d, name, time_bound=None):
    """Run the named stream over its topics to completion (fresh checkpoint
    and sink) and return what its sink holds. State is kept in RocksDB: it
    grows with the input and would not fit the executors' heaps."""
    base = scratch_path(spark, f"stream_{name}")
    frames = {kind: J.load_topic(spark, topic_folder(spark, d, kind), kind, fmt=TOPIC_FORMAT)
              for kind in J.INPUTS[name]}
    sort = name == "rating_per_year"
    result = J.build(name, frames, time_bound=time_bound, key_order=sort)
    q = start(result, parquet_batch_writer(f"{base}/out"), f"{base}/checkpoint",
              state_partitions=state_partitions(spark), state_store=ROCKSDB, state_options=LARGE_STATE | (SORTED_INSERTS if sort else {}))
    await_done(q, STREAM_TIMEOUT_S)
    out = spark.read.parquet(f"{base}/out").drop("batch_id")
    ts_cols = set(TS_COLUMNS.values())
    out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ts_cols else F.col(c)
                       for c in RESULT_COLUMNS[name]])
    return rounded(out) if name != "top_sentiment" else out


def _stream_oracle(name: str) -> str:
    """The batch oracle (nested as a subquery) restricted to closed groups."""
    batch = ORACLE[name]
    inputs = J.INPUTS[name]
    ts = TS_COLUMNS[inputs[0]]
    maxes = [f"(SELECT max({TS_COLUMNS[k]}) FROM raw_{k})" for k in inputs]
    bound = f"least({', '.join(maxes)})" if len(maxes) > 1 else maxes[0]
    views = {"movie": RAW_MOVIE, "actor": RAW_ACTOR, "review": RAW_REVIEW}
    raw_views = ",\n".join(views[k] for k in inputs)
    return (f"WITH {raw_views}\nSELECT * FROM (\n{batch}\n) AS batch_result "
            f"WHERE {ts} <= {bound} - INTERVAL 10 MINUTE")


for _name in J.INPUTS:
    def _q(spark, d, _n=_name):
        return run_stream(spark, d, _n)
    register(f"stream_{_name}", _stream_oracle(_name))(_q)


@register("stream_score", ORACLE["score_documents"])
def q_stream_score(spark, d):
    """Score documents arriving as a stream with the weight table, batch by
    batch; the stream reads the given table, nothing is copied."""
    base = scratch_path(spark, "stream_score")
    docs = X.table(spark, d, "documents")
    stream = (spark.readStream.schema(docs.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .parquet(_only(d, "documents")).select("doc_id", "text"))
    weights, write = trained(spark, d), parquet_batch_writer(f"{base}/out")
    q = start(stream, lambda df, batch: write(score_by_terms(weights, df, keep=["doc_id"]), batch), f"{base}/checkpoint")
    await_done(q, STREAM_TIMEOUT_S)
    return spelled(spark.read.parquet(f"{base}/out").drop("batch_id"))


@register("stream_closed_rows", f"""WITH {RAW_MOVIE},
bound AS (SELECT max(movie_ts) - INTERVAL 10 MINUTE AS b FROM raw_movie)
SELECT movie_id, title, movie_ts, false AS late FROM raw_movie, bound WHERE movie_ts <= b AND NOT contains(movie_id, '{{')""")
def q_stream_closed_rows(spark, d):
    """Movies that the watermark has closed, and rows that came behind it
    (none here: the topic is read at once)."""
    base = scratch_path(spark, "stream_closed")
    J.write_messages(X.raw_movie(spark, d), "movie", f"{base}/topic")
    stream = J.load_topic(spark, f"{base}/topic", "movie").select("movie_id", "title", "movie_ts")
    write = parquet_batch_writer(f"{base}/out")
    q = start(split_late(stream, "movie_ts", ["movie_id"]), lambda df, batch: write(parsed(df, stream.schema), batch), f"{base}/checkpoint",
              state_partitions=state_partitions(spark), state_store=ROCKSDB)
    await_done(q, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{base}/out").select("movie_id", "title", F.col("movie_ts").cast("timestamp_ntz").alias("movie_ts"), "late")


@register("stream_top_movies_per_country", f"SELECT country, movie_id, rating, revenue, rank FROM ({ORACLE['top_movies_per_country']}) AS ranked")
def q_stream_top_movies_per_country(spark, d):
    """The three best movies of each country as the movies arrive, kept
    up to date in state."""
    base = scratch_path(spark, "stream_top")
    J.write_messages(X.raw_movie(spark, d), "movie", f"{base}/topic")
    stream = J.load_topic(spark, f"{base}/topic", "movie").select("country", "movie_id", "rating", "revenue")
    q = start(best_items(stream, "country", "movie_id", "rating", "revenue", 3), parquet_batch_writer(f"{base}/out"), f"{base}/checkpoint",
              output_mode="update", state_partitions=state_partitions(spark), state_store=ROCKSDB)
    await_done(q, STREAM_TIMEOUT_S)
    best = current_top(spark.read.parquet(f"{base}/out"), 3)
    return best.select(F.col("key").alias("country"), F.col("item").alias("movie_id"), F.col("avg").alias("rating"), F.col("total").alias("revenue"),
                       F.col("rank").cast("bigint").alias("rank"))


def _only(d, name) -> str:
    """A path pattern that holds one table, whether file or folder."""
    return f"{d.rstrip('/')}/{name}[.]parquet"
