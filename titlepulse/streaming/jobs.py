"""The five result tables as Structured Streaming queries.

Each topic is read as a stream of messages, unpacked with ``parse_envelope``,
watermarked on the message time (10 minutes, as the original), cleaned, and
handed to the same analytics functions the batch side uses (partial
aggregates, a stream-stream inner join, then an append-mode aggregation keyed
on the exact event time). A group is emitted
once the global watermark (the minimum over the joined streams) passes its
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlepulse.operators import analytics as A
from titlepulse.operators.clean import clean_actor, clean_movie, clean_review, observed_rejects
from titlepulse.schemas import MESSAGE_SIZES, RECORD_SCHEMAS, TS_COLUMNS
from titlepulse.sources.envelope import pack_envelope, parse_envelope, to_message_rows
from titlepulse.sources.streams import file_stream, kafka_stream

WATERMARK_DELAY = "10 minutes"
_CLEAN = {"movie": clean_movie, "actor": clean_actor, "review": clean_review}
_KEYS = {"movie": ["movie_id"], "actor": ["actor_id", "movie_id"], "review": ["review_id", "movie_id"]}


#: Parquet topics: row groups of a few hundred messages, which a writer holds and a reader takes as one batch.
_TOPIC_OPTIONS = {"json": {}, "parquet": {"parquet.block.size": str(16 << 20)}}


def write_messages(records: DataFrame, kind: str, path: str, fmt: str = "json") -> None:
    """Pack records (with their event-time column) into messages, one message
    time per message, and write them as rows of the shape a broker holds: JSON
    lines, or Parquet with ``fmt``."""
    ts = TS_COLUMNS[kind]
    packed = pack_envelope(records, kind, _KEYS[kind], MESSAGE_SIZES[kind], group_cols=(ts,))
    to_message_rows(packed, ts).write.mode("overwrite").format(fmt).options(**_TOPIC_OPTIONS[fmt]).save(path)


def load_topic(spark: SparkSession, path: str, kind: str, delay: str = WATERMARK_DELAY,
               max_files_per_trigger: int | None = None, bootstrap: str | None = None,
               max_offsets_per_trigger: int | None = None, count_rejects: bool = False,
               fmt: str = "json") -> DataFrame:
    """Messages -> watermarked, cleaned records of one kind.

    ``path`` is a folder of message files (in ``fmt``), or, with ``bootstrap``
    servers, the name of a broker topic; both give key, value, topic, timestamp.
    ``count_rejects`` reports values that did not parse with each batch."""
    ts = TS_COLUMNS[kind]
    msgs = (kafka_stream(spark, path, bootstrap=bootstrap, max_offsets_per_trigger=max_offsets_per_trigger)
            if bootstrap else file_stream(spark, path, max_files_per_trigger, fmt))
    recs = parse_envelope(msgs, RECORD_SCHEMAS[kind], "timestamp", ts).withWatermark(ts, delay)
    return _CLEAN[kind](observed_rejects(recs, kind) if count_rejects else recs)


def build(name: str, s: dict[str, DataFrame], dedupe: bool = False,
          time_bound: str | None = None, dedupe_within_watermark: bool = False,
          key_order: bool = False) -> DataFrame:
    """The named result from a dict of cleaned (stream or batch) frames.

    ``time_bound`` (streams) bounds the joins in time so their state expires;
    None keeps the original unbounded join. ``dedupe_within_watermark`` lets
    the dedupe of ``rating_per_year`` forget ids the watermark passed;
    ``key_order`` sorts its rows before they go into state (see there)."""
    if name == "top_country":
        return A.top_country(s["movie"])
    if name == "top_user_sentiment":
        return A.top_user_sentiment(s["review"], s["movie"], time_bound=time_bound)
    if name == "top_director_rate":
        return A.top_director_rate(s["actor"], s["movie"], time_bound=time_bound)
    if name == "rating_per_year":
        return A.rating_per_year(s["review"], s["movie"], time_bound=time_bound,
                                 dedupe_within_watermark=dedupe_within_watermark, key_order=key_order)
    if name == "top_sentiment":
        return A.top_sentiment(s["review"], s["movie"], dedupe=dedupe, time_bound=time_bound)
    raise KeyError(name)


INPUTS = {
    "top_country": ("movie",),
    "top_user_sentiment": ("review", "movie"),
    "top_director_rate": ("actor", "movie"),
    "rating_per_year": ("review", "movie"),
    "top_sentiment": ("review", "movie"),
}


def start_all(spark: SparkSession, topic_paths: dict[str, str], out_base: str, checkpoint_base: str,
              names: tuple[str, ...] = tuple(INPUTS), trigger: str | None = "availableNow",
              time_bound: str | None = None, state_partitions: int | None = None,
              writer_factory=None, bootstrap: str | None = None, dedupe_within_watermark: bool = False,
              state_store: str | None = None, count_rejects: bool = True) -> list:
    """Start the named results together, each reading its topics, each with
    its own checkpoint and idempotent sink (as the original service did with
    its five queries). ``topic_paths`` maps movie / actor / review to message
    folders, or to broker topics when ``bootstrap`` is given;
    ``writer_factory(name)`` may supply another sink (JDBC ...). A service
    that runs for long sets ``time_bound`` and ``dedupe_within_watermark``, so
    that all state expires, and a ``state_store`` for state beyond memory.
    Wait on the returned queries with ``runner.run_all``."""
    from titlepulse.streaming.runner import start
    from titlepulse.streaming.sinks import parquet_batch_writer

    queries = []
    for name in names:
        frames = {k: load_topic(spark, topic_paths[k], k, bootstrap=bootstrap, count_rejects=count_rejects) for k in INPUTS[name]}
        result = build(name, frames, time_bound=time_bound, dedupe_within_watermark=dedupe_within_watermark)
        writer = writer_factory(name) if writer_factory else parquet_batch_writer(f"{out_base}/{name}")
        queries.append(start(result, writer, f"{checkpoint_base}/{name}", name=name, trigger=trigger,
                             state_partitions=state_partitions, state_store=state_store))
    return queries
