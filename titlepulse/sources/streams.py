"""Stream and table sources.

``kafka_stream`` builds the broker reader (the Kafka connector is not on this
machine's classpath, so it is only option-tested here); ``file_stream`` reads
the same message shape from a folder of JSON-lines files, which is what the
tests and the stream queries use. Both return frames with ``key, value,
topic, timestamp`` so ``parse_envelope`` works on either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlepulse.schemas import MESSAGE


def kafka_options(topic: str, bootstrap: str | None = None, starting: str = "earliest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Reader options for one topic. The broker is always an argument (from the
    job's own configuration), never hard-coded."""
    if not bootstrap:
        raise ValueError("no Kafka bootstrap servers given")
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, topic: str, **kw) -> DataFrame:
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(topic, **kw).items():
        reader = reader.option(k, v)
    return reader.load().select("key", "value", "topic", "timestamp")


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, fmt: str = "json") -> DataFrame:
    """Messages (key, value, topic, ts_ms) in a folder: JSON lines, or Parquet
    (``fmt``), which does not quote a value's text once more."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.format(fmt).load(path)
            .select("key", "value", "topic", F.timestamp_millis("ts_ms").alias("timestamp")))


def message_table(spark: SparkSession, path: str) -> DataFrame:
    """The same folder read as a batch table."""
    return (spark.read.schema(MESSAGE).json(path)
            .select("key", "value", "topic", F.timestamp_millis("ts_ms").alias("timestamp")))


def json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines records with a declared schema (no inference: writers and
    stars stay the raw JSON text, so the list cleaning resolves)."""
    return spark.read.schema(schema).json(path)


def json_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines records as a stream (records, not messages)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def kafka_sink_rows(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Shape rows for ``write.format("kafka")``: key, value (and topic when given
    as a literal; a ``topic`` column routes each row on its own)."""
    cols = [F.col("key").cast("string"), F.col("value").cast("string")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    elif "topic" in df.columns:
        cols.append(F.col("topic"))
    return df.select(*cols)
