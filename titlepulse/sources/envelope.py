"""The message envelope: one message value is a JSON array of records.

``parse_envelope`` turns messages back into one row per record and keeps the
message time as the event time; ``pack_envelope`` builds messages of at most
``max_records`` records.

Packing numbers the records of a topic one after the other in key order, as a
producer sends them, so all messages but the last are full. No task sees a
whole topic: records are range-partitioned and sorted by key, written once with
their place in their partition, and partitions are numbered from the running
sum of their sizes, which is one small row for each partition. A message holds at
most ``max_records`` rows, so its ``collect_list`` is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlepulse.operators.partitioning import cut_lineage


def parse_envelope(messages: DataFrame, schema: T.StructType, ts_col: str = "timestamp",
                   out_ts: str | None = None, value_col: str = "value") -> DataFrame:
    """bytes/string -> array<struct> -> one row per element, plus the message time.

    Garbage or truncated text and ``[]`` give no rows; a single JSON object is
    read as a one-element array.
    """
    out_ts = out_ts or ts_col
    recs = F.from_json(F.col(value_col).cast("string"), T.ArrayType(schema))
    return (messages.select(F.explode(recs).alias("_r"), F.col(ts_col).alias(out_ts))
            .select("_r.*", out_ts))


def numbered(records: DataFrame, key_cols: list[str], group_cols: tuple[str, ...] = ()) -> DataFrame:
    """records and ``_rn``, their place (from 0) in key order among those with
    the same ``group_cols``; ties by the hash of the whole record. The result
    is read from a written table, so numbers that were given out stay."""
    ties = F.xxhash64(*[c for c in records.columns if c not in group_cols])
    order = [F.col(c).asc_nulls_first() for c in (*group_cols, *key_cols)]
    dealt = records.withColumn("_tie", ties).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    # The id counts the rows of a partition in their order; its upper bits are the partition.
    placed = cut_lineage(dealt.drop("_tie").withColumn("_id", F.monotonically_increasing_id()), "packed-order")
    part = F.shiftright("_id", 33).alias("_part")
    sizes = placed.groupBy(*group_cols, part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group_cols).orderBy("_part")) - F.col("_n")
    # Written, so that Spark knows how small it is before it plans the join, and does not deal out all records for it.
    starts = cut_lineage(sizes.select(*[F.col(c).alias(f"_{c}") for c in group_cols], "_part", "_first", before.alias("_before")), "packed-starts")
    same = F.shiftright("_id", 33) == F.col("_part")
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(starts, same).select(*records.columns, (F.col("_id") - F.col("_first") + F.col("_before")).alias("_rn"))


def pack_envelope(records: DataFrame, topic: str, key_cols: list[str], max_records: int,
                  group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Records -> messages (topic, msg_no, group cols, n_records, first_id, last_id, key, value).

    ``group_cols`` (for example the message time) are kept out of the record
    body; records share a message only when they share these values. All
    messages of a group but its last hold ``max_records`` records.
    """
    group_cols = tuple(group_cols)
    rec_cols = [c for c in records.columns if c not in group_cols]
    placed = (numbered(records, key_cols, group_cols)
              .withColumn("msg_no", F.floor(F.col("_rn") / max_records).cast("bigint")))
    msgs = (placed.groupBy(*group_cols, "msg_no")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.struct(*rec_cols).alias("r"))))
                 .alias("_recs"), F.count(F.lit(1)).alias("n_records")))
    first_key = key_cols[0]
    value = F.to_json(F.transform("_recs", lambda x: x["r"]))
    return msgs.select(
        F.lit(topic).alias("topic"), "msg_no", *group_cols, "n_records",
        F.col("_recs")[0]["r"][first_key].alias("first_id"),
        F.element_at("_recs", -1)["r"][first_key].alias("last_id"),
        F.sha2(value, 256).alias("key"), value.alias("value"))


def to_message_rows(packed: DataFrame, ts_col: str | None) -> DataFrame:
    """Shape packed messages like a broker record: key, value, topic, ts_ms."""
    ts = (F.unix_millis(F.col(ts_col).cast("timestamp")) if ts_col
          else F.unix_millis(F.current_timestamp()))
    return packed.select("key", "value", "topic", ts.alias("ts_ms"))
