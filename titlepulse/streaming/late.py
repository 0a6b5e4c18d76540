"""Late rows kept aside.

A watermarked aggregation drops rows that arrive behind the watermark without
a trace. ``split_late`` holds rows in state until the watermark has passed
their event time and gives them out then, by an event-time timer, and gives
out the others at once, marked late: every row comes out once, so late rows
can be stored, counted and replayed, and the closed rows of an event time
leave together in one micro-batch, complete for any batch function.

Rows are dealt to a fixed number of state groups by a hash of their key
columns, so one hot title does not make a hot group. State lives in RocksDB
and holds the rows of the open event times only.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from titlepulse.streaming.runner import ROCKSDB as ROCKSDB
from titlepulse.streaming.sinks import BatchWriter

BUCKETS = 64
#: Rows of one state entry, and rows that a group holds before it writes them.
CHUNK = 256
HELD = 4096
OUT = "late boolean, event_ms long, row string"


class LateSplitter(StatefulProcessor):
    """Per bucket: event time (ms) -> number of chunks, and chunks of at most
    ``CHUNK`` rows under (event time, number). A call on state is a round trip
    to the executor, so rows go in and out by the chunk."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sizes = handle.getMapState("sizes", T.StructType([T.StructField("event_ms", T.LongType())]),
                                        T.StructType([T.StructField("n", T.LongType())]))
        self.rows = handle.getMapState("rows", T.StructType([T.StructField("event_ms", T.LongType()), T.StructField("k", T.LongType())]),
                                       T.StructType([T.StructField("rows", T.ArrayType(T.StringType()))]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        held: dict[int, list[str]] = {}
        count = 0
        for r in rows:
            at = r["event_ms"]
            # Without event time a row is never closed by a watermark; a passed time is open while its timer waits.
            if at is None or (at <= mark and at not in held and not self.sizes.containsKey((at,))):
                yield Row(late=True, event_ms=at, row=r["row"])
                continue
            chunk = held.setdefault(at, [])
            chunk.append(r["row"])
            count += 1
            if len(chunk) == CHUNK:
                self._store(at, chunk)
                held[at] = []
                count -= CHUNK
            elif count >= HELD:
                self._store_all(held)
                held, count = {}, 0
        self._store_all(held)

    def _store_all(self, held: dict[int, list[str]]) -> None:
        for at, chunk in held.items():
            if chunk:
                self._store(at, chunk)

    def _store(self, at: int, chunk: list[str]) -> None:
        n = 0
        if self.sizes.containsKey((at,)):
            n = self.sizes.getValue((at,))[0]
        else:
            self.handle.registerTimer(at)
        self.rows.updateValue((at, n), (chunk,))
        self.sizes.updateValue((at,), (n + 1,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if not self.sizes.containsKey((at,)):
            return
        for k in range(self.sizes.getValue((at,))[0]):
            for row in self.rows.getValue((at, k))[0]:
                yield Row(late=False, event_ms=at, row=row)
            self.rows.removeKey((at, k))
        self.sizes.removeKey((at,))

    def close(self) -> None:
        pass


def split_late(rows: DataFrame, ts: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """A watermarked stream -> (late, event_ms, row): each row once, as JSON;
    the rows of an event time leave when the watermark has passed it. The
    query has to be started with ``state_store=ROCKSDB``; ``buckets`` is
    fixed for the life of a checkpoint. Rows without event time are late."""
    body = F.to_json(F.struct(*[F.col(c) for c in rows.columns]), {"ignoreNullFields": "false"})
    # An expression of the event time, so that rows behind the watermark are not dropped on the way in.
    dealt = rows.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), F.unix_millis(ts).alias("event_ms"), body.alias("row"))
    return dealt.groupBy("bucket").transformWithState(LateSplitter(), OUT, "Append", "EventTime")


def parsed(split: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of ``split_late`` with their columns and the mark."""
    return split.select(F.from_json("row", schema).alias("_r"), "late").select("_r.*", "late")


def side_writer(schema: T.StructType, closed: BatchWriter, late: BatchWriter) -> BatchWriter:
    """Closed rows of a batch go to one writer, late rows to another. Rows are
    computed once; both writers have to be idempotent by batch id."""
    def write(df: DataFrame, batch_id: int) -> None:
        held = parsed(df, schema).persist()
        try:
            late(held.filter("late").drop("late"), batch_id)
            closed(held.filter("not late").drop("late"), batch_id)
        finally:
            held.unpersist()

    return write
