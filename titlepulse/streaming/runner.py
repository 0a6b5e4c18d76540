"""Start, run and stop Structured Streaming queries.

``start`` wires one result frame to a ``foreachBatch`` sink with its own
checkpoint; ``run_all`` starts several and waits with
``awaitAnyTermination`` so the first failure is seen at once (the original
waited on each query in turn), always with a time limit.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

from titlepulse.streaming.sinks import BatchWriter


#: State in RocksDB, on the executors' disks.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: For much state in RocksDB: small write buffers, for an executor holds many
#: stores; a commit writes the changes alone; rows are not counted (progress
#: reports 0), as each write would look its key up for it.
LARGE_STATE = {f"spark.sql.streaming.stateStore.rocksdb.{k}": v for k, v in
               {"writeBufferSizeMB": "32", "changelogCheckpointing.enabled": "true", "trackTotalNumberOfRows": "false"}.items()}

#: For plans that sort the rows of a micro-batch within its partitions. Spark's check of
#: a stream's operators refuses every sort, a local one too, and is left out for the start;
#: write buffers may be smaller, since files of keys in order need no merging.
SORTED_INSERTS = {"spark.sql.streaming.unsupportedOperationCheck": "false",
                  "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8"}

#: A stream copies the session's settings when it starts; one start at a time changes them.
_STARTING = threading.Lock()


def start(df: DataFrame, writer: BatchWriter, checkpoint: str, name: str | None = None,
          trigger: str | None = "availableNow", output_mode: str = "append",
          state_partitions: int | None = None, state_store: str | None = None,
          state_options: dict[str, str] | None = None) -> StreamingQuery:
    """Start ``df`` into ``writer`` with its own checkpoint.

    ``state_partitions`` fixes the number of shuffle / state-store partitions
    of a *new* query (a restarted one keeps the number in its checkpoint), and
    ``state_store`` names the class of its state store, ``state_options`` are
    settings of it: the stream takes them from the session when it starts, so
    they are set for the start only, one start at a time, and put back afterwards."""
    w = df.writeStream.outputMode(output_mode).foreachBatch(writer).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    wanted = {"spark.sql.shuffle.partitions": state_partitions, "spark.sql.streaming.stateStore.providerClass": state_store}
    wanted |= state_options or {}
    conf = df.sparkSession.conf
    with _STARTING:
        before = {k: conf.get(k, None) for k, v in wanted.items() if v}
        try:
            for k in before:
                conf.set(k, str(wanted[k]))
            return w.start()
        finally:
            for k, v in before.items():
                if v is None:
                    conf.unset(k)
                else:
                    conf.set(k, v)


def await_done(q: StreamingQuery, timeout_s: float) -> None:
    """Wait for an availableNow query; stop it and raise if it overruns."""
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_all(spark, queries: list[StreamingQuery], timeout_s: float) -> None:
    """Wait until all end; the first failure stops the others and raises."""
    deadline = time.monotonic() + timeout_s
    spark.streams.resetTerminated()  # forget queries that ended before these
    try:
        while any(q.isActive for q in queries):
            left = deadline - time.monotonic()
            if left <= 0:
                raise TimeoutError("streams did not finish in time")
            try:
                spark.streams.awaitAnyTermination(min(left, 5.0))
            except StreamingQueryException:
                pass  # judged below, from our own queries only
            spark.streams.resetTerminated()
            for q in queries:
                if q.exception() is not None:
                    raise RuntimeError(f"{q.name or q.id}: {q.exception()}")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
