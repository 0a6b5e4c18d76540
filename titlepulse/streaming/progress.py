"""Progress of the running streams as a table.

``ProgressTable`` is a query listener that writes one row for each micro-batch
of each query: rows read, late rows that the watermark dropped, state rows and
bytes, the watermark, and values that did not parse (the observations that
``load_topic(count_rejects=True)`` attaches). A batch has a folder of its own,
so a replayed batch replaces its row and a restarted query goes on in the same
table. Rows are numbers of a batch, never of its data, so the table grows with
the number of batches alone.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query string, id string, batch_id long, at string, watermark string, input_rows long, late_rows long, "
          "state_rows long, state_bytes long, rejected map<string,long>")
_PREFIX = "rejects_"


def progress_row(p: dict) -> tuple:
    """The row of one progress report, as parsed JSON."""
    ops = p.get("stateOperators") or []
    rejected = {f"{name[len(_PREFIX):]}.{c.removeprefix('rejected_')}": int(n) for name, row in (p.get("observedMetrics") or {}).items()
                if name.startswith(_PREFIX) for c, n in row.items() if n is not None}
    return (p.get("name"), p["id"], int(p["batchId"]), p.get("timestamp"), (p.get("eventTime") or {}).get("watermark"),
            sum(int(s.get("numInputRows") or 0) for s in p.get("sources") or []),
            sum(int(o.get("numRowsDroppedByWatermark") or 0) for o in ops),
            sum(int(o.get("numRowsTotal") or 0) for o in ops), sum(int(o.get("memoryUsedBytes") or 0) for o in ops), rejected)


class ProgressTable(StreamingQueryListener):
    """Add with ``spark.streams.addListener``; ``path`` lies on shared storage.
    A report that cannot be written is kept in ``errors`` and never stops the
    stream."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.errors = spark, path, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            row = progress_row(json.loads(event.progress.json))
            name = re.sub(r"\W", "_", row[0] or "query")
            (self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite")
             .json(f"{self.path}/{name}-{row[1]}/{row[2]}"))
        except Exception as e:  # the stream goes on
            self.errors.append(str(e))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """What has been written so far: one row for each query and batch."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(path)
