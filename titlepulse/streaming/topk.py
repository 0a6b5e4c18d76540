"""Best items of each key, kept up to date as rows arrive.

An item's score is the average of one column, ties by the sum of another and
then by name, so a score may fall as well as rise and an item may leave the
list again. State holds each item's sums and, beside them, the ``n`` best: a
rise needs a look at that list alone; only when one of its items has fallen
are the sums read through once, at the end of the batch.

Items are dealt to a fixed number of buckets of their key by a hash, so a key
with a third of all items is spread over tasks. A bucket gives out its list
whenever it changes (update mode); the list of a key is the best ``n`` of its
buckets' lists, which are at most ``n`` rows each (``current_top``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from titlepulse.operators.topk import top_k

BUCKETS = 16
_SUMS = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n_x", T.LongType()),
                      T.StructField("y", T.LongType()), T.StructField("n_y", T.LongType()), T.StructField("n", T.LongType())])
_ITEM = T.StructType([T.StructField("item", T.StringType())])
LIST = "key string, bucket long, place long, item string, avg double, total long, n long"


def _order(item: str, s: tuple) -> tuple:
    """Smaller is better: average, then total, nulls last, then name."""
    x, n_x, y, n_y, _ = s
    return (n_x == 0, -x / n_x if n_x else 0.0, n_y == 0, -y, item)


class BestItems(StatefulProcessor):
    """Per (key, bucket): item -> sums, and the same of the ``n`` best."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getMapState("sums", _ITEM, _SUMS)
        self.best = handle.getMapState("best", _ITEM, _SUMS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = {k[0]: tuple(v) for k, v in self.best.iterator()}
        best, fallen = dict(before), False
        for r in rows:
            item = r["item"]
            old = tuple(self.sums.getValue((item,))) if self.sums.containsKey((item,)) else (0.0, 0, 0, 0, 0)
            new = (old[0] + (r["x"] or 0.0), old[1] + (r["x"] is not None), old[2] + (r["y"] or 0), old[3] + (r["y"] is not None), old[4] + 1)
            self.sums.updateValue((item,), new)
            if item in best:
                fallen = fallen or _order(item, new) > _order(item, best[item])
                best[item] = new
                continue
            best[item] = new
            if len(best) > self.n:
                del best[max(best, key=lambda i: _order(i, best[i]))]
        if fallen:
            best = dict(heapq.nsmallest(self.n, ((k[0], tuple(v)) for k, v in self.sums.iterator()), key=lambda kv: _order(*kv)))
        if best == before:
            return
        for item in before.keys() - best.keys():
            self.best.removeKey((item,))
        for place, item in enumerate(sorted(best, key=lambda i: _order(i, best[i])), 1):
            x, n_x, y, n_y, n = best[item]
            self.best.updateValue((item,), best[item])
            yield Row(key=key[0], bucket=key[1], place=place, item=item, avg=x / n_x if n_x else None, total=y if n_y else None, n=n)

    def close(self) -> None:
        pass


def best_items(rows: DataFrame, key: str, item: str, avg: str, total: str, n: int, buckets: int = BUCKETS) -> DataFrame:
    """A stream of rows -> the changed lists of its buckets, by average of
    ``avg``, then sum of ``total`` (a whole number). Rows without an item are
    left out; a null key is a key. Start it with ``output_mode="update"`` and
    ``state_store=ROCKSDB``; ``n`` and ``buckets`` are fixed for the life of a
    checkpoint."""
    dealt = rows.select(F.col(key).cast("string").alias("key"), F.pmod(F.xxhash64(item), F.lit(buckets)).alias("bucket"),
                        F.col(item).cast("string").alias("item"), F.col(avg).cast("double").alias("x"), F.col(total).cast("long").alias("y"))
    return dealt.filter("item is not null").groupBy("key", "bucket").transformWithState(BestItems(n), LIST, "Update", "None")


def current_top(lists: DataFrame, n: int) -> DataFrame:
    """What the sink holds (``LIST`` and batch_id) -> key, rank, item, avg,
    total, n: the last row of each place of each bucket, and of these the best
    of each key. A list never gets shorter, so a place always has a newest row."""
    last = (lists.groupBy("key", "bucket", "place").agg(F.max_by(F.struct("item", "avg", "total", "n"), "batch_id").alias("r"))
            .select("key", "r.*"))
    order = [F.desc_nulls_last("avg"), F.desc_nulls_last("total"), F.asc("item")]
    return top_k(last, n, order, partition_by=["key"], rank_col="rank")
