"""Top-k on a stream equals the batch top-k after each batch."""

import random

import pytest
from pyspark.sql import functions as F

from titlepulse.operators.topk import top_k
from titlepulse.streaming.late import ROCKSDB
from titlepulse.streaming.runner import await_done, start
from titlepulse.streaming.sinks import parquet_batch_writer
from titlepulse.streaming.topk import best_items, current_top

SCHEMA = "country string, director string, rating double, revenue long"


def batch_top(df, n):
    totals = (df.filter("director is not null").groupBy(F.col("country").alias("key"), F.col("director").alias("item"))
              .agg(F.avg("rating").alias("avg"), F.sum("revenue").alias("total"), F.count(F.lit(1)).alias("n")))
    return top_k(totals, n, [F.desc_nulls_last("avg"), F.desc_nulls_last("total"), F.asc("item")], partition_by=["key"], rank_col="rank")


def rows_of(df):
    return sorted(((r["key"], r["rank"], r["item"], r["avg"], r["total"], r["n"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 4])
def test_equals_batch_after_each_batch(spark, tmp_path, buckets):
    rnd = random.Random(buckets)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for step in range(5):
        # Ratings of the first steps are high, later ones low: leaders fall and leave the lists. One country holds most rows.
        rows = [(rnd.choice(["us", "us", "us", "fr", None]), rnd.choice([f"d{i}" for i in range(25)] + [None]),
                 rnd.choice([None, (10 - 2 * step + rnd.randrange(4)) / 4]), rnd.choice([None, rnd.randrange(100)])) for _ in range(80 if step != 3 else 2)]
        if step == 0:
            rows += [("de", "only", None, None), ("us", "tie-b", 9.0, 5), ("us", "tie-a", 9.0, 5)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        q = start(best_items(stream, "country", "director", "rating", "revenue", 3, buckets), parquet_batch_writer(out), str(tmp_path / "ck"),
                  output_mode="update", state_partitions=2, state_store=ROCKSDB)
        await_done(q, 300)
        lists = spark.read.parquet(out)
        assert rows_of(current_top(lists, 3)) == rows_of(batch_top(spark.read.schema(SCHEMA).parquet(src), 3))
    # A bucket gives out its three best at most, however many items it holds.
    assert lists.groupBy("batch_id", "key", "bucket").count().agg(F.max("count")).first()[0] <= 3
