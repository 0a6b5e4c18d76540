"""Top-k, overall or per key.

Per key it is ``row_number() <= n`` over a window; Spark plans that with a
partial ``WindowGroupLimit`` before the shuffle, so every map task forwards at
most ``n`` rows per key and a key holding a third of all rows reaches the
final window as at most ``n x map tasks`` rows. Overall it is
``orderBy().limit()``, planned as ``TakeOrderedAndProject`` (a per-partition
top-n and a merge of n rows per partition), never a global sort.

``order`` must make a total order (add tie-break columns) so results repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, n: int, order: list[Column], partition_by: list[str] | None = None,
          rank_col: str | None = None) -> DataFrame:
    if not partition_by:
        out = df.orderBy(*order).limit(n)
        if rank_col:
            # n rows only: a single-partition window over them is bounded.
            out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
        return out
    w = Window.partitionBy(*partition_by).orderBy(*order)
    out = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
    return out.withColumnRenamed("_rk", rank_col) if rank_col else out.drop("_rk")
