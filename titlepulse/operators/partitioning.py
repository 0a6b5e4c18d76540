"""Lineage cuts.

How a scan is split is left to the file layout and to
``spark.sql.files.maxPartitionBytes``; nothing here compares partitions with
cores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` once as parquet into a fresh folder under the shared
    checkpoint folder and read it back, so several branches of a later plan
    do not each recompute it, and a lost executor sends them back only to this
    table, not to the raw input. ``options`` are the Parquet writer's. Batch
    frames only."""
    from titlepulse.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)
