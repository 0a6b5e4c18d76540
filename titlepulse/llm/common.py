"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from titlepulse.operators.partitioning import cut_lineage

SPACE = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back."""
    return cut_lineage(df, f"llm-{name}", **options)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers through Spark's own file
    server, once per context, so that tasks can import it on any executor."""
    sc = spark.sparkContext
    if any(f.endswith("titlepulse_pkg.zip") for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="titlepulse-pkg-"), "titlepulse_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(docs with ``_row``, a key of its own for every row; the odd rows).

    A doc_id that stands once is its row's key. Rows without doc_id and rows
    that share one are odd: they are numbered downwards from the smallest
    doc_id and written, so that a key stays when a task is run again. Null
    instead of odd rows where there are none."""
    ids = cut(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1 or doc_id is null").select(F.col("doc_id").alias("_again")), "again")
    plain = F.col("doc_id").alias("_row")
    if ids.isEmpty():
        return docs.select("*", plain), None
    low = min(0, docs.agg(F.min("doc_id").alias("m")).first()["m"] or 0)
    known = ids.filter("_again is not null")
    same = docs["doc_id"] == known["_again"]
    odd = docs.filter("doc_id is null").unionByName(docs.join(known, same, "left_semi"))
    odd = cut(odd.withColumn("_row", F.lit(low - 1) - F.monotonically_increasing_id()), "odd-rows")
    return docs.filter("doc_id is not null").join(known, same, "left_anti").select("*", plain).unionByName(odd), odd


def renamed(out: DataFrame, odd: DataFrame | None) -> DataFrame:
    """``out``, whose doc_id is a key of ``keyed``, with the rows' own ids."""
    if odd is None:
        return out
    own = odd.select(F.col("_row").alias("_key"), F.col("doc_id").alias("_own"), F.lit(True).alias("_odd"))
    rest = [c for c in out.columns if c != "doc_id"]
    return out.join(own, out["doc_id"] == own["_key"], "left").select(F.when(F.col("_odd"), F.col("_own")).otherwise(F.col("doc_id")).alias("doc_id"), *rest)


def texts_by_row(rows: DataFrame) -> DataFrame:
    """(doc_id, text) of ``keyed`` rows under their keys; null texts are empty."""
    return rows.select(F.col("_row").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def rowed(docs: DataFrame) -> DataFrame:
    """(odd, row, doc_id, text): every row of docs under a key of its own. A
    doc_id that stands once is its row's key; rows without doc_id and rows
    that share one are odd, are numbered, and are written with their numbers,
    so that the key stays when a task is run again. Null texts become empty."""
    t = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    again = cut(t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1 or doc_id is null")
                .select(F.col("doc_id").alias("again")), "again")
    plain = F.lit(False).alias("odd"), F.col("doc_id").alias("row"), "doc_id", "text"
    if again.isEmpty():
        return t.select(*plain)
    known = again.filter("again is not null")
    odd = t.filter("doc_id is null").unionByName(t.join(known, t["doc_id"] == known["again"], "left_semi"))
    odd = cut(odd.withColumn("row", F.monotonically_increasing_id()), "odd-rows")
    return (t.filter("doc_id is not null").join(known, t["doc_id"] == known["again"], "left_anti").select(*plain)
            .unionByName(odd.select(F.lit(True).alias("odd"), "row", "doc_id", "text")))
