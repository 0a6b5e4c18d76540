"""Look-ups through stored indexes instead of scans.

Two kinds, both written as Parquet and read with pushed filters:

* a gram index: a row is posted, whole, under each three-character gram of its
  lower-cased text, and the postings are sorted by gram. A search reads the
  postings of the rarest gram of its term and verifies the term on the rows
  found there, so no second table is read. Texts are padded by two end marks, so
  a term of one or two characters is the beginning of a gram.
* a bitmap index: rows are numbered and keep their number; for each value of a
  field there is a bitmap per 32,768 numbers. Values are or-ed, fields and-ed,
  and the rows whose bit is left are read by bucket.

Postings of a frequent gram are dealt by gram and text, so they lie in many
files and tasks. The driver sees the counts of a term's own grams, nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlepulse.sources.envelope import numbered

GRAM = 3
END = "\0"


def grams(text: Column | str) -> Column:
    """Distinct grams of the lower-cased text; every character starts one, and
    an empty text has the gram of two end marks."""
    low = F.lower(text)
    padded = F.concat(low, F.lit(END * (GRAM - 1)))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1))),
                                        lambda i: F.substring(padded, i, F.lit(GRAM))))


def write_gram_index(rows: DataFrame, text: str, path: str) -> None:
    """Post every row of ``rows`` whose ``text`` is not null. A row with n
    characters is stored up to n times: meant for short texts such as names."""
    posted = rows.filter(F.col(text).isNotNull()).withColumn("gram", F.explode(grams(text)))
    (posted.repartitionByRange("gram", text).sortWithinPartitions("gram", text)
     .write.mode("overwrite").parquet(f"{path}/postings"))
    counts = rows.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/grams")


def search_grams(spark: SparkSession, path: str, text: str, term: str) -> DataFrame:
    """The posted rows whose ``text`` contains ``term``, whatever the case."""
    term = term.lower()
    own = {term[i:i + GRAM] for i in range(len(term) - GRAM + 1)}
    posted = spark.read.parquet(f"{path}/postings")
    if own:
        seen = {r["gram"]: r["n"] for r in spark.read.parquet(f"{path}/grams").filter(F.col("gram").isin(*own)).collect()}
        probe = F.col("gram") == min(own, key=lambda g: (seen.get(g, 0), g))
    else:
        # Several grams of a row may begin with a short term: the first stands for it.
        first = F.array_min(F.filter(grams(text), lambda g: g.startswith(term)))
        probe = F.col("gram").startswith(term) & (F.col("gram") == first)
    return posted.filter(probe & F.lower(text).contains(term)).drop("gram")


def write_bitmap_index(rows: DataFrame, key_cols: list[str], fields: list[str], path: str, names: tuple[str, ...] = ()) -> None:
    """Number ``rows`` in the order of ``key_cols`` and write them with a
    bitmap per value of ``fields`` (few values each: a bitmap has four
    kilobytes before compression) and a gram index of each column of ``names``."""
    spark = rows.sparkSession
    n = F.col("_rn") + 1
    placed = numbered(rows, key_cols).select(*rows.columns, n.alias("_n"), F.bitmap_bucket_number(n).alias("_bucket"))
    placed.repartitionByRange("_n").sortWithinPartitions("_n").write.mode("overwrite").parquet(f"{path}/rows")
    placed = spark.read.parquet(f"{path}/rows")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    bits = (placed.select("_n", "_bucket", F.explode(pairs).alias("p")).filter("p.value is not null")
            .groupBy("p.field", "p.value", "_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")))
    (bits.repartitionByRange("field", "value", "_bucket").sortWithinPartitions("field", "value", "_bucket")
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/bits"))
    for c in names:
        write_gram_index(placed.select(c, "_n"), c, f"{path}/names-{c}")


def search_bitmaps(spark: SparkSession, path: str, values: dict[str, list[str]] | None = None,
                   contains: dict[str, str] | None = None, where: Column | None = None) -> DataFrame:
    """Rows that have one of ``values`` in each of these fields, whose names
    contain the terms of ``contains``, and for which ``where`` holds."""
    bits = spark.read.parquet(f"{path}/bits")
    found = [bits.filter((F.col("field") == f) & F.col("value").isin(*v)).groupBy("_bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
             for f, v in (values or {}).items()]
    for c, term in (contains or {}).items():
        hit = search_grams(spark, f"{path}/names-{c}", c, term)
        found.append(hit.groupBy(F.bitmap_bucket_number("_n").alias("_bucket"))
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")))
    rows = spark.read.parquet(f"{path}/rows")
    if where is not None:
        rows = rows.filter(where)
    if found:
        met = (reduce(DataFrame.unionByName, found).groupBy("_bucket")
               .agg(F.bitmap_and_agg("bits").alias("_bits"), F.count(F.lit(1)).alias("_fields"))
               .filter((F.col("_fields") == len(found)) & (F.bitmap_count("_bits") > 0)))
        rows = rows.join(met, "_bucket").withColumn("_at", F.bitmap_bit_position("_n")).filter(
            "shiftright(cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int), cast(_at % 8 as int)) % 2 = 1") \
            .drop("_bits", "_fields", "_at")
    return rows.drop("_n", "_bucket")
