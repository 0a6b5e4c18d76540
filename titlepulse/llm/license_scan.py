"""Operator 8: licence scans with MinHash bands over text windows.

Texts are sequences of 5-word shingles; a template of fewer words is one
shingle of its own size, and texts have shingles of these sizes too.
Overlapping windows of 8 shingles, each 4 further on, are compared with
stretches of at most 4 shingles of the licence templates: each of 64 bands is
one MinHash value (one row a band), so a stretch of s shingles that a window
holds meets it in at least one band with probability 1 - (1 - s/8)^64, above
0.9998 for a single shingle, and windows overlap so that every stretch lies
whole in one of them. The bands alone choose which templates are compared with
which documents. A pair they chose is verified exactly: the share of the
template's distinct shingles that the document holds must reach 0.8.

Native: DataFrame functions alone. A band can only meet where the window's
smallest shingle is one of the templates', so windows without any are not
banded: a bit table of the templates' shingles, of a fixed size, says so. It
can only let too many windows through, and no match is lost by it.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from titlepulse.llm.common import cut
from titlepulse.llm.decontaminate import words
from titlepulse.llm.license_texts import TEMPLATES

SHINGLE = 5
WIDTH, STRIDE, STRETCH, BANDS = 8, 4, 4, 64
CONTAINED = 0.8
#: Bits of the table of template shingles, a power of two, and bits that each shingle sets.
BITS, PROBES = 1 << 18, 3


def shingles(w: Column, size: int = SHINGLE) -> Column:
    """Hashes of the shingles of ``size`` words of a column of words, in order."""
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)),
                                                 lambda i: F.xxhash64(F.slice(w, i, F.lit(size))))).otherwise(F.array().cast("array<bigint>"))


def _starts(n: Column, step: int, width: int) -> Column:
    """Places of windows that cover n shingles; none without shingles."""
    last = F.greatest(F.lit(0), F.ceil((n - width) / F.lit(step)).cast("int"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def bands(window: Column) -> Column:
    """MinHash of a window's shingles in each band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.struct(b.alias("band"), F.array_min(F.transform(window, lambda s: F.xxhash64(s, b))).alias("low")))


def templates(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(license, size, s): the number of words of each template's shingles and
    these in order; a template of fewer than five words is one shingle."""
    rows = list((TEMPLATES if texts is None else texts).items())
    w = spark.createDataFrame(rows, "license string, text string").select("license", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    return w.select("license", F.least(F.lit(SHINGLE), F.size("w")).alias("size"),
                    F.when(F.size("w") < SHINGLE, F.array(F.xxhash64("w"))).otherwise(shingles(F.col("w"))).alias("s"))


def _places(shingle: Column, bits: int = BITS) -> list[Column]:
    """The bits of a shingle: stretches of its hash."""
    step = bits.bit_length() - 1
    return [F.shiftrightunsigned(shingle, k * step).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]


def bit_table(shingle: DataFrame, bits: int = BITS) -> Column:
    """Bits of all shingles as 64-bit words: a constant of a fixed size."""
    rows = shingle.select(F.explode(F.array(*_places(F.col("shingle"), bits))).alias("p")) \
        .select(F.expr("cast(p div 64 as int)").alias("at"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")) \
        .groupBy("at").agg(F.expr("bit_or(bit)").alias("word")).collect()  # bits / 64 rows at most
    table = [0] * (bits // 64)
    for r in rows:
        table[r["at"]] = r["word"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _known(shingle: Column, table: Column, bits: int = BITS) -> Column:
    out = F.lit(True)
    for p in _places(shingle, bits):
        out = out & (F.call_function("getbit", F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def scan(docs: DataFrame, licences: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """Per document and licence found: doc_id, license, first_word, n_found,
    n_shingles, containment.

    Defined results: null and empty texts hold no licence; a template of fewer
    than five words counts as one shingle, and texts of fewer than five words
    hold such templates only; templates without words are not looked for; of
    repeated rows with one doc_id the union of their shingles is searched and
    first_word is the smallest place; rows without doc_id are one such
    document; an empty table gives no rows; further columns are not read."""
    licences = cut(licences, "licences")
    sizes = [r["size"] for r in licences.select("size").distinct().orderBy("size").collect()]  # at most SHINGLE numbers
    if not sizes:
        return docs.limit(0).select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in (("license", "string"), ("first_word", "long"), ("n_found", "long"),
                                                                                           ("n_shingles", "long"), ("containment", "double"))))
    own = cut(licences.select("license", "size", F.size(F.array_distinct("s")).cast("long").alias("n_shingles"), F.explode(F.array_distinct("s")).alias("shingle")), "licence-shingles")
    table = bit_table(own.select("shingle"))
    # Marks of the templates' stretches.
    stretch = licences.select("license", "size", F.explode(_starts(F.size("s"), STRETCH, STRETCH)).alias("i"), "s") \
        .select("license", "size", F.explode(bands(F.slice("s", F.col("i") + 1, F.lit(STRETCH)))).alias("b"))
    marks = cut(stretch.select("license", "size", "b.band", "b.low").distinct(), "licence-bands")
    # Texts are split once; of each size only texts with a known bit go on.
    split = docs.select("doc_id", F.explode(F.array(words(F.col("text")))).alias("w"))
    cutup = split.select("doc_id", F.explode(F.array(*[F.struct(F.lit(n).alias("size"), shingles(F.col("w"), n).alias("s")) for n in sizes])).alias("x"))
    held = cut(cutup.select("doc_id", "x.size", "x.s").filter(F.exists("s", lambda x: _known(x, table))), "licence-docs")
    windows = (held.select("doc_id", "size", "s", F.explode(_starts(F.size("s"), STRIDE, WIDTH)).alias("i"))
               .select("doc_id", "size", F.slice("s", F.col("i") + 1, F.lit(WIDTH)).alias("w")).filter(F.exists("w", lambda x: _known(x, table))))
    # The bands choose the pairs.
    met = cut(windows.select("doc_id", "size", F.explode(bands(F.col("w"))).alias("b")).select("doc_id", "size", "b.band", "b.low")
              .join(marks, ["size", "band", "low"]).select("doc_id", "license", "size").distinct(), "licence-candidates")
    # Containment of these pairs alone: the template's shingles are looked for in the document's.
    at = held.select("doc_id", "size", F.posexplode("s").alias("pos", "shingle")).filter(_known(F.col("shingle"), table)) \
        .groupBy("doc_id", "size", "shingle").agg(F.min("pos").alias("pos"))
    asked = met.join(own, ["license", "size"]).withColumnRenamed("doc_id", "of")
    found = (asked.alias("m").join(at.alias("d"), F.col("m.of").eqNullSafe(F.col("d.doc_id")) & (F.col("m.size") == F.col("d.size")) & (F.col("m.shingle") == F.col("d.shingle")))
             .groupBy("of", "license", "n_shingles").agg(F.count(F.lit(1)).alias("n_found"), F.min("pos").cast("long").alias("first_word")))
    return (found.filter(F.col("n_found") >= F.col("n_shingles") * contained)
            .select(F.col("of").alias("doc_id"), "license", "first_word", "n_found", "n_shingles", (F.col("n_found") / F.col("n_shingles")).alias("containment")))


def oracle() -> str:
    """The same by exact containment over all documents, without MinHash."""
    values = ", ".join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    low = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH t AS (SELECT license, w, least(len(w), 5) k FROM (SELECT license, {low} w FROM (VALUES {values}) v(license, text))),
ts AS (SELECT DISTINCT license, k, array_to_string(w[s:s + k - 1], ' ') x FROM (SELECT license, w, k, unnest(range(1, len(w) - k + 2)) s FROM t)),
tn AS (SELECT license, count(*)::BIGINT n_shingles FROM ts GROUP BY license),
d AS (SELECT doc_id, {low} w FROM documents),
ds AS (SELECT doc_id, k, array_to_string(w[s:s + k - 1], ' ') x, min(s) - 1 p FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) s FROM d, (SELECT DISTINCT k FROM t)) GROUP BY ALL),
f AS (SELECT doc_id, license, count(*)::BIGINT n_found, min(p)::BIGINT first_word FROM ds JOIN ts USING (k, x) GROUP BY ALL)
SELECT doc_id, license, first_word, n_found, n_shingles, n_found / n_shingles containment
FROM f JOIN tn USING (license) WHERE n_found >= n_shingles * 0.8
"""
