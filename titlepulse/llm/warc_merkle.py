"""Operator 2: Merkle fixity audit of WARC replicas.

Records of an archive lie one after the other in files; each has an offset.
Leaves are the hashes of records with their offset range; sixteen neighbours
make a node, in a file first and over the files after that, up to one root
per replica. Two replicas are compared at their roots and only children of
nodes that differ are looked at, level by level, down to the records.

DataFrame functions alone. A node gathers at most sixteen children, and the
set of nodes that is followed grows with the damage, not with the archive.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from titlepulse.llm.common import cut

FAN = 16
FILE_IDS = 1000
#: Files of pages without id: as many as this, below zero.
LOOSE_FILES = 4096
DATE = "1970-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """One WARC response record as bytes."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
                    F.lit("\r\n\r\n")).cast("binary")


def archive(pages: DataFrame, file_ids: int = FILE_IDS) -> DataFrame:
    """pages(page_id, url, html) -> records (file_id, seq, page_id, off, len,
    record): a file holds the pages of ``file_ids`` consecutive ids in order
    (equal ids by their content's hash); pages without id are dealt to
    LOOSE_FILES files below zero by their content's hash."""
    rows = pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")) \
        .withColumn("file_id", F.coalesce(F.floor(F.col("page_id") / file_ids), -1 - F.pmod(F.xxhash64("record"), F.lit(LOOSE_FILES))).cast("long")) \
        .withColumn("len", F.length("record").cast("long"))
    order = Window.partitionBy("file_id").orderBy("page_id", F.xxhash64("record"), "len")
    return rows.select("file_id", (F.row_number().over(order) - 1).cast("long").alias("seq"), "page_id",
                       (F.sum("len").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("len")).alias("off"),
                       "len", "record")


def tree(records: DataFrame, name: str = "tree") -> DataFrame:
    """Nodes (step, grp, idx, lo, hi, hash) of all levels. In a file: grp is
    the file, idx the node's place; over the files: grp is null and idx counts
    files by sixteens. step 0 are the leaves, the last is the root."""
    node = [F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "lo", "hi", "hash"))),
                                            lambda x: F.concat_ws(":", x["idx"], x["lo"], x["hi"], x["hash"])), "|").cast("binary"), 256).alias("hash")]
    level = cut(records.select(F.lit(0).alias("step"), F.col("file_id").alias("grp"), F.col("seq").alias("idx"),
                               F.col("off").alias("lo"), (F.col("off") + F.col("len")).alias("hi"), F.sha2("record", 256).alias("hash")), name)
    out, step = level, 0
    most = level.agg(F.max("idx").alias("m")).first()["m"]
    if most is None:
        return out
    while most > 0:
        step, most = step + 1, most // FAN
        level = cut(level.groupBy("grp", F.expr(f"idx div {FAN}").alias("up")).agg(*node)
                    .select(F.lit(step).alias("step"), "grp", F.col("up").alias("idx"), "lo", "hi", "hash"), name)
        out = out.unionByName(level)
    # Over the files: a file without records between two others is left out of its node; files below zero come first.
    level = level.select("step", F.lit(None).cast("long").alias("grp"), (F.col("grp") + LOOSE_FILES).alias("idx"), "lo", "hi", "hash")
    most = level.agg(F.max("idx").alias("m")).first()["m"]
    first = True
    while most > 0 or first:
        step, most, first = step + 1, most // FAN, False
        level = cut(level.groupBy(F.expr(f"idx div {FAN}").alias("up")).agg(*node)
                    .select(F.lit(step).alias("step"), F.lit(None).cast("long").alias("grp"), F.col("up").alias("idx"), "lo", "hi", "hash"), name)
        out = out.unionByName(level)
    return out


def descend(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaves (file_id, seq) that differ between two trees, one side missing
    included. Trees of different height are compared in full below."""
    tops = [t.agg(F.max("step").alias("s")).first()["s"] for t in (a, b)]
    files = [t.filter("grp is not null").agg(F.max("step").alias("s")).first()["s"] for t in (a, b)]

    def at(t: DataFrame, step: int) -> DataFrame:
        return t.filter(F.col("step") == step).select("grp", "idx", "hash")

    def differ(step: int, within: DataFrame | None) -> DataFrame:
        x, y = at(a, step), at(b, step)
        if within is not None:
            x, y = (s.join(within, s["grp"].eqNullSafe(within["pg"]) & (F.expr(f"idx div {FAN}") == within["pi"]), "left_semi") for s in (x, y))
        both = x.alias("x").join(y.alias("y"), F.col("x.grp").eqNullSafe(F.col("y.grp")) & (F.col("x.idx") == F.col("y.idx")), "full")
        return both.filter(~F.col("x.hash").eqNullSafe(F.col("y.hash"))).select(
            F.coalesce("x.grp", "y.grp").alias("pg"), F.coalesce("x.idx", "y.idx").alias("pi"))

    if tops[0] is None or tops[1] is None or tops != tops[::-1] or files != files[::-1]:
        return differ(0, None).select(F.col("pg").alias("file_id"), F.col("pi").alias("seq"))
    top, in_files = tops[0], files[0]
    bad = cut(differ(top, None), "frontier")
    for step in range(top - 1, -1, -1):
        if step == in_files:  # from the files' tree into the files: idx counts them from -LOOSE_FILES, their top node is 0
            x, y = (t.filter(F.col("step") == step).select("grp", "idx", "hash")
                    .join(bad, F.expr(f"(grp + {LOOSE_FILES}) div {FAN}") == F.col("pi"), "left_semi") for t in (a, b))
            both = x.alias("x").join(y.alias("y"), (F.col("x.grp") == F.col("y.grp")) & (F.col("x.idx") == F.col("y.idx")), "full")
            bad = cut(both.filter(~F.col("x.hash").eqNullSafe(F.col("y.hash"))).select(
                F.coalesce("x.grp", "y.grp").alias("pg"), F.coalesce("x.idx", "y.idx").alias("pi")), "frontier")
        else:
            bad = cut(differ(step, bad), "frontier")
    return bad.select(F.col("pg").alias("file_id"), F.col("pi").alias("seq"))


def audit(records: DataFrame, replica: DataFrame) -> DataFrame:
    """Damaged records: file_id, page_id, off, len, sha256 (expected), found
    (the replica's hash, null when it has no such record). Both are read for
    their trees and again for the damaged records, so pass written tables.

    Defined results: pages without id lie in files of their own, null url and
    html are empty, equal pages are records of their own; two empty archives
    agree; a record that only the replica has comes with null page_id, off,
    len and sha256; further columns are not read."""
    bad = descend(tree(records, "tree-a"), tree(replica, "tree-b"))
    mine = records.join(bad, ["file_id", "seq"], "left_semi").select("file_id", "seq", "page_id", "off", "len", F.sha2("record", 256).alias("sha256"))
    other = replica.join(bad, ["file_id", "seq"], "left_semi").select("file_id", "seq", F.sha2("record", 256).alias("found"))
    return mine.join(other, ["file_id", "seq"], "full").select("file_id", "page_id", "off", "len", "sha256", "found")


def damaged_copy(records: DataFrame, every: int = 97, rest: int = 3) -> DataFrame:
    """A written replica in which the middle byte of each record whose page_id
    leaves ``rest`` modulo ``every`` became zero: bit rot to look for."""
    broken = F.expr("overlay(record placing unhex('00') from cast(len div 2 as int) for 1)")
    return cut(records.withColumn("record", F.when(F.pmod("page_id", F.lit(every)) == rest, broken).otherwise(F.col("record"))), "replica", compression="zstd")


ORACLE = r"""
WITH r AS (SELECT page_id, coalesce(page_id // 1000, -1)::BIGINT file_id,
       'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id ||
       '>' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') ||
       chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) ||
       coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) rec FROM pages),
o AS (SELECT *, octet_length(encode(rec))::BIGINT len,
             (sum(octet_length(encode(rec))) OVER (PARTITION BY file_id ORDER BY page_id))::BIGINT - octet_length(encode(rec))::BIGINT off FROM r)
SELECT file_id, page_id, off, len, sha256(rec) sha256 FROM o WHERE page_id % 97 = 3
"""
