"""Operator 7: exact deduplication by deterministic block naming.

Every normalised text is cut into fixed-size byte blocks. The distinct blocks
are sorted and numbered: that is their integer name. Adjacent names are paired
(the last one of an odd row with nothing), the distinct pairs are sorted and
numbered again, and so on, until each document has one name. Two documents
get the same (level, name) exactly when their texts are equal; a hash only
routes blocks to their names, and blocks that share a hash are named by their
whole content.

Native: DataFrame functions alone. The work per level halves; a document that
has its name leaves the loop. Hot blocks are combined map-side before they are
numbered, and the joins that bring names back are sort-merge joins that Spark
may split. Every table of names is written before it is used, since numbers
that were given out must not change when an executor is lost.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from titlepulse.llm.common import SPACE, cut, keyed, renamed

BLOCK = 2048


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _numbered(distinct: DataFrame, order: list[str], name: str) -> DataFrame:
    """Integer names in sort order, fixed by writing them."""
    return cut(distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id()), name)


def block_names(blocks: DataFrame, key_bits: int = 64) -> DataFrame:
    """blocks(row, idx, block) -> (row, idx, name)."""
    key = F.xxhash64("block") if key_bits == 64 else F.pmod(F.xxhash64("block"), F.lit(1 << key_bits))
    hashed = blocks.withColumn("key", key)
    names = _numbered(hashed.select("key", "block").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")),
                      ["key"], "block-names")
    at = hashed.select("row", "idx", "key")
    clash = cut(names.filter("n > 1").select("key"), "block-clash")
    if clash.isEmpty():
        return at.join(names.select("key", "name"), "key").select("row", "idx", "name")
    # Different blocks with one hash: these are named by content, below zero.
    whole = hashed.join(clash, "key", "left_semi")
    exact = _numbered(whole.select("block").distinct(), ["block"], "clash-names") \
        .withColumn("name", -F.col("name") - 1)
    plain = at.join(names.filter("n = 1").select("key", "name"), "key").select("row", "idx", "name")
    return plain.unionByName(whole.join(exact, "block").select("row", "idx", "name"))


def document_names(docs: DataFrame, block: int = BLOCK, key_bits: int = 64) -> DataFrame:
    """docs(row, body binary) -> (row, level, name)."""
    last = F.greatest(F.lit(0), F.ceil(F.length("body") / F.lit(block)).cast("int") - 1)
    blocks = (docs.select("row", "body", F.explode(F.sequence(F.lit(0), last)).alias("idx"))
              .select("row", "idx",
                      F.substring("body", F.col("idx") * block + 1, F.lit(block)).alias("block")))
    pieces, done, level = block_names(blocks, key_bits), None, 0
    while True:
        left, right = F.col("idx") % 2 == 0, F.col("idx") % 2 == 1
        pairs = cut(pieces.groupBy("row", F.expr("idx div 2").cast("int").alias("pair"))
                    .agg(F.max(F.when(left, F.col("name"))).alias("l"), F.max(F.when(right, F.col("name"))).alias("r")),
                    "pairs")
        alone = (F.col("pair") == 0) & F.col("r").isNull()
        one = pairs.filter(alone).select("row", F.lit(level).alias("level"), F.col("l").alias("name"))
        done = one if done is None else done.unionByName(one)
        rest = pairs.filter(~alone)
        if rest.isEmpty():
            return done
        names = _numbered(rest.select("l", "r").distinct(), ["l", "r"], "pair-names")
        pieces = (rest.alias("p").join(names.alias("n"), (F.col("p.l") == F.col("n.l")) & F.col("p.r").eqNullSafe(F.col("n.r")))
                  .select("p.row", F.col("p.pair").alias("idx"), "n.name"))
        level += 1


def exact_dedup(docs: DataFrame, block: int = BLOCK, key_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one
    space; the row with the smallest doc_id of a group stays. Defined results:
    a null text is empty, and empty texts are equal; every row is a document
    of its own and comes back, rows that repeat a doc_id or have none too; of
    rows with the smallest doc_id one stays; a row without doc_id stays, and
    keep_id is null, only where no row of its group has one; further columns
    are not read; an empty table gives no rows."""
    rows, odd = keyed(docs.select("doc_id", "text"))
    body = rows.select(F.col("_row").alias("row"), "doc_id", normalised(F.col("text")).cast("binary").alias("body"))
    named = document_names(body.select("row", "body"), block, key_bits)
    digests = body.select("row", "doc_id", F.sha2("body", 256).alias("text_sha256"))
    members = cut(digests.join(named, "row"), "members")
    # Written, so that the join deals both sides anew and may split a large group.
    groups = cut(members.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("stays")), "groups")
    out = members.join(groups, ["level", "name"]).select(
        F.col("row").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("stays")).alias("kept"), "text_sha256")
    return renamed(out, odd)
