"""Operator 11: prefix trie of conversations, kept as a z-fast trie.

A conversation is a sequence of turns; a path of the trie is a sequence of
turns from the root. Only compacted nodes are stored: the root, ends of
conversations and branchings. A node's edge covers the depths (up, depth]; its
handle is the depth of that range with most trailing zero bits, and the table
is keyed by the handle and the hash of the path's prefix of that length.

1. Turns get their places by a range sort: counts per partition are added up,
   so a conversation of any length may span partitions. A prefix is named by
   two 64-bit xors of the hashes of its placed turns, which add up the same way.
2. Batches of distinct conversations are inserted one after another:
   a. The exit node is found by fat binary search: of the depths that are
      left, (lo, hi], the handle depth is looked up; a hit goes on below the
      node's edge, a miss above the handle. So a conversation of n turns asks
      about log2(n) times, each time by two equi-joins.
   b. The edge it leaves on is expanded to one row per depth, as are the
      conversation's own turns below its exit; equal rows are one. Rows where
      paths part, conversations end or an old node stood become nodes, and
      replace the edge in the table.
3. Members, ends, leaves and bytes are summed over subtrees by pointer
   doubling: a round adds to each node what its descendants of the next power
   of two of levels hold, so the height needs log2 rounds.
4. Edges are expanded to one row per turn, which carries the counts.

A chain of rows with one child keeps its smallest conversation, so the nodes
above a node are the nodes of the same conversation, and one where it parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from titlepulse.llm.common import cut, ship

FAMILY = 5
HEADS = 9
#: A batch is a share of sixteenths of the conversations, by hash.
BATCHES = (1, 3, 12)
#: Steps of the binary search in one plan.
STEPS = 4


def turn_names(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, name, n_bytes): the name is the sha-256 of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return turns.filter("conv_id is not null").select("conv_id", "turn", name.alias("name"), F.octet_length(text).cast("long").alias("n_bytes"))


def placed(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with part and seq, pieces): rows in order of conversation, turn
    (null first) and name; pieces say how many turns of each conversation
    stand in each partition, and how many before them."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("name")]
    rows = cut(named.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    return rows, cut(pieces.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "pieces")


def _mark(lane: int) -> Column:
    """Hash of a turn at its place."""
    return F.xxhash64(F.lit(lane), "d", "name")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, paths) of the rebuilt conversations. convs: conv_id, n turns, a
    and b (name of the whole path), total bytes. paths: one row per turn with
    conv_id, d, a, b, the names a0 and b0 of the path without it, and the
    bytes up to and with it."""
    rows, pieces = placed(turn_names(turns))
    lens = pieces.groupBy("conv_id").agg(F.sum("n").alias("len"))
    c = F.col("conv_id")
    own = lens.select("conv_id", "len", (F.crc32(c.cast("string").cast("binary")) % HEADS).alias("h"), (c - c % FAMILY).alias("base"))
    bases = lens.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    convs = cut(own.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_len", F.lit(0))))
                .select("conv_id", "base", "len", "h", "m"), "convs")
    # Heads: at most HEADS - 1 turns of a base, for at most a few conversations.
    pos = (F.col("seq") - F.col("first") + F.col("before") + 1).alias("d")
    at = rows.join(pieces.withColumnRenamed("conv_id", "of").withColumnRenamed("part", "in"), (F.col("conv_id") == F.col("of")) & (F.col("part") == F.col("in"))) \
        .select("conv_id", "part", "seq", pos, "name", "n_bytes")
    run = Window.partitionBy("base").orderBy("d")
    heads = cut(at.filter((F.col("d") < HEADS) & (F.col("conv_id") % FAMILY == 0))
                .select(F.col("conv_id").alias("base"), "d", _mark(0).alias("x"), _mark(1).alias("y"), "n_bytes")
                .select("base", "d", "x", "y", F.expr("bit_xor(x)").over(run).alias("a"), F.expr("bit_xor(y)").over(run).alias("b"),
                        F.sum("n_bytes").over(run).alias("bytes")), "heads")
    head = convs.join(heads, "base").filter(F.col("d") <= F.col("m")).select("conv_id", "d", "x", "y", "a", "b", "bytes")
    # Tails: partial xors and sums per piece, carried over pieces and the head.
    last = heads.select(F.col("base").alias("base"), F.col("d").alias("m"), F.col("a").alias("ha"), F.col("b").alias("hb"), F.col("bytes").alias("hbytes"))
    carried = convs.filter("len > h").join(last, ["base", "m"], "left").select(
        F.col("conv_id").alias("of"), "h", "m", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("ha", "hb", "hbytes")))
    shift = pieces.select(F.col("conv_id").alias("of"), F.col("part").alias("in"), "first", "before").join(carried, "of")
    tail = cut(rows.join(shift, (F.col("conv_id") == F.col("of")) & (F.col("part") == F.col("in")))
               .withColumn("p", F.col("seq") - F.col("first") + F.col("before") + 1).filter("p > h")
               .withColumn("d", F.col("p") - F.col("h") + F.col("m"))
               .select("conv_id", "part", "d", _mark(0).alias("x"), _mark(1).alias("y"), "n_bytes", "ha", "hb", "hbytes"), "tail")
    sums = tail.groupBy("conv_id", "part").agg(F.expr("bit_xor(x)").alias("px"), F.expr("bit_xor(y)").alias("py"), F.sum("n_bytes").alias("pb"))
    prior = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut(sums.select(F.col("conv_id").alias("of"), F.col("part").alias("in"),
                            *(F.coalesce(F.expr(f).over(prior), F.lit(0)).alias(n) for f, n in (("bit_xor(px)", "cx"), ("bit_xor(py)", "cy"), ("sum(pb)", "cb")))), "carry")
    within = Window.partitionBy("conv_id", "part").orderBy("d")
    body = tail.join(carry, (F.col("conv_id") == F.col("of")) & (F.col("part") == F.col("in"))).select(
        "conv_id", "d", "x", "y", (F.expr("bit_xor(x)").over(within).bitwiseXOR(F.col("cx")).bitwiseXOR(F.col("ha"))).alias("a"),
        (F.expr("bit_xor(y)").over(within).bitwiseXOR(F.col("cy")).bitwiseXOR(F.col("hb"))).alias("b"),
        (F.sum("n_bytes").over(within) + F.col("cb") + F.col("hbytes")).alias("bytes"))
    paths = cut(head.unionByName(body).select("conv_id", "d", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("a0"),
                                              F.col("b").bitwiseXOR(F.col("y")).alias("b0"), "bytes"), "paths")
    n = F.when(F.col("len") > F.col("h"), F.col("len") - F.col("h") + F.col("m")).otherwise(F.col("m"))
    ends = paths.select(F.col("conv_id").alias("of"), F.col("d").alias("n"), "a", "b", F.col("bytes").alias("total"))
    sized = convs.select("conv_id", n.alias("n"))
    zero = [F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in ("a", "b", "total")]
    return cut(sized.join(ends, (F.col("conv_id") == F.col("of")) & (sized["n"] == ends["n"]), "left")
               .select("conv_id", sized["n"], *zero), "ends"), paths


def fattest(lo: str, hi: str) -> Column:
    """The number of (lo, hi] with most trailing zero bits: hi without the
    bits below the highest one in which it differs from lo."""
    return F.expr(f"{hi} & shiftleft(-1L, length(bin({lo} ^ {hi})) - 1)")


NODE = ["depth", "a", "b", "up", "ua", "ub", "rep", "handle", "fa", "fb", "ca", "cb"]
#: depth, name, parent's depth and name, a conversation on whose path it lies,
#: handle depth and name, and the name of its edge's first row.
NODES = ("depth long, a long, b long, up long, ua long, ub long, rep long, handle long, fa long, fb long, ca long, cb long")


def search(strings: DataFrame, paths: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """strings(rep, n) -> (rep, n, base, edge_depth, edge_a, edge_b): depth
    to which the nodes hold the conversation, and the edge it leaves on, null
    where it leaves at a node."""
    hold = paths.select(F.col("conv_id").alias("pc"), F.col("d").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    table = nodes.filter("depth > 0").select("handle", "fa", "fb", F.col("depth").alias("e"), F.col("a").alias("ea"), F.col("b").alias("eb"), F.col("up").alias("eu"))
    zero = F.lit(0).cast("long")
    state = strings.select("rep", "n", zero.alias("lo"), F.col("n").alias("hi"), zero.alias("na"), zero.alias("nb"), zero.alias("nu"))
    steps = max(1, int(longest).bit_length())
    for k in range(steps):
        f = F.when(F.col("lo") < F.col("hi"), fattest("lo", "hi")).otherwise(zero).alias("f")
        asked = state.select("*", f)
        got = asked.join(hold, (F.col("rep") == F.col("pc")) & (F.col("f") == F.col("pd")), "left")
        # Conversations that are done ask nothing: their keys are their own, not one null.
        got = got.withColumn("pa", F.coalesce("pa", "rep"))
        hit = got.join(table, (F.col("f") == F.col("handle")) & (F.col("pa") == F.col("fa")) & (F.col("pb") == F.col("fb")), "left")
        busy, found = F.col("f") > 0, F.col("e").isNotNull()
        state = hit.select("rep", "n", F.when(found, F.col("e")).otherwise(F.col("lo")).alias("lo"),
                           F.when(busy & ~found, F.col("f") - 1).otherwise(F.col("hi")).alias("hi"),
                           *(F.when(found, F.col(new)).otherwise(F.col(old)).alias(old) for new, old in (("ea", "na"), ("eb", "nb"), ("eu", "nu"))))
        if k % STEPS == STEPS - 1 or k == steps - 1:
            state = cut(state, "search")
    # Is the whole edge of the last hit on the path? Else the conversation leaves inside it.
    seen = state.join(hold, (F.col("rep") == F.col("pc")) & (F.col("lo") == F.col("pd")), "left")
    whole = (F.col("lo") == 0) | (F.coalesce((F.col("pa") == F.col("na")) & (F.col("pb") == F.col("nb")), F.lit(False)))
    inside = seen.select("rep", "n", "lo", "na", "nb", "nu", whole.alias("whole"))
    # At a node: the child whose edge begins with the next turn, if there is one.
    nxt = paths.select(F.col("conv_id").alias("xc"), F.col("d").alias("xd"), F.col("a").alias("xa"), F.col("b").alias("xb"))
    first = nodes.filter("depth > 0").select((F.col("up") + 1).alias("cd"), F.col("ca"), F.col("cb"), F.col("depth").alias("ce"), F.col("a").alias("cea"), F.col("b").alias("ceb"))
    below = (inside.filter("whole").join(nxt, (F.col("rep") == F.col("xc")) & (F.col("lo") + 1 == F.col("xd")), "left")
             .withColumn("xa", F.coalesce("xa", "rep"))
             .join(first, (F.col("xd") == F.col("cd")) & (F.col("xa") == F.col("ca")) & (F.col("xb") == F.col("cb")), "left")
             .select("rep", "n", F.col("lo").alias("base"), F.col("ce").alias("edge_depth"), F.col("cea").alias("edge_a"), F.col("ceb").alias("edge_b")))
    return below.unionByName(inside.filter("not whole").select("rep", "n", F.col("nu").alias("base"), F.col("lo").alias("edge_depth"),
                                                               F.col("na").alias("edge_a"), F.col("nb").alias("edge_b")))


def insert(strings: DataFrame, paths: DataFrame, nodes: DataFrame | None, longest: int) -> DataFrame:
    """The table of nodes with a batch of distinct conversations in it."""
    row = paths.select(F.col("conv_id").alias("pc"), "d", "a", "b", "a0", "b0")
    if nodes is None:
        exits = strings.select("rep", "n", F.lit(0).cast("long").alias("base"))
        edges = None
    else:
        found = cut(search(strings, paths, nodes, longest), "exits")
        exits = found.select("rep", "n", "base")
        out = found.filter("edge_depth is not null").select(*(F.col(f"edge_{c}").alias(f"x{c}") for c in ("depth", "a", "b"))).distinct()
        mark = cut(out, "edges")
        edges = nodes.join(mark, (F.col("depth") == F.col("xdepth")) & (F.col("a") == F.col("xa")) & (F.col("b") == F.col("xb")), "left_semi")
        rest = nodes.join(mark, (F.col("depth") == F.col("xdepth")) & (F.col("a") == F.col("xa")) & (F.col("b") == F.col("xb")), "left_anti")
    # An edge begins where the conversation left a node, or where the old edge began.
    fresh = exits.join(row, (F.col("rep") == F.col("pc")) & (F.col("d") > F.col("base"))) \
        .select("d", "a", "b", "a0", "b0", "rep", (F.col("d") == F.col("n")).alias("node"), (F.col("d") == F.col("base") + 1).alias("top"))
    if edges is not None:
        old = edges.select(F.col("rep").alias("er"), F.col("up").alias("eu"), F.col("depth").alias("ed"), F.explode(F.sequence(F.col("up") + 1, F.col("depth"))).alias("at"))
        fresh = fresh.unionByName(old.join(row, (F.col("er") == F.col("pc")) & (F.col("at") == F.col("d"))).select(
            "d", "a", "b", "a0", "b0", F.col("er").alias("rep"), (F.col("d") == F.col("ed")).alias("node"), (F.col("d") == F.col("eu") + 1).alias("top")))
    rows = cut(fresh.groupBy("d", "a", "b", "a0", "b0").agg(F.min("rep").alias("rep"), F.max("node").alias("node"), F.max("top").alias("top")), "region")
    forks = rows.groupBy((F.col("d") - 1).alias("fd"), F.col("a0").alias("fa"), F.col("b0").alias("fb")).agg(F.count(F.lit(1)).alias("kids")).filter("kids > 1")
    kept = cut(rows.join(forks, (F.col("d") == F.col("fd")) & (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")), "left")
               .filter("node or kids is not null").select(F.col("d").alias("kd"), F.col("a").alias("ka"), F.col("b").alias("kb")), "region-nodes")
    # The first row below each node, and the nodes: what lies between them has one child.
    tops = rows.filter("top").select("rep", "d").unionByName(
        rows.filter("not top").join(kept, (F.col("d") - 1 == F.col("kd")) & (F.col("a0") == F.col("ka")) & (F.col("b0") == F.col("kb")), "left_semi").select("rep", "d"))
    ends = rows.join(kept, (F.col("d") == F.col("kd")) & (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")), "left_semi").select("rep", "d", "a", "b")
    path = Window.partitionBy("rep").orderBy("d", "first").rowsBetween(Window.unboundedPreceding, 0)
    marks = tops.select("rep", "d", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).alias("first")) \
        .unionByName(ends.select("rep", "d", "a", "b", F.lit(1).alias("first")))
    new = marks.withColumn("up", F.max(F.when(F.col("first") == 0, F.col("d") - 1)).over(path)).filter("first = 1") \
        .select(F.col("d").alias("depth"), "a", "b", "rep", "up").withColumn("handle", fattest("up", "depth"))
    hand = row.select(F.col("pc").alias("hc"), F.col("d").alias("hd"), F.col("a").alias("fa"), F.col("b").alias("fb"))
    edge = row.select(F.col("pc").alias("ec"), F.col("d").alias("edge"), F.col("a").alias("ca"), F.col("b").alias("cb"), F.col("a0").alias("ua"), F.col("b0").alias("ub"))
    new = new.join(hand, (F.col("rep") == F.col("hc")) & (F.col("handle") == F.col("hd"))) \
        .join(edge, (F.col("rep") == F.col("ec")) & (F.col("up") + 1 == F.col("edge"))).select(*NODE)
    return cut(new if nodes is None else rest.unionByName(new), "nodes")


def subtree_sums(values: DataFrame) -> DataFrame:
    """values(depth, a, b, up, ua, ub, n_convs, low, total, leaves, edge_bytes)
    -> the same for whole subtrees, by pointer doubling."""
    key = ["depth", "a", "b"]
    sums = ["n_convs", "total", "leaves", "edge_bytes"]
    state = cut(values, "sums")
    while True:
        up = state.filter("up is not null")
        if up.isEmpty():
            return state.select(*key, *sums, "low")
        told = up.groupBy(F.col("up").alias("td"), F.col("ua").alias("ta"), F.col("ub").alias("tb")).agg(
            *(F.sum(c).alias(f"t_{c}") for c in sums), F.min("low").alias("t_low"))
        jump = state.select(F.col("depth").alias("jd"), F.col("a").alias("ja"), F.col("b").alias("jb"),
                            F.col("up").alias("next"), F.col("ua").alias("next_a"), F.col("ub").alias("next_b"))
        grown = state.join(told, (F.col("depth") == F.col("td")) & (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left").select(
            *key, "up", "ua", "ub", *((F.col(c) + F.coalesce(F.col(f"t_{c}"), F.lit(0))).alias(c) for c in sums), F.least("low", "t_low").alias("low"))
        grown = cut(grown, "sums")
        there = (F.col("up") == F.col("jd")) & (F.col("ua") == F.col("ja")) & (F.col("ub") == F.col("jb"))
        moved = grown.filter("up is not null").join(jump, there).select(*key, *sums, "low", F.col("next").alias("up"), F.col("next_a").alias("ua"), F.col("next_b").alias("ub"))
        state = cut(grown.filter("up is null").select(*key, *sums, "low", "up", "ua", "ub").unionByName(moved), "sums")


def _digests():
    """One row per node from (depth, a, b, conv_id) rows in order: the sha-256
    of its decimals, comma-joined, as they stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", "a", "b", "ends_sha256"]
        key, sha = None, None
        for batch in batches:
            done = []
            for *k, c in zip(*(batch.column(x).to_pylist() for x in ("depth", "a", "b", "conv_id")), strict=True):
                if k != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(str(c).encode())
                else:
                    sha.update(b",%d" % c)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done])
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, sha.hexdigest()), strict=True))])

    return run


def build(convs: DataFrame, paths: DataFrame, batches: tuple[int, ...] = BATCHES) -> tuple[DataFrame, DataFrame | None, int]:
    """(distinct conversations, nodes, longest length): batch after batch."""
    strings = cut(convs.groupBy("n", "a", "b").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("total").alias("total")), "strings")
    longest = strings.agg(F.max("n").alias("m")).first()["m"]
    if not longest:
        return strings, None, longest
    share = F.pmod(F.xxhash64("a", "b", "n"), F.lit(sum(batches)))
    nodes, at = None, 0
    for size in batches:
        batch = strings.filter((F.col("n") > 0) & (share >= at) & (share < at + size)).select("rep", "n")
        nodes, at = insert(batch, paths, nodes, longest), at + size
    return strings, nodes, longest


def conversation_trie(turns: DataFrame, batches: tuple[int, ...] = BATCHES) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Defined results: rows without conv_id belong to no conversation and make
    none; null turns come first, equal turns of a conversation in the order
    of the sha-256 of their role and text, repeated rows are turns of their
    own; null roles and texts are empty; conversations without a turn end at
    the root; an empty table has no conversation and gives no rows; further
    columns are not read. A negative id's family counts towards zero."""
    spark = turns.sparkSession
    ship(spark)
    convs, paths = rebuilt(turns)
    strings, nodes, longest = build(convs, paths, batches)
    if longest is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    zero = F.lit(0).cast("long")
    if nodes is None:
        nodes = spark.createDataFrame([], NODES)
    root = spark.range(1).select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), *(F.lit(None).cast("long").alias(c) for c in ("up", "ua", "ub")), zero.alias("edge_bytes"))
    low = paths.select(F.col("conv_id").alias("lc"), F.col("d").alias("ld"), F.col("bytes").alias("to"))
    high = paths.select(F.col("conv_id").alias("hc"), F.col("d").alias("hd"), F.col("bytes").alias("from"))
    edges = cut(nodes.join(low, (F.col("rep") == F.col("lc")) & (F.col("depth") == F.col("ld")))
                .join(high, (F.col("rep") == F.col("hc")) & (F.col("up") == F.col("hd")), "left")
                .select("depth", "a", "b", "up", "ua", "ub", "rep", F.coalesce("from", F.lit(0)).alias("from"),
                        (F.col("to") - F.coalesce("from", F.lit(0))).alias("edge_bytes")), "edge-bytes")
    every = edges.drop("rep", "from").unionByName(root)
    kids = edges.groupBy(F.col("up").alias("kd"), F.col("ua").alias("ka"), F.col("ub").alias("kb")).agg(F.count(F.lit(1)).alias("kids"))
    done = strings.select(F.col("n").alias("sd"), F.col("a").alias("sa"), F.col("b").alias("sb"), "rep", "copies", (F.col("copies") * F.col("total")).alias("sum"))
    valued = cut(every.join(done, (F.col("depth") == F.col("sd")) & (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb")), "left")
                 .join(kids, (F.col("depth") == F.col("kd")) & (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")), "left")
                 .select("depth", "a", "b", "up", "ua", "ub", F.coalesce("copies", zero).alias("n_convs"), F.col("rep").alias("low"),
                         F.coalesce("sum", zero).alias("total"), F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
                         "edge_bytes", F.coalesce("kids", zero).alias("kids")), "values")
    sums = cut(subtree_sums(valued.drop("kids")), "subtrees")
    names = ["depth", "a", "b"]
    listed = convs.select(F.col("n").alias("depth"), "a", "b", "conv_id")
    # Ids of a node stream by in order; only the hash of a node is held.
    ends = cut(listed.repartition(*names).sortWithinPartitions(*names, "conv_id").mapInArrow(_digests(), "depth long, a long, b long, ends_sha256 string"), "ends-sha")
    own = cut(valued.select(*names, "kids", "up", "ua", "ub").join(sums, names).join(ends, names, "left"), "node-sums")
    over = own.select(F.col("depth").alias("od"), F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("low").alias("parent"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    at_root = own.filter("depth = 0").select(
        F.col("low").alias("conv_id"), F.col("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("total") - F.col("edge_bytes")).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    # Expand each edge: one row per depth, with the bytes above it.
    full = edges.select(*names, "rep", "from", F.explode(F.sequence(F.col("up") + 1, F.col("depth"))).alias("at")) \
        .join(own.join(over, (F.col("up") == F.col("od")) & (F.col("ua") == F.col("oa")) & (F.col("ub") == F.col("ob"))), names)
    above = paths.select(F.col("conv_id").alias("ac"), (F.col("d") + 1).alias("ad"), F.col("bytes").alias("above"))
    over_it = F.coalesce("above", zero)
    here, top = F.col("at") == F.col("depth"), F.col("at") == F.col("up") + 1
    rows = full.join(above, (F.col("rep") == F.col("ac")) & (F.col("at") == F.col("ad")), "left").select(
        F.col("low").alias("conv_id"), F.col("at").alias("depth"), F.when(top, F.col("parent")).otherwise(F.col("low")).alias("parent_conv_id"), "n_convs",
        F.when(here, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("total") - F.col("n_convs") * over_it - F.col("edge_bytes") + over_it - F.col("from")).alias("saved_tokens"),
        F.when(here, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"))
    return rows.unionByName(at_root)


ORACLE = r"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) p
           FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                        sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) k
                 FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 5 base, (4294967295 - list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda crc, x: list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(crc, x)), 4294967295)) % 9 h
      FROM (SELECT DISTINCT conv_id FROM t)),
s AS (SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.base AND p <= h
      UNION ALL SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
x AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) d, sha256(octet_length(encode(role)) || ':' || role || text) k,
             octet_length(encode(text))::BIGINT nb FROM s),
w AS (SELECT conv_id, d, nb, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d) pre FROM x
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, sha256(pre) q FROM w),
last AS (SELECT conv_id, max(d) n FROM m GROUP BY conv_id),
e AS (SELECT q, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) ends_sha256 FROM m JOIN last USING (conv_id) WHERE d = n GROUP BY q),
node AS (SELECT q, d, min(conv_id) conv_id, count(*) n_convs, any_value(nb) nb FROM m GROUP BY q, d),
par AS (SELECT n.q, n.conv_id, n.d, n.n_convs, n.nb, m.q pq FROM node n LEFT JOIN m ON m.conv_id = n.conv_id AND m.d = n.d - 1),
kid AS (SELECT pq q, count(*) n FROM par WHERE pq IS NOT NULL GROUP BY pq),
anc AS (SELECT m.q, u.q uq, (u.n_convs - 1) * u.nb saved, kid.n IS NULL leaf FROM node u JOIN m ON m.conv_id = u.conv_id AND m.d <= u.d LEFT JOIN kid ON kid.q = u.q),
sub AS (SELECT q, sum(saved)::BIGINT saved_tokens, count(*) FILTER (WHERE leaf) n_leaves FROM anc GROUP BY q)
SELECT par.conv_id, par.d::BIGINT depth, up.conv_id parent_conv_id, par.n_convs::BIGINT n_convs, coalesce(kid.n, 0)::BIGINT n_children, n_leaves::BIGINT n_leaves,
       saved_tokens, coalesce(ends_sha256, sha256('')) ends_sha256
FROM par JOIN sub USING (q) LEFT JOIN kid USING (q) LEFT JOIN node up ON up.q = par.pq LEFT JOIN e ON e.q = par.q
"""
