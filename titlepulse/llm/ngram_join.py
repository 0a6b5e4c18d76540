"""Operator 3: n-gram Jaccard join with count-vector R-trees.

Sets are the distinct hashes of a text's 4-word shingles; two documents link
at a Jaccard similarity of 85 percent or more. What is done, in order:

1. Documents with equal sets are one class, the smallest id stands for it.
2. Tokens are hashed into groups and the groups counted over the corpus. A
   set's shingles are ordered by their group's count, rarest first. Linked
   sets share a shingle among the first |set| - ceil(0.85 |set|) + 1 of each,
   whatever the order is, so those shingles are the keys by which points
   are dealt to R-trees: no link is lost. An R-tree over all points alone
   would visit nearly every leaf, since random texts differ little per group.
3. In each key with several classes every class is compared with the key's
   smallest one first; large groups of near copies become one component by
   that, in as many comparisons as they have members.
4. Keys whose classes are not yet one component are split into blocks, and
   each pair of blocks of a key goes to a task: an R-tree over the count
   vectors (64 groups) of one block is searched with the points of the other.
   Pairs whose bound suffices there, and then in 256 finer groups, leave the
   task and are verified on their whole sets.
5. Components of the verified links, carried back to all documents.

Every set is computed from whole texts; comparisons are exact on 64-bit
shingle hashes. Tasks hold one block pair at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from titlepulse.llm.common import cut, keyed, renamed, ship, texts_by_row
from titlepulse.llm.graph import components
from titlepulse.llm.rtree import RTree, enough
from titlepulse.llm.words import BLACK, shingle_sets, text_bytes

WORDS = 4
NEED = 85
GROUPS = 64
FINE = 256
RARITY = 1 << 16
BLOCK = 512
LEAF = 16
CHUNK = 256


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for k in range(0, len(column), CHUNK):
        for i, s in enumerate(shingle_sets(text_bytes(column.slice(k, CHUNK)), BLACK, n)):
            yield k + i, s


def prefix_size(n: int, need: int) -> int:
    return n - (-(-need * n // 100)) + 1


def count_vector(s: np.ndarray) -> np.ndarray:
    """Shingles per group, in FINE groups; GROUPS are runs of these."""
    return np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=FINE).astype("<i4")


def coarse(fine: np.ndarray) -> np.ndarray:
    return fine.reshape(-1, GROUPS, FINE // GROUPS).sum(2, dtype=np.int32)


def packed(fine: np.ndarray) -> bytes:
    """A count vector in one byte a group, in four where a count needs them."""
    return (fine.astype(np.uint8) if fine.max() < 256 else fine).tobytes()


def _vectors(column) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(x) == FINE for x in raw):
        return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, FINE)
    return np.stack([np.frombuffer(x, np.uint8 if len(x) == FINE else "<i4").astype(np.int32) for x in raw])


def _possible(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, need: int) -> np.ndarray:
    """Whether sums of minima let rows of x and y, of n and m shingles, link."""
    return enough(np.minimum(x, y).sum(-1, dtype=np.int64), np.asarray(n).astype(np.int64), m, need=need)


def _summaries(n: int):
    """Per document its set's size and digest; per task the group counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "digest", "grp", "cnt"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
        counts = np.zeros(RARITY, np.int64)
        for b in batches:
            sizes, digests = [], []
            for _, s in _sets(b.column("text"), n):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                np.add.at(counts, (s & np.uint64(RARITY - 1)).astype(np.int64), 1)
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, t) for x, t in zip((sizes, digests, none, none), kinds[1:], strict=True))], names=names)
        g = np.flatnonzero(counts)
        none = [None] * len(g)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((none, none, none, g, counts[g]), kinds, strict=True)], names=names)

    return run


def _keys(n: int, need: int, rarity):
    """For each class its prefix shingles, and its count vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            h, cid, vec, vid, vn = [], [], [], [], []
            for k, s in _sets(b.column("text"), n):
                if not len(s):
                    continue
                order = np.lexsort((s, rarity.value[(s & np.uint64(RARITY - 1)).astype(np.int64)]))
                first = s[order[: prefix_size(len(s), need)]]
                h.append(first)
                cid.append(np.full(len(first), ids[k]))
                vec.append(packed(count_vector(s)))
                vid.append(ids[k])
                vn.append(len(s))
            if not vid:
                continue
            keys, owner = np.concatenate(h).view(np.int64), np.concatenate(cid)
            a, z = len(keys), len(vid)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([keys, np.zeros(z, np.int64)]), pa.int64()),
                pa.array(np.concatenate([owner, vid]).astype(np.int64), pa.int64()),
                pa.array(np.concatenate([np.zeros(a, np.int32), vn]).astype(np.int32), pa.int32()),
                pa.array([None] * a + vec, pa.binary())],
                names=["key", "cid", "n", "vec"])

    return run


def _verify(n: int, need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for k in range(0, b.num_rows, CHUNK):
                x = shingle_sets(text_bytes(b.column("ta").slice(k, CHUNK)), BLACK, n)
                y = shingle_sets(text_bytes(b.column("tb").slice(k, CHUNK)), BLACK, n)
                for i, (s, t) in enumerate(zip(x, y, strict=True)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep[k + i] = both > 0 and bool(enough(both, len(s), len(t), need=need))
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _bounded(need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = _possible(_vectors(b.column("va")), _vectors(b.column("vb")), b.column("na").to_numpy(), b.column("nb").to_numpy(), need)
                yield b.select(["a", "b"]).filter(pa.array(ok))

    return run


def bounded(pairs: DataFrame, points: DataFrame, need: int) -> DataFrame:
    """The pairs (a, b) whose sizes and summed minima of all FINE groups do
    not rule a link out."""
    n = points.select("cid", "n")
    sized = (pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
             .filter((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * need)))
    v = points.select("cid", "vec")
    both = cut(sized, "sized").join(v.toDF("a", "va"), "a").join(v.toDF("b", "vb"), "b").select("a", "b", "na", "nb", "va", "vb")
    return both.mapInArrow(_bounded(need), "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, n: int, need: int) -> DataFrame:
    """The pairs (a, b) of document ids whose whole sets link."""
    pairs = cut(pairs, "pairs")
    involved = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "involved")
    opened = cut(docs.join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "opened")
    both = (pairs.join(opened.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(opened.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return cut(both.mapInArrow(_verify(n, need), "a long, b long"), "verified")


def _leaves(cid, comp, size, fine, run, need: int) -> tuple[list, list]:
    """Pairs within runs of at most one leaf, all runs of a batch together:
    rows are compared with those 1, 2, ... further on in their run."""
    a, b = [], []
    vec = coarse(fine)
    for d in range(1, LEAF):
        x = np.flatnonzero((run[d:] == run[:-d]) & (comp[d:] != comp[:-d])) if d < len(run) else run[:0]
        if not len(x) and d < len(run) and not (run[d:] == run[:-d]).any():
            break
        for k in range(0, len(x), 1 << 14):
            i = x[k: k + (1 << 14)]
            i = i[_possible(vec[i], vec[i + d], size[i], size[i + d], need)]
            i = i[_possible(fine[i], fine[i + d], size[i], size[i + d], need)]
            a.append(np.minimum(cid[i], cid[i + d]))
            b.append(np.maximum(cid[i], cid[i + d]))
    return a, b


def _block_pairs(need: int):
    """Rows sorted by (key, i, j, side) -> surviving pairs of each run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def survivors(t: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
            side = t.column("side").to_numpy()
            cid, comp, size = (t.column(c).to_numpy() for c in ("cid", "comp", "n"))
            fine = _vectors(t.column("vec"))
            lens = np.diff(cuts)
            plain = np.logical_and(lens <= LEAF, np.maximum.reduceat(side, cuts[:-1]) == 0)
            rows = np.flatnonzero(np.repeat(plain, lens))
            of = np.repeat(np.arange(len(lens)), lens)[rows]
            a, b = _leaves(cid[rows], comp[rows], size[rows], fine[rows], of, need)
            for x, y in zip(cuts[:-1][~plain], cuts[1:][~plain], strict=True):
                left, right = x + np.flatnonzero(side[x:y] == 0), x + np.flatnonzero(side[x:y] == 1)
                same = not len(right)
                vec = coarse(fine[x:y])
                tree = RTree(vec[left - x], size[left])
                for q in (left if same else right):
                    hit = left[tree.query(vec[q - x], int(size[q]), need)]
                    hit = hit[(comp[hit] != comp[q])]
                    hit = hit[cid[hit] < cid[q]] if same else hit
                    hit = hit[_possible(fine[hit], fine[q], size[hit], size[q], need)]
                    a.append(np.minimum(cid[hit], cid[q]))
                    b.append(np.maximum(cid[hit], cid[q]))
            got = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (a, b)]
            if len(got[0]):  # a pair often shares several keys of a batch
                both = np.unique(np.stack(got, 1), axis=0)
                got = [both[:, 0], both[:, 1]]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["a", "b"])

        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            k = np.stack([t.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1])
            if len(cuts) > 1:
                yield survivors(t.slice(0, int(cuts[-1])), cuts)
            rest = t.slice(int(cuts[-1]))  # at most one block pair
        if rest is not None and len(rest):
            yield survivors(rest, np.asarray([0, len(rest)]))

    return run


def tree_pairs(entries: DataFrame, points: DataFrame, need: int, block: int) -> DataFrame:
    """entries(key, cid, comp) of keys with several components -> pairs of
    classes of different components that the R-trees cannot rule out."""
    sizes = entries.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    e = entries.join(cut(sizes, "block-counts"), "key").withColumn("own", F.pmod(F.xxhash64("cid", "key"), F.col("blocks")).cast("int"))
    dealt = (e.join(points.select("cid", "n", "vec"), "cid").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "comp", "n", "vec"))
    parts = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "cid")
    return parts.mapInArrow(_block_pairs(need), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, n: int = WORDS, need: int = NEED, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id.

    Defined results: null and empty texts and texts without words have an
    empty set and are alone; every row is a document of its own and comes
    back, rows that share a doc_id and rows without one too; ties need no
    rule, since a component is named by its smallest doc_id (null where none
    of its rows has one); an empty table gives no rows; further columns are
    not read."""
    rows, odd = keyed(docs.select("doc_id", "text"))
    out = _components(texts_by_row(rows), n, need, block)
    if odd is None:
        return out
    own = cut(renamed(out.select("doc_id", "n_shingles", F.col("component_id").alias("comp")), odd), "own-ids")
    low = cut(own.groupBy(F.col("comp").alias("c")).agg(F.min("doc_id").alias("component_id")), "own-components")
    return own.join(low, F.col("comp") == F.col("c")).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, n: int, need: int, block: int = BLOCK) -> DataFrame:
    """``jaccard_components`` for docs(doc_id, text) with a key in each row."""
    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, n int, digest binary, grp int, cnt long"
    seen = cut(docs.mapInArrow(_summaries(n), schema), "summaries")
    # RARITY numbers at most, whatever the corpus is.
    rarity = np.zeros(RARITY, np.int64)
    for r in seen.filter("grp is not null").groupBy("grp").agg(F.sum("cnt").alias("c")).collect():
        rarity[r["grp"]] = r["c"]
    sets = seen.filter("digest is not null").groupBy("doc_id").agg(F.max("n").alias("n"), F.max("digest").alias("digest"))
    reps = cut(sets.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "representatives")
    known = cut(sets.join(reps, "digest", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "classes")
    copies = cut(known.filter("rep <> doc_id").select("doc_id"), "copies")
    one = docs.join(copies, "doc_id", "left_anti")
    keyed = cut(one.mapInArrow(_keys(n, need, spark.sparkContext.broadcast(rarity)), "key long, cid long, n int, vec binary"), "keys")
    entries = keyed.filter("vec is null").select("key", "cid")
    points = cut(keyed.filter("vec is not null").select("cid", "n", "vec").dropDuplicates(["cid"]), "points")
    several = entries.groupBy("key").agg(F.min("cid").alias("lead"), F.max("cid").alias("last")).filter("lead < last").select("key", "lead")
    multi = cut(entries.join(cut(several, "shared-keys"), "key"), "multi")
    stars = (multi.filter("cid <> lead").groupBy("cid", "lead").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("cid").agg(F.max(F.struct("c", F.col("lead"))).alias("m")).select(F.col("m.lead").alias("a"), F.col("cid").alias("b")))
    links = verified(bounded(stars, points, need), docs, n, need)
    comp = components(links)
    joined = multi.select("key", "cid").join(comp, F.col("cid") == F.col("node"), "left") \
        .select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    open_keys = joined.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("key")
    unresolved = cut(joined.join(cut(open_keys, "open-keys"), "key", "left_semi").distinct(), "unresolved")
    more = verified(tree_pairs(unresolved, points, need, block), docs, n, need)
    if not more.isEmpty():
        comp = components(links.unionByName(more))
    return known.join(comp, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("comp", "rep").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = WORDS, need: int = NEED) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that
    of the smallest doc_id, rows without one last; of rows that share it any
    one."""
    rows, odd = keyed(docs)
    out = _components(texts_by_row(rows), n, need)
    if odd is None:
        gone = out.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone"))
    else:
        key = out.select(F.col("doc_id").alias("_gone"), "doc_id", "component_id")
        own = cut(renamed(key, odd), "own-rows")
        rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_gone").alias("key"))
        stays = cut(own.groupBy("component_id").agg(F.min(rank).alias("m")).select(F.col("m.key").alias("_stays")), "staying")
        gone = own.join(stays, F.col("_gone") == F.col("_stays"), "left_anti").select("_gone")
    return rows.join(cut(gone, "gone"), F.col("_row") == F.col("_gone"), "left_anti").select(*docs.columns)
