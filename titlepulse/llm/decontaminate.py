"""Operator 10: benchmark decontamination over a distributed positional index.

The index is a table of postings (doc_id, term, pos). Benchmark items are cut
into windows of 13 words; each window's terms are ranked by their frequency
in the corpus, and windows with a term the corpus lacks cannot occur. Postings
are stored for the rarest terms of the windows alone; those of a window's
rarest term give candidate starts (position less offset), which are then
intersected with the offset-adjusted postings of its next rarest terms. What
survives is compared word by word with the text, so matches are exact.

Native: DataFrame functions alone. No side is broadcast by hint: the probe
terms and windows are written tables of known size, which Spark broadcasts
when they are small and otherwise sorts and merges, splitting hot terms.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from titlepulse.llm.common import UPPER, cut, keyed, renamed, texts_by_row

#: ASCII characters that are in no word; all others are, A-Z as a-z.
NOT_WORD = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: The term that stands after the last word of each text in an index.
END = ""
WINDOW = 13
PROBES = 3


def words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + NOT_WORD, UPPER.lower() + " " * len(NOT_WORD))
    return F.array_remove(F.split(plain, " "), "")


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, wid, words): every run of ``size`` words; an item of fewer
    words, but not none, is one window. wid numbers the distinct windows."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    runs = (items.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - size))).alias("s"))
            .select("item_id", F.slice("w", F.col("s") + 1, F.lit(size)).alias("words")).distinct())
    runs = cut(runs, "item-windows")
    ids = cut(runs.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "window-ids")
    return cut(runs.join(ids, "words"), "windows")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Corpus frequency of each of ``terms`` (term), zero where there is none."""
    seen = (docs.select(F.explode(words(F.col("text"))).alias("term")).join(terms, "term", "left_semi")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def probes(windows: DataFrame, counts: DataFrame, n: int = PROBES) -> DataFrame:
    """(wid, rank, term, off): the n rarest terms of each window that can
    occur; ties by term, then place."""
    at = (windows.select("wid", "words").distinct()
          .select("wid", F.size("words").alias("size"), F.posexplode("words").alias("off", "term")))
    ranked = at.join(counts, "term")
    able = ranked.groupBy("wid").agg(F.min("n").alias("least")).filter("least > 0").select("wid")
    order = Window.partitionBy("wid").orderBy("n", "term", "off")
    return (ranked.join(able, "wid", "left_semi").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= n).select("wid", "rank", "term", "off"))


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Positional inverted index (doc_id, term, pos) of docs(doc_id, text),
    of all terms or of the given ones; written, so that it is built once. The
    term END stands after the last word, so its place is the text's length."""
    at = docs.select("doc_id", F.posexplode(F.array_append(words(F.col("text")), END)).alias("pos", "term"))
    if terms is not None:
        at = at.join(terms, "term", "left_semi")
    return cut(at.select("doc_id", "term", "pos"), "postings")


def candidates(index: DataFrame, probe: DataFrame, n: int = PROBES, slack: int = 0) -> DataFrame:
    """(doc_id, wid, start) where the n rarest terms of a window stand at
    their offsets, or, with ``slack``, at most so many words off them."""
    def of(rank: int) -> DataFrame:
        return probe.filter(F.col("rank") == rank).select("wid", "term", "off")

    got = (index.join(of(1), "term")
           .select("doc_id", "wid", (F.col("pos") - F.col("off")).alias("start")))
    if not slack:
        got = got.filter("start >= 0")
    for rank in range(2, n + 1):
        # Windows of fewer words have no term of this rank and pass as they are.
        want = (got.join(of(rank), "wid", "left")
                .select("doc_id", "wid", "start", "term", "off"))
        here = index.select(F.col("doc_id").alias("d"), F.col("term").alias("t"), F.col("pos").alias("p"))
        if slack:
            near = want.withColumn("p", F.explode(F.sequence(F.col("start") + F.coalesce("off", F.lit(0)) - slack,
                                                             F.col("start") + F.coalesce("off", F.lit(0)) + slack)))
        else:
            near = want.withColumn("p", F.col("start") + F.col("off"))
        none = near.filter(F.col("term").isNull())
        hit = near.filter(F.col("term").isNotNull()).alias("w").join(
            here.alias("h"), (F.col("w.doc_id") == F.col("h.d")) & (F.col("w.term") == F.col("h.t"))
            & (F.col("w.p") == F.col("h.p")), "left_semi")
        got = hit.select("doc_id", "wid", "start").unionByName(none.select("doc_id", "wid", "start")).distinct()
    return got


def probe_index(docs: DataFrame, windows: DataFrame, n_probes: int = PROBES) -> tuple[DataFrame, DataFrame]:
    """(probes, index of their terms and END) for windows over docs."""
    terms = cut(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = cut(term_counts(docs, terms), "term-counts")
    probe = cut(probes(windows, counts, n_probes), "probes")
    end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
    return probe, build_index(docs, cut(probe.select("term").unionByName(end).distinct(), "probe-terms"))


def phrase_matches(docs: DataFrame, windows: DataFrame, probe: DataFrame, index: DataFrame, n_probes: int = PROBES) -> DataFrame:
    """Every occurrence of a window in docs(doc_id, text), one text per id:
    (doc_id, wid, start, len)."""
    found = cut(candidates(index, probe, n_probes).distinct(), "candidates")
    # Word by word: only documents with a candidate are opened again.
    few = cut(found.select("doc_id").distinct(), "candidate-docs")
    opened = docs.join(few, "doc_id", "left_semi").select("doc_id", F.explode(F.array(words(F.col("text")))).alias("w"))
    starts = found.join(windows.select("wid", "words").distinct(), "wid")
    return (starts.join(opened, "doc_id")
            .filter(F.slice("w", F.col("start") + 1, F.size("words")) == F.col("words"))
            .select("doc_id", "wid", "start", F.size("words").alias("len")))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = 4, size: int = WINDOW,
                      n_probes: int = PROBES) -> DataFrame:
    """(doc_id, item_id, start): places where the rarest terms of a window of
    the item stand within ``slack`` words of their places in it."""
    windows = item_windows(benchmark, size)
    rows, odd = keyed(docs.select("doc_id", "text"))
    probe, index = probe_index(texts_by_row(rows), windows, n_probes)
    found = candidates(index, probe, n_probes, slack)
    return renamed(found.join(windows.select("wid", "item_id"), "wid").select("doc_id", "item_id", "start").distinct(), odd)


def covered(matches: DataFrame) -> DataFrame:
    """(doc_id, n_hit): words inside any match, each counted once."""
    spans = matches.select("doc_id", "start", (F.col("start") + F.col("len")).alias("end")) \
        .groupBy("doc_id", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    return spans.select("doc_id", F.greatest(F.lit(0), new).alias("n")).groupBy("doc_id") \
        .agg(F.sum("n").alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, n_probes: int = PROBES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    contaminated: n_hit > 0 and 20 * n_hit >= n_words. Defined results: null
    and empty texts have no words and are never hit; every row is searched and
    comes back, rows that share a doc_id and rows without one too; items
    without words have no window, items without item_id hit words but are not
    listed; repeated items count once; a document is hit by a window of any
    item alike, ties do not matter; empty tables give no rows, or rows without
    hits; further columns are not read."""
    rows, odd = keyed(docs.select("doc_id", "text"))
    return renamed(_searched(texts_by_row(rows), benchmark, size, n_probes), odd)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, n_probes: int = PROBES) -> DataFrame:
    """The rows of docs, all columns, less the contaminated ones; of rows that
    share a doc_id or have none each is judged by its own text."""
    rows, _ = keyed(docs)
    bad = cut(_searched(texts_by_row(rows), benchmark, size, n_probes).filter("contaminated").select(F.col("doc_id").alias("_bad")), "contaminated")
    return rows.join(bad, F.col("_row") == F.col("_bad"), "left_anti").select(*docs.columns)


def _searched(docs: DataFrame, benchmark: DataFrame, size: int, n_probes: int) -> DataFrame:
    """``decontaminate`` for docs(doc_id, text) with a key in each row."""
    windows = item_windows(benchmark, size)
    probe, index = probe_index(docs, windows, n_probes)
    matches = cut(phrase_matches(docs, windows, probe, index, n_probes), "matches")
    items = (matches.join(windows.select("wid", "item_id"), "wid").filter("item_id is not null")
             .groupBy("doc_id", F.col("item_id").cast("string").alias("item")).agg(F.lit(1))
             .groupBy("doc_id").agg(F.collect_list("item").alias("items"))
             .select("doc_id", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256")))
    sizes = index.filter(F.col("term") == END).select("doc_id", F.col("pos").cast("long").alias("n_words"))
    hits = covered(matches).join(items, "doc_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (sizes.join(hits, "doc_id", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                    ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated")))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') x, least(len(w), 13) n
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
runs AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') x
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r.doc_id, r.s, r.n, win.item_id FROM runs r JOIN win ON r.x = win.x AND r.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) n_items,
               sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) items_sha256 FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items,
       coalesce(items_sha256, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
