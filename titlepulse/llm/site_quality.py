"""Operator 9: document quality by hierarchical empirical Bayes.

Two classifiers give each document log-odds of good quality and of toxicity.
Sites are a hierarchy: all documents, hosts (source), paths (source, lang).
For each head the expected share of ones of a host is shrunk towards the
global share, that of a path towards its host's, with beta priors whose
strength is estimated from the spread between sites (method of moments), so
sparse sites lean on their parents and large ones speak for themselves. A
document's posterior combines its path's share (its own part left out) with
its own evidence. Documents that are probably bad or probably toxic go.

Sites are aggregated with map-side sums, so a host with a third of all rows
is a handful of partial rows; only the site table is joined back, which
Spark broadcasts when its written size allows and otherwise sorts and merges.
"""

from __future__ import annotations

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from titlepulse.llm.common import cut
from titlepulse.llm.linear import FIT_ROWS, fit, fresh, with_scores

HEADS = ("quality", "toxic")
STRENGTH = (2.0, 1e4)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, labels) of the documents with a label; the other may be null."""
    some = labels.filter("quality is not null or toxic is not null").select(
        F.col("doc_id").alias("labelled"), F.array(F.col("quality").cast("double"), F.col("toxic").cast("double")).alias("labels"))
    return docs.select("doc_id", "text").join(some, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "labels")


def sample_ids(labels: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` labelled ids with the smallest hashes: a bounded table."""
    return cut(labels.filter("doc_id is not null and quality is not null and toxic is not null")
               .orderBy(F.xxhash64("doc_id"), "quality", "toxic").limit(rows), "label-sample")


def sample_labels(labels: DataFrame, rows: int) -> DataFrame:
    """For each head at least the ``rows`` ids with its label that have the
    smallest hashes: as many rows at most with both labels and with each one."""
    own = labels.select("doc_id", "quality", "toxic").filter("doc_id is not null")
    kinds = [own.filter(f"quality is {q} and toxic is {t}").orderBy(F.xxhash64("doc_id"), "quality", "toxic").limit(rows)
             for q, t in (("not null", "not null"), ("not null", "null"), ("null", "not null"))]
    return cut(kinds[0].unionByName(kinds[1]).unionByName(kinds[2]), "label-sample")


def _logit(p: Column) -> Column:
    p = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    return F.log(p / (1 - p))


def _strength(mean: float, spread: float | None, noise: float | None) -> float:
    """Beta prior strength from the variance between sites beyond noise."""
    between = (spread or 0.0) - (noise or 0.0)
    if between <= 0:
        return STRENGTH[1]
    return float(np.clip(mean * (1 - mean) / between - 1, *STRENGTH))


def judged(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs and a struct column ``judgement`` (quality, toxic: posteriors;
    host and path shares; keep). See ``site_quality`` for odd input."""
    train = labelled_rows(docs, sample_labels(labels, fit_rows))
    weights, bias, share = fit(train, len(HEADS), fit_rows, fetch=3 * fit_rows)
    fitted = ~np.isnan(share)
    share = np.where(fitted, share, 0.5)
    z, n = fresh(docs, "log_odds"), fresh(docs, "n_words_scored")
    scored = with_scores(docs, weights, bias, z, n)
    host, lang = F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("lang"), F.lit(""))
    ps = [(1 / (1 + F.exp(-F.col(z)[k]))).alias(f"p{k}") for k in range(len(HEADS))]
    sums = [x for k in range(len(HEADS)) for x in (F.sum(f"p{k}").alias(f"s{k}"), F.sum(F.expr(f"p{k} * (1 - p{k})")).alias(f"v{k}"))]
    paths = cut(scored.select(host.alias("host"), lang.alias("path"), *ps).groupBy("host", "path")
                .agg(F.count(F.lit(1)).alias("n"), *sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(f"{c}{k}").alias(f"h{c}{k}") for k in range(len(HEADS)) for c in "sv"])
    total = hosts.agg(F.sum("hn").alias("n"), *[x for k in range(len(HEADS)) for x in (
        F.sum(f"hs{k}").alias(f"s{k}"), F.var_pop(F.expr(f"hs{k} / hn")).alias(f"spread{k}"),
        F.avg(F.expr(f"hv{k} / hn / hn")).alias(f"noise{k}"))]).first()
    if not total["n"]:
        nothing = F.struct(*[F.lit(0.0).alias(c) for c in ("quality", "toxic", "host_quality", "host_toxic", "path_quality", "path_toxic")],
                           F.lit(False).alias("keep"))
        return docs.withColumn(fresh(docs, "judgement"), nothing)
    mean = [total[f"s{k}"] / total["n"] for k in range(len(HEADS))]
    kappa = [_strength(mean[k], total[f"spread{k}"], total[f"noise{k}"]) for k in range(len(HEADS))]
    sites = paths.join(hosts, "host")
    for k in range(len(HEADS)):
        sites = sites.withColumn(f"host{k}", (F.lit(kappa[k] * mean[k]) + F.col(f"hs{k}")) / (F.lit(kappa[k]) + F.col("hn")))
    within = sites.agg(*[x for k in range(len(HEADS)) for x in (
        F.avg(F.expr(f"pow(s{k} / n - host{k}, 2)")).alias(f"spread{k}"), F.avg(F.expr(f"v{k} / n / n")).alias(f"noise{k}"))]).first()
    depth = [_strength(mean[k], within[f"spread{k}"], within[f"noise{k}"]) for k in range(len(HEADS))]
    site = cut(sites.select("host", "path", F.struct("n", *[F.col(f"{c}{k}") for k in range(len(HEADS)) for c in ("s", "host")]).alias("site")), "sites")
    col = {c: fresh(docs, f"site_{c}") for c in ("host", "path", "site")}
    for old, new in col.items():
        site = site.withColumnRenamed(old, new)
    out = scored.join(site, (host == F.col(col["host"])) & (lang == F.col(col["path"])))
    s, parts, post = F.col(col["site"]), [], []
    for k in range(len(HEADS)):
        p = 1 / (1 + F.exp(-F.col(z)[k]))
        path = (F.lit(depth[k]) * s[f"host{k}"] + s[f"s{k}"] - p) / (F.lit(depth[k]) + s["n"] - 1)
        evidence = F.col(z)[k] - float(np.log(share[k] / (1 - share[k])))
        post.append(1 / (1 + F.exp(-(_logit(path) + evidence))))
        parts += [s[f"host{k}"].alias(f"host_{HEADS[k]}"), path.alias(f"path_{HEADS[k]}")]
    # A head without labels rejects nothing.
    keep = (post[0] >= 0.5 if fitted[0] else F.lit(True)) & (post[1] < 0.5 if fitted[1] else F.lit(True))
    return out.select(*[F.col(c) for c in docs.columns],
                      F.struct(post[0].alias("quality"), post[1].alias("toxic"), *parts, keep.alias("keep")).alias(fresh(docs, "judgement")))


def site_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, quality, toxic, host and path shares, keep.

    Defined results: a null text is empty and is judged by its shape and its
    site; null source or lang count as the site ''; labels without id are not
    used, of a row with one null label the other is used, repeated ones count
    as often as they come; repeated documents are judged each; a head without
    labels of these documents has evidence 0 and posteriors 0.5 and rejects
    nothing, so without any labels all rows are kept; an empty table gives no
    rows; further columns are not read."""
    j = F.col("judgement")
    return judged(docs.select("doc_id", "text", "lang", "source"), labels, fit_rows).select(
        "doc_id", *[j[c].alias(c) for c in ("quality", "toxic", "host_quality", "host_toxic", "path_quality", "path_toxic", "keep")])


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    out = judged(docs, labels, fit_rows)
    return out.filter(F.col(out.columns[-1])["keep"]).select(*docs.columns)
