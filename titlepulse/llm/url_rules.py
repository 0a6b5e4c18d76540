"""Operator 4: URL filtering by stated rules and mined association rules.

Stated rules fix hosts and path prefixes; the longest that fits decides. Other
URLs are judged by association rules: Spark's FP-growth mines combinations of
URL tokens (host labels, path words, scheme, query keys) from pages that have
a label, and rules "tokens -> block" or "tokens -> allow" with enough support
and confidence are kept, less those that a part of their tokens already gives
at the same confidence. They are matched through an inverted index: a rule is
posted under its rarest token, a page's tokens are joined to these postings,
and a rule fires when the page has its other tokens too. Of the rules that
fire those go whose tokens are a part of another's, and the surest of the rest
decides. Native: DataFrame functions and Spark ML's FPGrowth.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame

from titlepulse.llm.common import ascii_lower, cut

#: (host, path prefix, verdict), fixed by the contract.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Labelled pages that a rule needs, whatever the size of the table.
MIN_PAGES = 20
MIN_CONFIDENCE = 0.6
BLOCK, ALLOW = "=block", "=allow"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased."""
    return F.when(F.instr(url, "://") > 0,
                  ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))).otherwise("")


def path(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.when(F.instr(url, "://") > 0,
                  F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def stated_rule(host_c: Column, path_c: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest stated rule that fits, null without one;
    of rules of the same length the first in text order."""
    out_rule, out_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host_c == h) | host_c.endswith("." + h)) & path_c.startswith(p)
        out_rule = F.when(fits, F.lit(h + p)).otherwise(out_rule)
        out_verdict = F.when(fits, F.lit(verdict)).otherwise(out_verdict)
    return out_rule, out_verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL, each marked with the part it comes from."""
    def part(mark: str, text: Column, cut_at: str) -> Column:
        return F.transform(F.array_remove(F.split(text, cut_at), ""), lambda x: F.concat(F.lit(mark), x))

    words = F.regexp_replace(path(url), "[0-9]+", "#")
    query = F.regexp_extract(_rest(url), "\\?([^#]*)", 1)
    return F.array_distinct(F.concat(part("h:", host(url), "[.]"), part("p:", words, "[/._-]+"),
                                     part("q:", F.regexp_replace(query, "=[^&]*", ""), "&"),
                                     part("s:", ascii_lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), "/")))


def mine(labelled: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """labelled(url, bad) -> rules (rule_id, tokens, verdict, confidence, support).

    A rule holds for ``min_pages`` labelled pages at least, counting its verdict."""
    baskets = (labelled.filter("url is not null and bad is not null")
               .select(F.array_union(url_tokens(F.col("url")), F.array(F.when(F.col("bad"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))))
                       .alias("items")))
    baskets = cut(baskets, "url-baskets")
    n = baskets.count()
    if n < min_pages:
        spark = labelled.sparkSession
        return spark.createDataFrame([], "rule_id long, tokens array<string>, verdict string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / n, minConfidence=min_confidence).fit(baskets)
    label = F.col("consequent")[0]
    rules = (model.associationRules.filter(label.isin(BLOCK, ALLOW))
             .select(F.array_sort("antecedent").alias("tokens"), F.substring(label, 2, 9).alias("verdict"), "confidence", "support"))
    rules = cut(rules.filter(~F.exists("tokens", lambda x: x.isin(BLOCK, ALLOW))), "url-rules")
    # A longer rule stays only where none with one token less is as sure.
    shorter = rules.select(F.explode(F.transform("tokens", lambda x: F.array_remove(F.col("tokens"), x))).alias("tokens"),
                           F.col("tokens").alias("whole"), "verdict", "confidence")
    covered = (shorter.alias("l").join(rules.alias("s"), (F.col("l.tokens") == F.col("s.tokens"))
                                       & (F.col("l.verdict") == F.col("s.verdict")) & (F.col("s.confidence") >= F.col("l.confidence")))
               .select(F.col("l.whole").alias("tokens"), F.col("l.verdict").alias("verdict")).distinct())
    kept = rules.join(covered, ["tokens", "verdict"], "left_anti")
    return cut(kept.orderBy("tokens", "verdict").withColumn("rule_id", F.monotonically_increasing_id())
               .select("rule_id", "tokens", "verdict", "confidence", "support"), "url-rules-kept")


def rarest(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(rule_id, token): the token of each rule that fewest of ``urls`` have."""
    terms = rules.select("rule_id", F.explode("tokens").alias("token"))
    seen = urls.select(F.explode("own").alias("token")).join(terms.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(seen, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("m")).select("rule_id", F.col("m.token").alias("token"))


def mined_verdict(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages(page_id, url) -> (url, mined, confidence): of the rules whose
    tokens the URL holds, less those that are a part of another one of them,
    the verdict of the surest; of equally sure ones block. One row per
    distinct URL that any rule fits."""
    urls = cut(pages.select("url").filter("url is not null").distinct().select("url", url_tokens(F.col("url")).alias("own")), "url-tokens")
    index = cut(rules.join(rarest(rules, urls), "rule_id"), "url-index")
    fired = cut(urls.select("url", "own", F.explode("own").alias("token")).join(index, "token")
                .filter(F.size(F.array_except("tokens", "own")) == 0).select("url", "rule_id", "verdict", "confidence"), "fired")
    # Rules by rules: a rule and those that hold all its tokens and more.
    need = rules.select("rule_id", F.size("tokens").alias("need"), F.explode("tokens").alias("token"))
    wider = need.select(F.col("rule_id").alias("whole"), F.col("need").alias("size"), "token")
    parts = cut(need.join(wider, "token").filter("need < size").groupBy("rule_id", "need", "whole").agg(F.count(F.lit(1)).alias("n"))
                .filter("n = need").select(F.col("rule_id").alias("part"), "whole"), "rule-parts")
    over = fired.select(F.col("url").alias("u"), F.col("rule_id").alias("whole")).join(parts, "whole").select("u", "part").distinct()
    best = fired.join(over, (F.col("url") == F.col("u")) & (F.col("rule_id") == F.col("part")), "left_anti") \
        .groupBy("url").agg(F.max(F.struct("confidence", "verdict")).alias("best"))
    return best.select("url", F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES,
                min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    ``labelled`` is (url, bad). Defined results: a null URL or one without
    :// has an empty host and path, fits no stated rule and is allowed unless
    a mined rule fits; a page that no rule fits is allowed; repeated pages
    come back as often as they came; with fewer labelled rows than a rule
    needs there are no mined rules; an empty table gives no rows; further columns are not read."""
    mined = mined_verdict(pages, mine(labelled, min_pages, min_confidence))
    rule, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", "url").alias("p").join(mined.alias("m"), F.col("p.url") == F.col("m.url"), "left")
    return (judged.select("page_id", F.coalesce(host(F.col("p.url")), F.lit("")).alias("host"),
                          F.coalesce(path(F.col("p.url")), F.lit("")).alias("path"), "mined")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, "mined", F.lit("allow")).alias("verdict")))
